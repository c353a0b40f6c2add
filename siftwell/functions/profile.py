"""Fields of a company profile that are read out of page text, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siftwell.functions import urls
from siftwell.functions.text import blank, let, squeeze, squeeze_or_null

# Patterns, phrases and lists that results must agree on.
EMAIL = r"\b([a-zA-Z0-9][a-zA-Z0-9._%+\-]*@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,})\b"
PHONE = r"(\+\d[\d\s\-.]{7,}\d)"
LINKEDIN = r"""(https?://(?:www\.)?linkedin\.com/company/[^\s)"]+)"""
METRICS = [
    ("years_expertise", r"(?i)(\d+\+?)\s*years?\s+(?:of\s+)?(?:experience|expertise)"),
    ("countries", r"(?i)(\d+\+?)\s*countries"),
    ("clients_count", r"(?i)(\d+\+?)\s*clients?"),
    ("central_banks", r"(?i)(\d+\+?)\s*central\s+banks?"),
    ("employees", r"(?i)(\d+\+?)\s*(?:employees?|staff|team\s+members?)"),
    ("offices", r"(?i)(\d+\+?)\s*locations?"),
    ("projects", r"(?i)(\d+\+?)\s*projects?\s+completed"),
    ("staff_rd_percent", r"(?i)(\d+)%?\+?\s*staff.*?R&D"),
]
FOUNDED = r"(?i)(?:founded|established|created|launched|incorporated|since|depuis)\s*(?:in\s+)?(\b(?:19|20)\d{2}\b)"
EMPLOYEES = r"(?iu)(\d[\d,]*\+?)\s*(?:employees?|collaborators?|team\s+members?|salariés?)(?!\s+percentage)"
REVENUE = r"(?i)(?:revenue|turnover|chiffre\s+d['’]affaires?)\s*[:\s]*([€$£]?\s*\d[\d\s,.]*\s*(?:M|B|K|million|billion|milliard)?[€$£]?)"
CERTIFICATION = r"(?i)\b(ISO[/\s-]?\d{5}(?::\d{4})?|SOC\s*[12](?:\s+Type\s+[IVX1-9]+)?|SWIFT[^\n,.]{0,40}(?:Certification|Label|Compatible)[^\n,.]{0,30}|PCI[- ]DSS|GDPR\s*Compliant|ISO\s*27\d{3}(?::\d{4})?)\b"
TECHNOLOGIES = ["SaaS", "PaaS", "IaaS", "API", "REST", "microservices", "Kubernetes", "Docker", "DevOps", "cloud", "low-code", "no-code", "AI", "machine learning", "deep learning", "NLP", "AIOps", "blockchain", "PostgreSQL", "CDM", "SWIFT", "EMIR", "EMIR REFIT", "Dodd-Frank", "Basel III", "MiFID", "SOC 2", "ISO 27001"]
SECTORS = ["Capital Markets", "Insurance", "Banking", "Asset Management", "Collateral Management", "Post-Trade", "FinTech", "Compliance", "Regulatory", "Life & Pension", "Healthcare", "Property & Casualty", "Market Infrastructure", "Asset Servicing", "Wealth Management"]
STREETS = "rue|avenue|boulevard|street|road|blvd|ave|st|drive|dr|lane|ln|place|pl|way|wy"
PLACE_WORDS = "siege|headquarter|head office|based in|located|adresse|address|registered"
COUNTRIES = [("France", "France"), ("Tunisia", "Tunisia"), ("Tunisie", "Tunisia"), ("Morocco", "Morocco"), ("Maroc", "Morocco"), ("USA", "USA"), ("United States", "USA"), ("United Kingdom", "United Kingdom"), ("Germany", "Germany"), ("Spain", "Spain"), ("Italy", "Italy"), ("Belgium", "Belgium"), ("Switzerland", "Switzerland"), ("Canada", "Canada"), ("Algeria", "Algeria"), ("Algerie", "Algeria"), ("Senegal", "Senegal"), ("Netherlands", "Netherlands"), ("Sweden", "Sweden"), ("Japan", "Japan"), ("China", "China"), ("India", "India"), ("Brazil", "Brazil"), ("Australia", "Australia"), ("Singapore", "Singapore"), ("South Korea", "South Korea")]
NAME_SEPARATORS = ["|", " - ", " — ", ":", "•"]
GENERIC_NAMES = ["home", "welcome", "official site", "homepage", "website", "site", "blog", "news"]
LEADER_TITLES = ["président", "directeur général", "directrice générale", "gérant", "co-gérant", "pdg", "dg", "ceo", "cto", "cfo", "coo", "associé gérant", "administrateur délégué", "vice-président", "directeur", "directrice", "président du conseil"]
FORMER_TITLES = ["ancien", "commissaire", "auditeur", "liquidateur", "représentant permanent", "censeur"]
ENTITIES = ["SA", "SCI", "SARL", "SAS", "SASU", "EURL", "SNC", "PRICEWATERHOUSE", "MAZARS", "FORVIS", "BDO", "KPMG", "DELOITTE", "EY"]


def first(c: Column, pattern: str, group: int = 1) -> Column:
    """The first match, or null."""
    return F.nullif(F.regexp_extract(blank(c), pattern, group), F.lit(""))


def email(c: Column) -> Column:
    """The first address; null where that one is the name of an image."""
    found = first(c, EMAIL)
    return F.when(~found.rlike(r"\.(?:png|jpg|svg|gif|webp)$"), found)


def phone(c: Column) -> Column:
    return F.trim(first(c, PHONE))


def linkedin(c: Column) -> Column:
    return F.regexp_replace(first(c, LINKEDIN), "/+$", "")


# Fixed values.
ASSETS = "png|jpg|jpeg|svg|gif|webp|avif|ico"
INNER_PATTERNS = ["about", "a-propos", "company", "entreprise", "team", "equipe", "leadership", "management", "contact", "clients", "customers", "references", "services", "solutions", "products", "investors", "investisseurs", "finance", "press", "presse", "news"]
NO_LOGO = ["cookielaw.org", "onetrust.com", "cdn.cookielaw", "cdn.onetrust", "static/powered_by", "thumbnail", "campaign", "hero", "banner", "promo", "patient", "people", "employee", "story", "background", "movie", "video", "surf", "sport", "lifestyle", "powered_by", "static/ot_"]
OTHER_HOSTS = "help|support|status|developer|developers|adroll|ads|tracking|analytics|newsroom|legal|app"


def _usable(url: Column) -> Column:
    u = F.lower(url)
    return ~u.rlike(rf"\.(?:{ASSETS})$") & ~urls.external(u) & ~u.rlike(rf"^https?://(?:{OTHER_HOSTS})\.")


def website(markdown: Column, hint: Column) -> Column:
    """The company's site: a link that holds the hint (the name that its domain begins with), a bare URL
    that does, or else the first link; files, networks and side hosts don't count."""
    md, name = blank(markdown), F.lower(blank(hint))
    linked = F.filter(F.regexp_extract_all(md, F.lit(r"\]\((https?://[^)]+)\)"), F.lit(1)), _usable)
    bare = F.filter(F.regexp_extract_all(md, F.lit(r"""(https?://[a-zA-Z0-9.\-]+\.[a-z]{2,}(?:/[^\s)"'<>]*)?)"""), F.lit(1)), _usable)
    hinted = lambda links: F.get(F.filter(links, lambda u: F.lower(u).contains(name)), F.lit(0))
    return F.nullif(urls.site(F.coalesce(hinted(linked), hinted(bare), F.get(linked, F.lit(0)))), F.lit(""))


def logo(markdown: Column) -> Column:
    """The first image whose URL names a logo or brand and nothing that tells another picture."""
    found = F.regexp_extract_all(blank(markdown), F.lit(r"(?i)!\[[^\]]*\]\((https?://[^)]+(?:logo|brand)[^)]*)\)"), F.lit(1))
    return F.get(F.filter(found, lambda u: ~text_any(F.lower(u), NO_LOGO)), F.lit(0))


def text_any(c: Column, words: list[str]) -> Column:
    out = c.contains(words[0])
    for w in words[1:]:
        out = out | c.contains(w)
    return out


def inner_urls(markdown: Column, base: Column) -> Column:
    """map of pattern -> the first link of the site whose first pattern it is."""
    links = F.transform(F.regexp_extract_all(blank(markdown), F.lit(r"\[[^\]]*\]\((https?://[^)]+)\)"), F.lit(1)), lambda u: F.regexp_replace(F.trim(F.regexp_replace(u, r"""\s+["'].*$""", "")), r'[" ]+$', ""))
    host = urls.host(base)
    own = F.filter(links, lambda u: ~F.lower(u).rlike(rf"\.(?:{ASSETS})$") & ~urls.external(u) & ((host == "") | u.contains(host)))

    def taken(s: Column, u: Column, p: str) -> Column:
        return F.when(F.lower(u).contains(p) & ~F.exists(s, lambda x: x["key"] == p), F.struct(F.lit(p).alias("key"), u.alias("value")))

    # a link goes to its first pattern that no link before has taken
    step = lambda s, u: F.concat(s, F.array_compact(F.array(F.coalesce(*[taken(s, u, p) for p in INNER_PATTERNS]))))
    return F.map_from_entries(F.aggregate(own, F.array().cast("array<struct<key:string,value:string>>"), step))


def organisations(names: Column, own: Column, noise: list[str] = [], most: int = 25) -> Column:
    """Names of other organisations: 4 to 60 characters, not after a digit, at most one &, neither the
    company itself nor noise, each once, at most ``most``."""
    me = F.lower(blank(own))
    plain = F.filter(F.transform(names, squeeze), lambda n: F.char_length(n).between(4, 60) & ~n.rlike("^[0-9]") & (F.length(F.regexp_replace(n, "[^&]", "")) <= 1) & ~((me != "") & F.lower(n).contains(me)) & ~F.lower(n).isin(noise or [""]))
    return F.slice(distinct_by(plain, F.upper), 1, most)


def places(cities: Column, named: Column, most: int = 25) -> Column:
    """Cities of a contact page, then places named elsewhere, each once whatever its case."""
    return F.slice(distinct_by(F.filter(F.concat(F.coalesce(cities, F.array().cast("array<string>")), F.coalesce(named, F.array().cast("array<string>"))), lambda c: blank(c) != ""), F.upper), 1, most)


def key_metrics(c: Column) -> Column:
    """struct of the first hit of each metric."""
    return F.struct(*[first(c, p).alias(name) for name, p in METRICS])


def founded_year(c: Column) -> Column:
    return first(c, FOUNDED).cast("int")


def employees(c: Column) -> Column:
    return F.replace(first(c, EMPLOYEES), F.lit(","), F.lit(""))


def revenue(c: Column) -> Column:
    return squeeze_or_null(first(c, REVENUE))


def distinct_by(items: Column, key) -> Column:
    """The items whose key none before them has, in order; those without a key are left out.  Places are sorted
    by key, so that long lists take no more than sorting does."""

    def firsts(x: Column) -> Column:
        keyed = F.filter(F.transform(x, lambda y, i: F.struct(key(y).alias("key"), i.alias("at"))), lambda k: k["key"].isNotNull())
        fresh = let(F.sort_array(keyed), lambda s: F.filter(s, lambda k, i: (i == 0) | (k["key"] != F.get(s, i - 1)["key"])))
        return F.transform(F.sort_array(F.transform(fresh, lambda k: k["at"])), lambda at: F.get(x, at))

    return let(items, firsts)


def certifications(c: Column) -> Column:
    found = F.transform(F.regexp_extract_all(blank(c), F.lit(CERTIFICATION), F.lit(1)), squeeze)
    return distinct_by(found, lambda x: F.upper(F.replace(x, F.lit(" "), F.lit(""))))


def _phrases(c: Column, phrases: list[str]) -> Column:
    """A phrase's pattern is tried only where the text holds the phrase at all."""
    found = lambda low: F.array_compact(F.array(*[F.when(low.contains(p.lower()) & blank(c).rlike(rf"(?iU)\b{p}\b"), p) for p in phrases]))
    return let(F.lower(blank(c)), found)


def technologies(c: Column) -> Column:
    return _phrases(c, TECHNOLOGIES)


def sectors(c: Column) -> Column:
    return _phrases(c, SECTORS)


def address(c: Column) -> Column:
    """The first number with a street word and what follows, at most one more line of it, cut where a
    phone number or the like begins."""
    found = F.replace(first(c, rf"(?i)(\d{{1,4}}[,\s]+\b(?:{STREETS})\b[^\n]{{5,80}}(?:\n[^\n]{{5,60}})?)"), F.lit("\n"), F.lit(", "))
    cut = F.regexp_replace(found, r"(?is)(?:\s*[,\-]\s*(?:phone|tel|fax|email|www|http|\*|•|\|)|\s{2,}\*|\s{2,}•).*", "")
    return F.regexp_replace(F.trim(F.regexp_replace(cut, r"\s+,", ",")), r"[,\- ]+$", "")


def country(c: Column) -> Column:
    """By URL, then beside a word for an address, then the first of the list that is mentioned."""
    text = blank(c)
    tunisia = text.rlike(r"""https?://[^\s]*\.tn[/\s")]""") | text.rlike(r"(?i)(?:adresse|address|headquarter|siege|located)[^\n]{0,100}(?:Tunis\b|Tunisia)") | text.rlike(r"(?i)\d{4}\s+Tunis")
    # what follows each place word on its line, overlapping windows included; labels begin within 80 characters
    reach = 80 + max(len(label) for label, _ in COUNTRIES)
    windows = F.regexp_extract_all(text, F.lit(rf"(?i)(?:{PLACE_WORDS})(?=([^\n]{{0,{reach}}}))"), F.lit(1))

    def beside(w: Column) -> Column:
        return F.coalesce(*[F.when(F.exists(w, lambda x: F.left(x, F.lit(80 + len(label))).contains(label.lower())), name) for label, name in COUNTRIES])

    near = let(F.transform(windows, lambda x: F.lower(x)), lambda w: F.when(F.size(w) > 0, beside(w)))
    anywhere = let(F.lower(text), lambda low: F.coalesce(*[F.when(low.contains(label.lower()), name) for label, name in COUNTRIES]))
    return F.coalesce(F.when(tunisia, "Tunisia"), near, anywhere)


def company_name(c: Column) -> Column:
    """The first part of a title, at the first separator of the list that it has; empty if generic."""
    name = squeeze(c)
    parts = [F.when(name.contains(s), F.get(F.filter(F.transform(F.split(name, rf"\Q{s}\E"), squeeze), lambda x: x != ""), F.lit(0))) for s in NAME_SEPARATORS]
    name = F.coalesce(*parts, name)
    return F.when((F.char_length(name) < 3) | F.lower(name).isin(GENERIC_NAMES), "").otherwise(name)


def meta(html: Column, attribute: str, value: str) -> Column:
    """The content of the first meta element with that attribute; empty if none."""
    named = rf"""\b{attribute}\s*=\s*["']\Q{value}\E["']"""
    content = r"""\bcontent\s*=\s*["']([^"']*)["']"""
    found = lambda pattern: let(F.regexp_extract(blank(html), pattern, 1), lambda v: F.nullif(v, F.lit("")))
    return squeeze(F.coalesce(found(rf"(?is)<meta\s[^>]*{named}[^>]*{content}"), found(rf"(?is)<meta\s[^>]*{content}[^>]*{named}")))


def company_of_page(html: Column, url: Column) -> Column:
    """struct (company_name, domain, aliases, description) of a home page; the domain's name where the
    page has none or only a slogan."""
    domain = urls.source_host(url)
    fallback = urls.company_of_domain(domain)
    title = lambda tag: first(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>")
    found = [meta(html, "property", "og:site_name"), title("title"), meta(html, "property", "og:title"), title("h1")]
    first_name = F.coalesce(*[F.nullif(let(squeeze(x), lambda v: company_name(v)), F.lit("")) for x in found], fallback)
    slogan = lambda n: (F.size(F.split(n, " ")) > 4) | (F.lower(n) == n) | (F.char_length(n) > 50)
    named = let(first_name, lambda n: F.when(slogan(n), fallback).otherwise(n))
    description = F.coalesce(F.nullif(meta(html, "name", "description"), F.lit("")), meta(html, "property", "og:description"))
    aliases = lambda n: F.filter(F.array_distinct(F.array(n, F.substring_index(domain, ".", 1), fallback)), lambda x: F.char_length(x) >= 2)
    return let(named, lambda n: F.struct(n.alias("company_name"), domain.alias("domain"), aliases(n).alias("aliases"), description.alias("description")))


def leaders(items: Column) -> Column:
    """array<struct> of those who lead now, of array<array<string>> (name, title, more...).  Firms are
    known by whole words of their names."""

    def told(parts: Column) -> Column:
        title = F.lower(squeeze(F.get(parts, F.lit(1))))
        has = lambda *ts: F.exists(F.array(*[F.lit(t) for t in ts]), lambda t: title.contains(t))
        aged = F.get(F.filter(parts, lambda p: F.lower(p).contains("ans")), F.lit(0))
        born = F.get(F.filter(parts, lambda p: p.rlike(r"\d{2}/\d{4}|\d{4}") & ~F.lower(p).contains("ans")), F.lit(0))
        return F.struct(
            squeeze(F.get(parts, F.lit(0))).alias("name"),
            squeeze(F.get(parts, F.lit(1))).alias("title"),
            F.nullif(F.regexp_extract(aged, r"(?i)(\d{2})\s*ans", 1), F.lit("")).cast("int").alias("age"),
            first(born, r"(\d{2}/\d{4}|\d{4})").alias("born"),
            has("pdg", "président du conseil", "président-directeur").alias("is_chair"),
            has("directeur général", "directrice générale", "dg", "ceo").alias("is_chief"),
            (has(*LEADER_TITLES) & ~has(*FORMER_TITLES) & ~title.rlike(r"^\(.*\)$")).alias("leads"),
        )

    people = F.transform(F.filter(items, lambda p: F.size(p) >= 2), told)
    people = F.filter(people, lambda p: p["leads"] & ~F.upper(p["name"]).rlike(rf"\b(?:{'|'.join(ENTITIES)})\b"))
    people = distinct_by(people, lambda p: F.concat_ws("\n", F.lower(p["name"]), F.lower(p["title"])))
    return F.transform(people, lambda p: F.struct(*[p[k].alias(k) for k in ("name", "title", "age", "born", "is_chair", "is_chief")]))


# Fixed values.
PERSON = r"([A-Z][a-z]{1,20}\s+[A-Z]{2,15}(?:\s+[A-Z]{2,15})?)\s+(CEO|CTO|CFO|COO|CMO|CIO|CISO|Co-CEO|Chairman|President|Director General|Managing Director|Legal|Finance|Operations?|Compliance|Risk|Europe\s*(?:&|and)?\s*UK|APAC|Americas|Market\s+Operations?)"
JOB = r"(?i)\b(?:CEO|CTO|CFO|COO|CMO|CSO|CIO|CISO|CPO|CRO|Chairman|President|Vice[- ]President|VP|Managing\s+Director|Executive\s+Director|General\s+Manager|Head\s+of\s+\w+(?:\s+\w+)?|Director(?:\s+(?:General|of\s+\w+(?:\s+\w+)?))?|Directeur(?:\s+Général)?|Président(?:\s+Directeur\s+Général)?|PDG|DG|(?:Legal|Finance|Operations?|Compliance|Risk|Sales|Marketing)\s+(?:Director|Manager|Lead)?)\b"
NO_PERSON = ["LINKEDIN", "TWITTER", "YOUTUBE", "FACEBOOK", "INSTAGRAM", "MICROSOFT", "GOOGLE", "SWIFT", "ISO", "SOC", "API", "EMIR", "CSR"]
NAV_WORDS = "Capital Markets|Insurance|Banking|Solutions|Products|Services|Company|About|Contact|Partners|Resources|News|Blog|Technology|Platform|Clients|Team|Management|Leadership|Careers|Events|Press|Media"
NAV_LINE = rf"(?i)^(?:Skip to (?:content|main)|(?:{NAV_WORDS})\s*(?:Close|Open)?\s*[>|]?\s*){{3,}}$"


def team_leaders(text: Column, persons: Column) -> Column:
    """array<struct<name, title>>: "First LAST title" in the text, then the landed persons(name, context)
    with a title beside them; each name once whatever its case."""
    group = lambda k: F.regexp_extract_all(blank(text), F.lit(PERSON), F.lit(k))
    told = F.transform(F.arrays_zip(group(1).alias("name"), group(2).alias("title")), lambda x: F.struct(F.trim(x["name"]).alias("name"), F.trim(x["title"]).alias("title")))
    told = F.filter(told, lambda x: F.char_length(x["name"]) > 5)
    named = F.transform(F.filter(persons, lambda p: (F.char_length(p["name"]) >= 6) & ~p["name"].rlike(r"[&@#\d]")), lambda p: F.struct(p["name"].alias("name"), F.trim(F.regexp_extract(blank(p["context"]), JOB, 0), F.lit(" .,")).alias("title")))
    both = F.concat(told, F.filter(F.coalesce(named, F.array().cast("array<struct<name:string,title:string>>")), lambda x: x["title"] != ""))
    return distinct_by(F.filter(both, lambda x: ~F.upper(x["name"]).isin(NO_PERSON)), lambda x: F.upper(x["name"]))


def without_menu(text: Column) -> Column:
    """A page's text from its own beginning on: after "Careers Home" where that comes late in a compact
    text, else without the menu lines among its first twenty."""
    c = blank(text)
    at = F.regexp_instr(c, F.lit(r"\bCareers\s+Home\b"))
    compact = F.trim(F.regexp_extract(F.substring(c, at, F.char_length(c)), r"(?s)^Careers\s+(.*)$", 1))
    lines = F.transform(F.split(c, "\n"), lambda x: F.trim(x))
    # 0 blank, 1 menu, 2 other; the cut comes after the last menu line before another line follows one
    kinds = F.transform(F.slice(lines, 1, 20), lambda x: F.when(x == "", 0).when(x.rlike(NAV_LINE), 1).otherwise(2))
    state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("cut"), F.lit(False).alias("done"))

    def step(s: Column, k: Column) -> Column:
        here = s["at"] + 1
        menu = (k == 1) & ~s["done"]
        return F.struct(here.alias("at"), F.when(menu, here).otherwise(s["cut"]).alias("cut"), (s["done"] | ((k == 2) & (s["cut"] > 0))).alias("done"))

    cut = F.aggregate(kinds, state, step, lambda s: s["cut"])
    rest = let(cut, lambda n: F.trim(F.array_join(F.slice(F.split(c, "\n"), n + 1, F.size(lines)), "\n"), F.lit(" \n\t\r")))
    return F.when(at > 301, compact).otherwise(rest)
