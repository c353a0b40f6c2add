"""Companies against market quotes and registry entries: joins of alike names, scores, the best candidate, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftwell.functions import company, fuzzy, shredding, urls
from siftwell.functions.text import blank
from siftwell.operators import names

# Fixed values.
ISO2 = {
    "AE": ["uae", "united arab emirates"], "AU": ["australia", "australie"], "BE": ["belgium", "belgique"], "BR": ["brazil", "bresil"], "CA": ["canada"],
    "CH": ["switzerland", "suisse"], "CN": ["china", "chine"], "DE": ["germany", "allemagne"], "EG": ["egypt", "egypte"], "ES": ["spain", "espagne"],
    "FR": ["france", "french"], "GB": ["uk", "united kingdom"], "HK": ["hong kong"], "IN": ["india", "inde"], "IT": ["italy", "italie"],
    "JP": ["japan", "japon"], "MA": ["morocco", "maroc"], "NL": ["netherlands", "pays bas"], "SA": ["saudi arabia", "arabie saoudite"], "SE": ["sweden", "suede"],
    "SG": ["singapore", "singapour"], "TN": ["tunisia", "tunisie"], "US": ["usa", "united states", "etats unis", "us"],
}
STREET_WORDS = ["rue", "avenue", "boulevard", "place", "chemin", ""]
FRANCE = ["france", "fr", "french"]

PREFILTER, LEAST_QUOTE, LEAST_REGISTRY = 0.20, 0.35, 0.50


def iso2(country: Column) -> Column:
    """The two letters of a country that is known by name; empty if it isn't."""
    name = company.plain_words(country)
    out = F.when(F.lit(False), "")
    for code, known in ISO2.items():
        out = out.when(name.isin(known), code)
    return out.otherwise("")


def city(address: Column, country: Column) -> Column:
    """The last part between commas that is no country, number or scrap; without commas what is left of
    the last five words without the country."""
    land = company.plain_words(country)
    parts = F.reverse(F.transform(F.split(blank(address), ","), lambda p: F.trim(p)))
    plain = company.plain_words
    ok = F.filter(parts, lambda p: (F.char_length(plain(p)) >= 3) & ~((land != "") & plain(p).contains(land)) & ~plain(p).rlike(r"^[\d\-\s]+$"))
    words = F.filter(F.split(blank(address), r"\s+"), lambda w: w != "")
    tail = F.array_join(F.slice(words, F.greatest(F.size(words) - 4, F.lit(1)), 5), " ")
    name = F.lower(F.trim(blank(country)))
    rest = F.array_join(F.filter(F.split(tail, " "), lambda w: F.lower(w) != name), " ")
    rest = F.when(F.char_length(plain(rest)) >= 3, rest).otherwise("")
    return F.when(blank(address).contains(",") & (F.size(ok) > 0), F.get(ok, F.lit(0))).otherwise(rest)


def match_score(domain: Column, name: Column, exchange: Column, kind: Column) -> Column:
    """One score of the four; the domain's counts only where there is any."""
    return F.round(F.when(domain > 0, 0.50 * domain + 0.30 * name + 0.15 * exchange + 0.05 * kind).otherwise(0.55 * name + 0.30 * exchange + 0.15 * kind), 4)


def level(score: Column) -> Column:
    return F.when(score >= 0.80, "excellent").when(score >= 0.60, "bon").when(score.isNotNull(), "moyen")


def _words(name: Column) -> Column:
    return F.filter(F.split(company.plain_name(name), " "), lambda w: F.char_length(w) >= 3)


def _scored(companies: DataFrame, quotes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of companies that score alike (one_of, company_id), and their candidates (one_of, symbol,
    score, method).  Quotes that score alike are one, the first symbol."""
    asked = companies.select("company_id", blank(F.col("name")).alias("name"), urls.company_domain(F.col("url")).alias("domain"), iso2(F.col("country")).alias("iso"))
    traits = ["name", "domain", "iso"]
    root = lambda d: urls.root_domain(F.col(d))
    brand = lambda r: F.substring_index(r, ".", 1)
    # what scores need is made once for a class, before the join
    classes = asked.groupBy(*traits).agg(F.min("company_id").alias("one_of"))
    called = F.when(F.col("name") == "", brand("root")).otherwise(F.col("name"))
    known = classes.withColumn("root", root("domain")).withColumn("plain", company.plain_name(called))
    members = asked.join(classes, traits).select("one_of", "company_id")
    told = ["longname", "shortname", "exchange", "quote_type", "website"]
    offers = quotes.groupBy(*told).agg(F.min("symbol").alias("symbol")).withColumn("found", urls.domain(F.col("website"))).withColumn("found_root", root("found"))
    offers = offers.withColumns({"plain_long": company.plain_name(F.col("longname")), "plain_short": company.plain_name(F.col("shortname"))})

    def sets(df: DataFrame, key: str, of_root: str, *plain: str) -> DataFrame:
        words = [F.filter(F.split(n, " "), lambda w: F.char_length(w) >= 3) for n in plain]
        return df.select(F.col(key).alias("id"), F.explode(F.array(F.array(brand(of_root)), *words)).alias("words"))

    found = names.pairs(sets(known, "one_of", "root", "plain"), sets(offers, "symbol", "found_root", "plain_long", "plain_short"))
    found = found.select(F.col("left_id").alias("one_of"), F.col("right_id").alias("symbol")).join(known, "one_of").join(offers, "symbol")
    found = found.withColumn("long", fuzzy.plain_score(F.col("plain"), F.col("plain_long"))).withColumn("short", fuzzy.plain_score(F.col("plain"), F.col("plain_short")))
    found = found.withColumn("spelled", fuzzy.ratio(brand("root"), brand("found_root")))
    by_name = F.greatest("long", "short")
    by_domain = company.hosts_score(F.col("domain"), F.col("root"), F.col("found"), F.col("found_root"), F.col("spelled"))
    found = found.select("one_of", "symbol", "domain", by_name.alias("by_name"), by_domain.alias("by_domain"), company.exchange_score(F.col("exchange"), F.col("iso")).alias("of_exchange"), company.type_score(F.col("quote_type")).alias("of_kind"))
    by_name = F.col("by_name")
    score = match_score(F.col("by_domain"), by_name, F.col("of_exchange"), F.col("of_kind"))
    method = F.when((F.col("domain") != "") & (by_name >= PREFILTER), "domain").otherwise("name_country")
    return members, found.select("one_of", "symbol", score.alias("score"), method.alias("method"))


def quote_candidates(companies: DataFrame, quotes: DataFrame) -> DataFrame:
    """companies(company_id, url, name, country) with the quotes(symbol, longname, shortname, exchange,
    quote_type, website) whose names or domains' brands are like theirs (see ``names``): (company_id,
    symbol, score, method).  Of quotes that are equal but for the symbol the first stands for all."""
    members, found = _scored(companies, quotes)
    return members.join(found, "one_of").select("company_id", "symbol", "score", "method")


def match_quotes(companies: DataFrame, quotes: DataFrame, least: float = LEAST_QUOTE) -> DataFrame:
    """``best_quotes`` of ``quote_candidates``, chosen once for all companies that score alike."""
    members, found = _scored(companies, quotes)
    best = best_quotes(found.withColumnRenamed("one_of", "company_id"), least).withColumnRenamed("company_id", "one_of")
    return members.join(best, "one_of").drop("one_of")


def best_quotes(candidates: DataFrame, least: float = LEAST_QUOTE) -> DataFrame:
    """(company_id, symbol, score, method, level): the best candidate by domain, or else by name; none
    under ``least``.  Of equals the first symbol."""
    enough = candidates.where(F.col("score") >= least)
    order = F.struct((F.col("method") != "domain").cast("int").alias("m"), (-F.col("score")).alias("s"), F.col("symbol"))
    best = enough.groupBy("company_id").agg(F.min_by(F.struct("symbol", "score", "method"), order).alias("b"))
    return best.select("company_id", "b.*").withColumn("level", level(F.col("score")))


def postcode(address: Column) -> Column:
    return F.nullif(F.regexp_extract(blank(address), r"\b(\d{5})\b", 1), F.lit(""))


def town(address: Column) -> Column:
    """The capitalised words after a postcode."""
    return F.nullif(F.trim(F.regexp_replace(F.regexp_extract(blank(address), r"\d{5}\s+([A-ZÀÂÄÉÈÊËÏÎÔÙÛÜ][A-Za-zÀ-ÿ\s\-]+)", 1), r"\s+", " ")), F.lit(""))


def registry_score(name: Column, entry_name: Column, address: Column, entry_address: Column) -> Column:
    """struct (score, level) of a registry entry for a company: 60 for the same name, 25 for one in the
    other, up to 15 for shared words; 40 for the same postcode, or 20 for a word of the address."""
    a, b = F.lower(F.trim(blank(name))), F.lower(F.trim(blank(entry_name)))
    words = lambda c: F.array_distinct(F.filter(F.split(c, r"\s+"), lambda w: w != ""))
    shared = F.floor(15 * F.size(F.array_intersect(words(a), words(b))) / F.greatest(F.size(words(a)), F.size(words(b)), F.lit(1)))
    by_name = F.when(a == b, 60).when(a.contains(b) | b.contains(a), 25).otherwise(shared)
    places = lambda c: F.array_except(words(F.regexp_replace(F.lower(blank(c)), r"\d", "")), F.array(*[F.lit(w) for w in STREET_WORDS]))
    by_place = F.when(postcode(address) == postcode(entry_address), 40).when(F.arrays_overlap(places(address), places(entry_address)), 20).otherwise(0)
    score = F.least(by_name + F.when(blank(address) == "", 0).otherwise(by_place), F.lit(100)).cast("int")
    return F.struct(score.alias("score"), F.when(score >= 80, "excellent").when(score >= 50, "moyen").otherwise("faible").alias("level"))


def best_entries(companies: DataFrame, registry: DataFrame) -> DataFrame:
    """companies(company_id, name, address) with the best of registry(entry_id, entry_name, entry_address):
    (company_id, entry_id, score, level).

    Entries with a name like the company's (see ``names``) are compared, and of those that share its
    postcode the first, which stands for all that share nothing else.  Companies, and entries, of one
    name and address are compared once; of equal entries the first counts.
    """
    asked = companies.select("company_id", blank(F.col("name")).alias("name"), blank(F.col("address")).alias("address"))
    classes = asked.groupBy("name", "address").agg(F.min("company_id").alias("one_of"))
    entries = registry.groupBy(blank(F.col("entry_name")).alias("entry_name"), blank(F.col("entry_address")).alias("entry_address")).agg(F.min("entry_id").alias("entry_id"))
    by_name = names.pairs(classes.select(F.col("one_of").alias("id"), _words(F.col("name")).alias("words")), entries.select(F.col("entry_id").alias("id"), _words(F.col("entry_name")).alias("words")))
    first = entries.groupBy(postcode(F.col("entry_address")).alias("code")).agg(F.min("entry_id").alias("entry_id"))
    by_place = classes.select("one_of", postcode(F.col("address")).alias("code")).join(first, "code").select("one_of", "entry_id")
    found = by_name.toDF("one_of", "entry_id").unionByName(by_place).distinct().join(classes, "one_of").join(entries, "entry_id")
    scored = found.select("one_of", "entry_id", registry_score(F.col("name"), F.col("entry_name"), F.col("address"), F.col("entry_address")).alias("s"))
    best = scored.groupBy("one_of").agg(F.min_by(F.struct("entry_id", "s.score", "s.level"), F.struct((-F.col("s.score")).alias("s"), F.col("entry_id"))).alias("b"))
    return asked.join(classes, ["name", "address"]).join(best, "one_of").select("company_id", "b.*")


def route(companies: DataFrame, entries: DataFrame, quotes: DataFrame) -> DataFrame:
    """(company_id, source, key, confidence): the registry for companies of France, the market for
    others and where the registry has none; ``source`` says what was asked and whether it answered."""
    country, name, url = (F.lower(F.trim(blank(F.col(c)))) for c in ("country", "name", "url"))
    asked = companies.select("company_id", country.isin(FRANCE).alias("is_french"), ((name == "") & (url == "")).alias("no_keys"))
    known = entries.where(F.col("score") >= 100 * LEAST_REGISTRY).select("company_id", F.col("entry_id").cast("string").alias("entry"), (F.col("score") / 100).alias("registry"))
    market = quotes.where(F.col("score") >= LEAST_QUOTE).select("company_id", "symbol", F.col("score").alias("quote"))
    both = asked.join(known, "company_id", "left").join(market, "company_id", "left")
    by_registry = F.col("is_french") & F.col("entry").isNotNull()
    answer = F.when(F.col("symbol").isNotNull(), "market").otherwise("market_no_match")
    source = F.when(F.col("no_keys"), "no_keys").when(by_registry, "registry").when(F.col("is_french"), F.concat(F.lit("registry_fallback_"), answer)).otherwise(answer)
    value = lambda a, b: F.when(F.col("no_keys"), None).when(by_registry, F.col(a)).otherwise(F.col(b))
    return both.select("company_id", source.alias("source"), value("entry", "symbol").alias("key"), value("registry", "quote").alias("confidence"))


def quotes_of(answer: Column, kind: str) -> Column:
    """The quotes of a search's JSON answer, which has one of three layouts, as an array of ``kind``."""
    paths = ["$.finance.result[0].quotes", "$.finance.result.quotes", "$.result[0].quotes", "$.result.quotes", "$.quotes"]
    return F.from_json(F.coalesce(*[F.get_json_object(answer, p) for p in paths], F.lit("[]")), f"array<{kind}>")


# What a market answer tells of a company, by type.
INFO = {
    "string": ["longName", "shortName", "sector", "industry", "country", "city", "website", "currency", "recommendationKey", "longBusinessSummary"],
    "bigint": ["fullTimeEmployees", "marketCap", "numberOfAnalystOpinions"],
    "double": ["totalRevenue", "ebitda", "netIncomeToCommon", "totalDebt", "totalCash", "grossMargins", "operatingMargins", "profitMargins", "revenueGrowth", "earningsGrowth", "debtToEquity", "returnOnEquity", "trailingPE", "forwardPE", "regularMarketPrice", "52WeekChange", "dividendYield"],
}


def quote_info(answers: DataFrame) -> DataFrame:
    """answers(symbol, json) -> (symbol, the fields of INFO, margins and growth as percents, info): null
    where the answer has nothing of that type; ``info`` is the JSON of what it has."""
    fields = {name: (f"$['{name}']", kind) for kind, names in INFO.items() for name in names}
    read = answers.select("symbol", shredding.shred(F.col("json"), fields).alias("i")).select("symbol", "i.*")
    shown = {f"{c}_pct": percent(F.col(c)) for c in ("grossMargins", "operatingMargins", "profitMargins")} | {"revenueGrowth_pct": percent(F.col("revenueGrowth"), signed=True)}
    read = read.withColumns(shown)
    names = [*fields, *shown]
    return read.select("symbol", *[F.col(f"`{n}`") for n in names], "rejected", F.to_json(F.struct(*[F.col(f"`{n}`") for n in names])).alias("info"))


def percent(value: Column, signed: bool = False) -> Column:
    """.123 as 12.3%; halves go to the even digit."""
    return F.when(value.isNotNull(), F.format_string("%+.1f%%" if signed else "%.1f%%", F.bround(value.cast("double") * 100, 1)))
