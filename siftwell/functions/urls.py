"""URL functions, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siftwell.functions.text import blank, let

# Fixed values.
COMPOUND = ["co.uk", "co.jp", "co.kr", "com.br", "com.au", "com.ar", "com.mx"]
GENERIC = ["google.com", "linkedin.com", "facebook.com", "twitter.com", "instagram.com", "youtube.com", "wikipedia.org"]
LOCALES = "fr-fr|en-us|en-gb|de-de|es-es|it-it|nl-nl|pt-br|zh-cn|ja-jp"
UNWANTED_TOKENS = ["privacy", "cookie", "cookies", "legal", "mentions", "terms", "gdpr", "rgpd", "cgu", "cgv", "disclaimer", "impressum", "confidentialite", "politique", "sitemap", "login", "signin", "register", "cart", "panier", "checkout", "dashboard", "my-account", "mon-compte", "sav", "helpdesk", "faq"]
UNWANTED_PARTS = ["accueil"]
EXTERNAL = ["facebook.com", "twitter.com", "instagram.com", "youtube.com", "linkedin.com", "google.com", "apple.com", "play.google.com", "maps.google", "goo.gl", "bit.ly", "tiktok.com", "pinterest.com", "whatsapp.com", "telegram.org", "adroll.com"]

FILE_TLDS = ["com", "tn", "fr", "net", "org", "ai", "tech", "io"]
ASSET_EXTENSIONS = "png|jpg|jpeg|svg|gif|webp|avif|pdf|ico|mp4|mp3|zip|css|js|woff|woff2"


def _strip_slashes(c: Column) -> Column:
    return F.regexp_replace(c, "/+$", "")


def host(url: Column) -> Column:
    return F.regexp_extract(blank(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(blank(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def without_query(url: Column) -> Column:
    return _strip_slashes(F.substring_index(blank(url), "?", 1))


def validated(url: Column) -> Column:
    """scheme://host/path of an http(s) URL, else the empty string."""
    return _strip_slashes(F.regexp_extract(F.trim(blank(url)), r"^(https?://[^/?#]+[^?#]*)", 1))


def normalized(url: Column) -> Column:
    return _strip_slashes(F.regexp_replace(F.regexp_replace(blank(url), "#.*$", ""), "([^:])//+", "$1/"))


def with_scheme(url: Column) -> Column:
    u = F.trim(blank(url))
    return F.when(u.rlike("^https?://"), u).otherwise(F.concat(F.lit("https://"), u))


def site(url: Column) -> Column:
    return F.substring_index(blank(url), "/", 3)


def slug(url: Column) -> Column:
    s = F.regexp_replace(path(url), r"\.[a-z]{2,4}$", "")
    s = F.regexp_replace(F.translate(s, "-_/", "   "), r"\b\d+\b", "")
    return F.lower(F.trim(F.regexp_replace(s, r"\s+", " ")))


def file_name(url: Column) -> Column:
    return F.translate(_strip_slashes(F.regexp_replace(blank(url), "^https?://", "")), "/.", "__")


def domain(url: Column) -> Column:
    h = F.regexp_replace(F.split(F.lower(host(with_scheme(url))), ":")[0], r"^www\.", "")
    return F.when(h.contains(".") & (F.char_length(h) >= 4), h).otherwise("")


def root_domain(d: Column) -> Column:
    parts = F.split(blank(d), r"\.")
    last = lambda n: F.array_join(F.slice(parts, -n, n), ".")
    return F.when((F.size(parts) >= 3) & last(2).isin(COMPOUND), last(3)).when(F.size(parts) >= 2, last(2)).otherwise(d)


def source_host(url: Column) -> Column:
    return F.replace(host(url), F.lit("www."), F.lit(""))


def internal(url: Column, base: Column) -> Column:
    return (blank(base) == "") | source_host(url).contains(source_host(base))


def locale_only(url: Column) -> Column:
    return blank(url).rlike(rf"(?i)^https?://[^/]+/(?:{LOCALES})/?$")


def unwanted(text: Column, slug_: Column) -> Column:
    joined = F.lower(F.concat(blank(text), F.lit(" "), blank(slug_)))
    parts = [joined.contains(p) for p in UNWANTED_PARTS]
    return F.arrays_overlap(F.split(joined, r"[\s/]+"), F.array(*[F.lit(t) for t in UNWANTED_TOKENS])) | parts[0]


def absolute(href: Column, page: Column) -> Column:
    """A link of a page as an absolute URL, as RFC 3986 resolves it; links of other schemes stay."""
    # "." and ".." are taken out from the left; at the end they leave a slash
    step = lambda s, p: F.when(p == ".", s).when(p == "..", F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0)))).otherwise(F.concat(s, F.array(p)))

    def joined(parts: Column) -> Column:
        kept = F.aggregate(parts, F.array().cast("array<string>"), step)
        return let(kept, lambda k: F.concat(F.array_join(k, "/"), F.when(F.get(parts, F.size(parts) - 1).isin(".", "..") & (F.size(k) > 0), "/").otherwise("")))

    def resolved(h: Column, base: Column) -> Column:
        root = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
        folder = F.when(path(base) == "", "/").otherwise(F.regexp_replace(path(base), "[^/]*$", ""))
        to = F.regexp_replace(h, "[?#].*$", "")
        # below the root, without its slash
        target = F.when(to.startswith("/"), to).otherwise(F.concat(folder, to))
        return F.concat(root, F.lit("/"), let(F.split(F.substring(target, 2, 1 << 30), "/"), joined), F.regexp_extract(h, "[?#].*$", 0))

    def of(h: Column, base: Column) -> Column:
        return (
            F.when(h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), h)
            .when(h == "", base)
            .when(h.startswith("//"), F.concat(F.substring_index(base, ":", 1), F.lit(":"), h))
            .when(h.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), h))
            .when(h.startswith("?"), F.concat(F.regexp_extract(base, r"^[^?#]*", 0), h))
            .otherwise(resolved(h, base))
        )

    # both are bound once: branches share nothing
    return let(F.struct(F.regexp_replace(F.trim(blank(href)), "[\t\r\n]", "").alias("h"), blank(page).alias("base")), lambda x: of(x["h"], x["base"]))


def asset(url: Column) -> Column:
    """A file that a page shows or loads, by its extension."""
    return F.lower(path(url)).rlike(rf"\.(?:{ASSET_EXTENSIONS})$")


def is_web(url: Column) -> Column:
    return blank(url).rlike("(?i)^https?://")


def external(url: Column) -> Column:
    """A social network, shop or the like."""
    return F.lower(blank(url)).rlike("|".join(d.replace(".", r"\.") for d in EXTERNAL))


def of_file_name(name: Column) -> Column:
    """The address that a page was landed from, by a file name like www_acme_com_about.md: what follows the
    first part that is a top-level domain is its path."""
    parts = F.split(F.regexp_replace(F.replace(name, F.lit(".md"), F.lit("")), "_+$", ""), "_")
    tld = F.transform(parts, lambda p: F.lower(p).isin(FILE_TLDS))
    at = F.array_position(tld, F.lit(True)).cast("int")
    ends = F.when(at > 0, at).otherwise(F.size(parts))
    path_ = F.array_join(F.slice(parts, ends + 1, F.size(parts)), "/")
    return F.concat(F.lit("https://"), F.array_join(F.slice(parts, 1, ends), "."), F.when(path_ != "", F.concat(F.lit("/"), path_)).otherwise(""))


def company_domain(url: Column) -> Column:
    """The domain of a company's site; empty for those that are everyone's."""
    d = domain(url)
    return F.when(d.isin(GENERIC), "").otherwise(d)


def company_of_domain(d: Column) -> Column:
    return F.initcap(F.lower(F.translate(F.substring_index(blank(d), ".", 1), "-_", "  ")))
