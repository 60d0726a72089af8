"""Column functions for URLs, by patterns alone: the engine's own URL parser fails on spaces and odd ports."""

from __future__ import annotations

from urllib.parse import urlencode

from pyspark.sql import Column, functions as F

from .text import text

#: The listing site, and where its ids stand in paths and URNs: fixed values.
LISTING_SITE = "linkedin.com"
LISTING_PATH = r"/jobs/view/(?:[^/?#]*-)?(\d+)(?:[/?#]|$)"
LISTING_URN = r"urn:li:jobPosting:(\d+)"
#: Query parameters that name no resource: fixed values, spelt as they must be.
TRACKING_KEYS = ("currentjobid", "e_bp", "mcid", "midtoken", "lipi", "pagenum", "recommendedflavor", "originalsubdomain", "position", "refid", "referencid", "trackingid", "trk")
_PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, _PARTS, k)


def hostname(url: Column) -> Column:
    """Lower case, without user, port and brackets; empty if there is none."""
    server = F.lower(F.regexp_replace(_part(url, 2), "^.*@", ""))
    return F.when(server.startswith("["), F.regexp_extract(server, r"^\[([^\]]*)\]", 1)).otherwise(F.regexp_extract(server, "^[^:]*", 0))


def port(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(_part(url, 2), "^.*@", ""), r"^(?:\[[^\]]*\]|[^:\[]*):(\d+)$", 1)


def host_within(host: Column, domain: str) -> Column:
    return (host == domain) | host.endswith("." + domain)


def form_encoded(c: Column) -> Column:
    """As HTML forms encode: a tilde stays, an asterisk doesn't."""
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def query_pairs(query: Column) -> Column:
    """The parameters as an array of (key, value), decoded; one without '=' has an empty value."""
    some = F.filter(F.split(query, "&"), lambda p: p != "")
    return F.transform(some, lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("key"), F.when(F.instr(p, F.lit("=")) > 0, _decoded(F.substr(p, F.instr(p, F.lit("=")) + 1))).otherwise("").alias("value")))


def canonicalize_url(c: Column) -> Column:
    """Scheme (https if missing) and host in lower case; no user, default port, fragment, tracking parameters, doubled or
    closing slashes; parameters sorted. Listing pages of the listing site become their short form. Blank is null; what
    has no host stays as it is."""
    t = text(c)
    url = F.when(t.contains("://"), t).otherwise(F.concat(F.lit("https://"), F.regexp_replace(t, "^/+", "")))
    scheme, host, number = F.lower(_part(url, 1)), hostname(url), port(url)
    path = F.regexp_replace(F.coalesce(F.nullif(_part(url, 3), F.lit("")), F.lit("/")), "/{2,}", "/")
    listing = F.regexp_extract(path, LISTING_PATH, 1)
    default = ((scheme == "http") & (number == "80")) | ((scheme == "https") & (number == "443")) | (number == "")
    server = F.concat(F.when(host.contains(":"), F.concat(F.lit("["), host, F.lit("]"))).otherwise(host), F.when(default, "").otherwise(F.concat(F.lit(":"), number)))
    kept = F.filter(query_pairs(_part(url, 4)), lambda p: ~F.lower(p["key"]).isin(*TRACKING_KEYS) & ~F.lower(p["key"]).startswith("utm_"))
    query = F.array_join(F.transform(F.array_sort(kept), lambda p: F.concat(form_encoded(p["key"]), F.lit("="), form_encoded(p["value"]))), "&")
    plain = F.concat(scheme, F.lit("://"), server, F.when(path == "/", path).otherwise(F.regexp_replace(path, "/+$", "")), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    short = F.concat(F.lit(f"https://www.{LISTING_SITE}/jobs/view/"), listing, F.lit("/"))
    return F.when(host == "", url).when(host_within(host, LISTING_SITE) & (listing != ""), short).otherwise(plain)


def _current_id(url: Column) -> Column:
    found = F.filter(query_pairs(_part(url, 4)), lambda p: (F.lower(p["key"]) == "currentjobid") & p["value"].rlike(r"^\d+$"))
    return F.get(found, F.lit(0))["value"]


def extract_source_job_id(c: Column) -> Column:
    """The listing site's numeric id in a URL's path, or else in its query."""
    t = text(c)
    return F.coalesce(F.nullif(F.regexp_extract(_part(t, 3), LISTING_PATH, 1), F.lit("")), _current_id(t))


def extract_listing_id(*columns: Column) -> Column:
    """The first id in the values: all digits, a URN, a path or a query."""

    def one(c: Column) -> Column:
        t = text(c)
        return F.coalesce(F.when(t.rlike(r"^\d+$"), t), F.nullif(F.regexp_extract(t, LISTING_URN, 1), F.lit("")), F.nullif(F.regexp_extract(t, LISTING_PATH, 1), F.lit("")), _current_id(t))

    return F.coalesce(*map(one, columns))


def listing_url(listing_id: Column, url: Column) -> Column:
    """The short form by id, or else the URL, made absolute."""
    origin = F.lit(f"https://www.{LISTING_SITE}")
    absolute = F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), url).when(url.startswith("//"), F.concat(F.lit("https:"), url)).when(url.startswith("/"), F.concat(origin, url)).otherwise(F.concat(origin, F.lit("/"), url))
    return F.when(listing_id.isNotNull(), F.concat(origin, F.lit("/jobs/view/"), listing_id, F.lit("/"))).otherwise(absolute)


def is_absolute(c: Column) -> Column:
    return c.rlike(r"^(?i:https?)://[^/?#]+")


#: Codes of search filters: fixed values.
DATE_CODES = {"past_24_hours": "r86400", "past_week": "r604800", "past_month": "r2592000"}
EXPERIENCE_CODES = {"internship": "1", "entry": "2", "associate": "3", "mid_senior": "4", "director": "5", "executive": "6"}
WORKPLACE_CODES = {"on_site": "1", "remote": "2", "hybrid": "3"}
EMPLOYMENT_CODES = {"full_time": "F", "part_time": "P", "contract": "C", "temporary": "T", "volunteer": "V", "internship": "I", "other": "O"}


def search_url(keywords: str, location: str, filters: dict) -> str:
    """A search page's URL; unknown filter values are left out."""
    query = {"keywords": keywords, "location": location}
    if code := DATE_CODES.get(filters.get("date_posted", "any")):
        query["f_TPR"] = code
    for name, field, codes in (("f_E", "experience_levels", EXPERIENCE_CODES), ("f_WT", "workplace_types", WORKPLACE_CODES), ("f_JT", "employment_types", EMPLOYMENT_CODES)):
        if known := [codes[v] for v in filters.get(field, []) if v in codes]:
            query[name] = ",".join(known)
    query["sortBy"] = "DD" if filters.get("sort_by", "recent") == "recent" else "R"
    return f"https://www.{LISTING_SITE}/jobs/search/?{urlencode(query)}"


def search_url_of(keywords: Column, location: Column, filters: dict) -> Column:
    """search_url() for columns of keywords and locations under the same filters; null where either is."""
    rest = search_url("", "", filters).partition("&location=")[2]
    return F.concat(F.lit(f"https://www.{LISTING_SITE}/jobs/search/?keywords="), form_encoded(keywords), F.lit("&location="), form_encoded(location), F.lit(rest))
