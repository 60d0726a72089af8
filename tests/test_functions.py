"""Column functions against expected values."""

import datetime as dt
import html as entities
import re

import pytest
from pyspark.sql import functions as F

from ledgermill.functions import classify, html, text as T, urls as U
from ledgermill.functions.html import detail_fields, html_text, parse, salary, select


def each(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("HTTPS://User:pw@Example.COM:443//a//b/?b=2&a=1&utm_source=x#top", "https://example.com/a/b?a=1&b=2"),
        ("example.com", "https://example.com/"),
        ("http://example.com:8080/", "http://example.com:8080/"),
        ("http://[2001:DB8::1]:80/x", "http://[2001:db8::1]/x"),
        ("https://de.linkedin.com/jobs/view/some-role-123?trk=1", "https://www.linkedin.com/jobs/view/123/"),
        ("https://notlinkedin.com/jobs/view/123/", "https://notlinkedin.com/jobs/view/123"),
        ("https://e.com/?a=&b&referenceId=1&refId=2", "https://e.com/?a=&b=&referenceId=1"),
        ("https://e.com/p?q=a b~*", "https://e.com/p?q=a+b~%2A"),
        ("   ", None),
        (None, None),
    ],
)
def test_canonicalize_url(spark, value, expected):
    assert each(spark, U.canonicalize_url, [value]) == [expected]


def test_text(spark):
    assert each(spark, T.text, [" a ", "\t\n", None, ""]) == ["a", None, None, None]
    assert each(spark, T.clean_text, [" a \n b c ", None]) == ["a b c", ""]
    assert each(spark, T.description_text, [" a\r\nb\rc "]) == ["a\nb\nc"]
    assert each(spark, T.integer, ["Over 1,200 applicants", "3.5", "-7", "none", ""]) == [1200, 35, -7, None, None]
    assert each(spark, T.decimal_text, ["1,234.50", "1e3", "NaN", "-inf", "0.00", "ask", "", None]) == ["1234.5", "1000", None, None, "0", "ask", None, None]
    assert each(spark, T.format_number, ["60000", "1234.50", "12", "x"]) == ["60 000", "1234.5", "12", "x"]
    assert each(spark, T.iso_value, ["2026-09-01T12:00:00+03:00", "2026-09-01", "2026-09-01T09:00:00", "soon", " "]) == ["2026-09-01T09:00:00Z", "2026-09-01", "2026-09-01T09:00:00Z", "soon", None]
    assert each(spark, T.csv_safe_cell, ["=1", " +1", "-1", "@x", "\tx", "\rx", "\nx", "ok", None]) == ["'=1", "' +1", "'-1", "'@x", "'\tx", "'\rx", "'\nx", "ok", ""]
    assert each(spark, T.json_text, ['{"b":1, "a":[2]}', "plain", " ", '"q'] ) == ['{"a":[2],"b":1}', '"plain"', None, '"\\"q"']
    assert each(spark, T.json_number, ["1234.50", "60000", "ask", None]) == ["1234.5", "60000", '"ask"', None]


def test_dates(spark):
    today = F.lit("2026-09-10").cast("date")
    day = dt.date(2026, 9, 10)
    values = ["2026-09-01T23:30:00-05:00", "2026-09-01", "3 days ago", "yesterday, a day", "2 weeks ago", "5 часов назад", "2 months ago", "", None]
    assert each(spark, lambda c: T.parse_date(c, today), values) == [dt.date(2026, 9, 1), dt.date(2026, 9, 1), day - dt.timedelta(3), day - dt.timedelta(1), day - dt.timedelta(14), day, None, None, None]


def test_ids(spark):
    values = ["42", "urn:li:jobPosting:7", "https://x.linkedin.com/jobs/view/a-b-9/", "https://x/?currentJobId=5", "https://x/y", None]
    assert each(spark, U.extract_listing_id, values) == ["42", "7", "9", "5", None, None]
    assert each(spark, lambda c: U.listing_url(F.lit(None).cast("string"), c), ["/a", "https://e.com/x"]) == ["https://www.linkedin.com/a", "https://e.com/x"]
    assert U.search_url("data", "Berlin", {"date_posted": "past_week", "workplace_types": ["remote", "moon"], "sort_by": "relevant"}).endswith("?keywords=data&location=Berlin&f_TPR=r604800&f_WT=2&sortBy=R")


def test_classifiers(spark):
    assert each(spark, classify.employment_type, ["FULL_TIME", " Стажировка ", "gig", None]) == ["full-time", "internship", "unknown", "unknown"]
    found = lambda kind, said: each(spark, lambda c: F.to_json(classify.workplace(F.lit(kind).cast("string"), c)), [said])[0]
    assert found("TELECOMMUTE", "hybrid") == '{"type":"remote","inferred":false}'
    assert found(None, "Hybrid or remote") == '{"type":"hybrid","inferred":true}'
    assert found(None, "hybridisation") == '{"type":"unknown","inferred":false}'


PAGE = """<html><head><title>Role | Site</title><link rel="canonical" href="https://www.linkedin.com/jobs/view/77"><script type="application/ld+json">{bad</script>
<script type="application/ld+json">{"@graph":[{"@type":["Thing","JobPosting"],"title":"Data <Eng>","hiringOrganization":{"name":"Acme"},"description":"&lt;p&gt;Hybrid&lt;/p&gt;&lt;script&gt;x&lt;/script&gt;",
"jobLocation":[{"address":{"addressLocality":"A","addressCountry":{"name":"B"}}},{"address":"C"},{"address":"C"}],"baseSalary":{"currency":"EUR","value":{"minValue":1,"maxValue":2.50,"unitText":"YEAR"}},"industry":["x","y"]}]}</script></head>
<body><a class="apply-button" href="https://www.linkedin.com/x">in</a><a class="top-card-layout__cta" href="https://jobs.acme.com/1">out</a>
<ul><li class="description__job-criteria-item"><h3 class="description__job-criteria-subheader"> Seniority level </h3><span class="description__job-criteria-text">Senior</span></li></ul></body></html>"""


def test_html(spark):
    got = detail_fields(PAGE, "https://www.linkedin.com/jobs/view/77")
    assert (got["company"], got["title"], got["description"], got["location"]) == ("Acme", "Data <Eng>", "Hybrid", "A, B; C")
    assert (got["apply_url"], got["seniority_level"], got["industries"]) == ("https://jobs.acme.com/1", "Senior", "x, y")
    assert html_text("<p>a <b>b</b></p><style>c</style>&amp;<br>d") == "a\nb\n&\nd"
    assert html_text(None) == ""
    assert [n.attrs["href"] for n in select(parse(PAGE), "a[href]")] == ["https://www.linkedin.com/x", "https://jobs.acme.com/1"]
    pay = each(spark, lambda c: F.to_json(salary(c)), [got["base_salary"], '{"value":"NaN"}', '{"value":0,"currency":"USD"}', None])
    assert pay[0] == '{"salary_min":1.000000000000000000,"salary_max":2.500000000000000000,"salary_currency":"EUR","salary_interval":"year","salary_text":"1–2.5 EUR/year"}'
    assert pay[1] is None and "0–0 USD" in pay[2] and pay[3] is None


def test_case_folding(spark):
    """Against full case folding of every letter but Cherokee's, which come out small."""
    letters = [chr(c) for c in range(0x21, 0x2FA1E) if chr(c).isalpha() and not (0x13A0 <= c <= 0x13FD or 0xAB70 <= c <= 0xABBF)]
    df = spark.createDataFrame([(c,) for c in letters], "c string")
    odd = [r["c"] for r in df.select("c", T.casefold_key(F.col("c")).alias("f")).collect() if r["f"] != r["c"].casefold()]
    assert len(odd) <= 40, odd
    words = ["STRAßE", "ΟΔΟΣ", "ısı", "İ", "ﬁn", "ẞ", "Ünï"]
    got = spark.createDataFrame([(w,) for w in words], "c string").select(T.casefold_key(F.col("c"))).collect()
    assert [r[0] for r in got] == [w.casefold() for w in words]


def test_visible_text_of_pages_by_plain_splitting(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in pages.select("html", html.html_to_text(F.col("html")).alias("t")).collect():
        bare = re.sub(r"(?s)<!--.*?-->|<(script|style|noscript)\b.*?</\1>", "<>", entities.unescape(r["html"]))
        assert r["t"] == "\n".join(t for t in (" ".join(x.split()) for x in re.split(r"<[^>]*>", bare)) if t)


def test_visible_text_without_a_tree():
    """Strings are gathered as they come: deep pages have no limit, trees of whole batches aren't kept, and texts are as the tree's."""
    pages = ["<p>a<b>b</p>c</b>d</p><script>x<p></script>e<style/>f<noscript>g<p>h</noscript>i</p>j<br>k<img/>l", "<noscript><i>a</noscript>b</i><noscript>c", "<style>a</style></style>b<noscript/>c<title>d<b>e</b></title>f &amp; &lt;g", "", "<p", "a</p>b<!-- c -->d"]
    for page in pages:
        assert html.shown(page) == list(html.parse(page).strings(hidden=False)), page
    assert html.html_text("<div>" * 5_000 + "deep" + "</div>" * 5_000 + "end") == "deep\nend"
