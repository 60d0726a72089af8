"""More registered queries over the driver tables: sources, sinks read back, identities, exports, detail pages and the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import html, text as T, urls as U
from ..operators import detail, folds, history, identity, joins, normalize
from ..shared import modest_batches, new_path, saved
from ..sources import config, jsonl
from . import export, store as stores
from .catalog import log, query, table

def none():
    return F.lit(None).cast("string")


_CONTENTS = """, o AS (SELECT seq, dedup_key, sha256(event_type) content_hash, captured_at, capture_status, event_type title, CASE WHEN dedup_key::INT % 5 = 0 AND seq % 2 = 0 THEN ' ' ELSE 'c' END company,
        CASE dedup_key::INT % 3 WHEN 0 THEN ' ' WHEN 2 THEN 'https://e.com/' || dedup_key END source_url, CASE WHEN seq % 4 = 0 THEN NULL ELSE 'https://c.com/' || dedup_key END canonical_url, source_job_id, props FROM log),
    c AS (SELECT dedup_key, content_hash, min(seq) seq, max(seq) at_, max(seq) FILTER (WHERE capture_status = 'complete') full_at, max(captured_at) seen FROM o GROUP BY 1, 2),
    s AS (SELECT o.*, at_, full_at, seen, row_number() OVER (ORDER BY c.seq) snapshot_id, min(c.seq) OVER (PARTITION BY c.dedup_key) first_seq, max(seen) OVER (PARTITION BY c.dedup_key) last_seen_at FROM c JOIN o USING (dedup_key, content_hash, seq)),
    j AS (SELECT *, dense_rank() OVER (ORDER BY first_seq) job_id, first_value(captured_at) OVER (PARTITION BY dedup_key ORDER BY seq) first_seen_at,
        row_number() OVER (PARTITION BY dedup_key ORDER BY full_at IS NULL, full_at DESC, at_ DESC) n FROM s)
"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of events as listings: a content is an event type, so contents come again and again."""
    user, blank = F.col("dedup_key").cast("int"), {c: none() for c in (*normalize.SNAPSHOT_FIELDS, "raw_json") if c != "source"}
    said = {
        "title": F.col("event_type"), "description": F.col("props"), "company": F.when((user % 5 == 0) & (F.col("seq") % 2 == 0), " ").otherwise("c"),
        "source_url": F.when(user % 3 == 0, " ").when(user % 3 == 2, F.concat(F.lit("https://e.com/"), "dedup_key")), "canonical_url": F.when(F.col("seq") % 4 != 0, F.concat(F.lit("https://c.com/"), "dedup_key")),
        "capture_status": F.col("capture_status"), "source_job_id": F.col("source_job_id"), "content_hash": F.sha2("event_type", 256),
    }
    return log(spark, sf_dir).withColumns(blank | said)


SHOWN = ("job_id", "snapshot_id", "dedup_key", "content_hash", "title", "capture_status", "captured_at", "first_seen_at", "last_seen_at")


@query(_CONTENTS + " SELECT " + ", ".join(SHOWN) + ", coalesce(source_url, canonical_url) source_url FROM j WHERE n = 1")
def export_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.latest_listings(observations(spark, sf_dir)).select(*SHOWN, "source_url")


@query(_CONTENTS + """ SELECT job_id, dedup_key, captured_at FROM j WHERE n = 1 AND last_seen_at >= '2024-01-30T12:00:00Z' AND capture_status = 'complete' AND trim(company) <> ''
    AND trim(title) <> '' AND trim(props) <> '' AND coalesce(trim(source_url), trim(canonical_url), '') <> '' """)
def export_since_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.latest_listings(observations(spark, sf_dir), since="2024-01-30T15:00:00+03:00", complete_only=True).select("job_id", "dedup_key", "captured_at")


@query(_CONTENTS + """, k AS (SELECT dedup_key, company, props, title, capture_status, source_url, canonical_url FROM j WHERE n = 1),
    f AS (SELECT dedup_key, arg_min(source_job_id, seq) FILTER (WHERE source_job_id IS NOT NULL) id, arg_max(canonical_url, seq) FILTER (WHERE canonical_url IS NOT NULL) url FROM o GROUP BY 1),
    m AS (SELECT f.id, coalesce(f.url, k.canonical_url, k.source_url) url FROM k JOIN f USING (dedup_key) WHERE capture_status = 'complete' AND trim(company) <> '' AND trim(coalesce(source_url, canonical_url, '')) <> '')
    SELECT DISTINCT 'id' kind, id AS value FROM m WHERE id IS NOT NULL UNION ALL SELECT DISTINCT 'url', url FROM m WHERE url IS NOT NULL""")
def known_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids, urls = joins.known(observations(spark, sf_dir), "Events")
    return ids.select(F.lit("id").alias("kind"), F.col("source_job_id").alias("value")).unionByName(urls.select(F.lit("url").alias("kind"), F.col("canonical_url").alias("value")))


@query("""
    WITH r AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) seq, role, text FROM conversations),
    f AS (SELECT conv_id, min(seq) first_seq, arg_min(text, seq) FILTER (WHERE role = 'user' AND text <> '') title, arg_min(text, seq) FILTER (WHERE role = 'assistant' AND text <> '') company FROM r GROUP BY 1)
    SELECT conv_id::VARCHAR AS "identity", row_number() OVER (ORDER BY first_seq) AS rank, title, company, 'https://www.linkedin.com/jobs/view/' || conv_id || '/' href FROM f
""")
def card_merge_urns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation's turns as cards of one listing; those without a link are known by their URN."""
    turn = (F.col("conv_id") * 100_000 + F.col("turn")).alias("seq")
    link = F.when(F.col("turn") % 2 == 1, F.concat(F.lit("https://www.linkedin.com/jobs/view/"), F.col("conv_id").cast("string"), F.lit("/"))).otherwise("")
    cards = table(spark, sf_dir, "conversations").select(turn, F.concat(F.lit("urn:li:jobPosting:"), F.col("conv_id").cast("string")).alias("entity_urn"), link.alias("href"), *(F.when(F.col("role") == r, F.col("text")).alias(c) for r, c in (("user", "title"), ("assistant", "company"))), *(F.lit("").alias(c) for c in ("location", "posted_at", "card_text")))
    return joins.merged_cards(cards).select("identity", "rank", "title", "company", "href")


@query("""
    WITH r AS (SELECT p_partkey rank, CASE p_partkey % 3 WHEN 0 THEN (p_partkey // 6)::VARCHAR END id, 'https://example.com/' || (p_partkey // 4) url FROM part),
    k AS (SELECT rank, id, CASE WHEN id IS NULL THEN url ELSE 'https://www.linkedin.com/jobs/view/' || id || '/' END source_url FROM r)
    SELECT min(rank) search_rank, id source_job_id, source_url, 'partial' capture_status FROM k GROUP BY 2, 3
""")
def direct_url_stubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    url = F.when(k % 3 == 0, F.concat(F.lit("/jobs/view/role-"), F.floor(k / 6).cast("string"))).otherwise(F.concat(F.lit("https://example.com/"), F.floor(k / 4).cast("string")))
    return joins.direct_stubs(table(spark, sf_dir, "part").select(k.alias("rank"), url.alias("url"))).select("search_rank", "source_job_id", "source_url", "capture_status")


def _lines(spark: SparkSession, sf_dir: str) -> str:
    """The orders as JSON Lines in files that follow one another by name, written by all tasks; a blank line after each seventh, and a
    list where the key is 1,001."""
    path, k = new_path(spark, "orders-jsonl"), F.col("o_orderkey").cast("string")
    row = F.to_json(F.struct(F.concat(F.lit("https://e.com/"), k).alias("url"), F.concat(F.lit("https://e.com/"), k).alias("source_url"), k.alias("source_job_id"), F.lit("Acme").alias("company"), F.col("o_orderpriority").alias("title"), F.when(F.col("o_orderkey") % 5 == 0, " ").otherwise("text").alias("description"), F.lit("other").alias("source"), F.lit("x:1").alias("dedup_key")))
    said = F.when(F.col("o_orderkey") == 1001, "[1, 2]").otherwise(row)
    rows = table(spark, sf_dir, "orders").orderBy("o_orderkey").select(F.when(F.col("o_orderkey") % 7 == 0, F.concat(said, F.lit("\n "))).otherwise(said).alias("value"))
    rows.write.text(path)
    return path


_LINES = """WITH r AS (SELECT o_orderkey k, row_number() OVER (ORDER BY o_orderkey) + count(*) FILTER (WHERE o_orderkey % 7 = 0) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) seq,
    o_orderpriority title, CASE WHEN o_orderkey % 5 = 0 THEN 'partial' ELSE 'complete' END capture_status FROM orders) SELECT seq, k::VARCHAR source_job_id, title, 'jsonl' source, capture_status FROM r """


@query(_LINES + "WHERE k < coalesce((SELECT min(k) FROM r WHERE k = 1001), 9e18)")
def jsonl_valid_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands before the first line that is no record."""
    return jsonl.scan(spark, _lines(spark, sf_dir)).records.select("seq", "source_job_id", "title", "source", "capture_status")


@query(_LINES.replace("SELECT seq,", "SELECT seq, row_number() OVER (ORDER BY seq) search_rank,") + "QUALIFY search_rank <= 300")
def jsonl_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 300 valid lines: the limit is the operator."""
    return jsonl.scan(spark, _lines(spark, sf_dir), max_results=300).records.select("seq", F.col("search_rank").cast("long").alias("search_rank"), "source_job_id", "title", "source", "capture_status")


def _listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.when(F.col("doc_id") % 2 == 0, F.concat((F.col("doc_id") * 10).cast("string"), F.lit(".50")))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("job_id"), F.col("source").alias("company"), F.col("lang").alias("title"), F.col("text").alias("description"), amount.alias("salary_min"), F.lit('["a","é"]').alias("industries"))


_READ = "SELECT doc_id job_id, source company, lang title, text description, CASE WHEN doc_id % 2 = 0 THEN (doc_id * 10) || '.5' END salary_min, '[\"a\",\"é\"]' industries FROM documents"


@query(_READ)
def jsonl_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "sink") + ".jsonl"
    export.write(_listing_rows(spark, sf_dir), path)
    return spark.read.schema("job_id long, company string, title string, description string, salary_min string, industries string").json(path)


@query(_READ)
def json_array_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice: the second takes the first one's place."""
    path = new_path(spark, "sink") + ".json"
    rows = _listing_rows(spark, sf_dir)
    export.write(rows.limit(3), path)
    export.write(rows, path)
    return export.read_json(spark, path, "job_id long, company string, title string, description string, salary_min string, industries string")


_SAFE = r"CASE WHEN regexp_matches({0}, '^\s*[=+\-@]|^[\t\r\n]') THEN '''' || {0} ELSE {0} END"


@query(f"SELECT doc_id::VARCHAR job_id, coalesce(source, '') company, {_SAFE.format('t')} description FROM (SELECT *, CASE WHEN doc_id % 4 = 0 THEN '=' ELSE '' END || text t FROM documents)")
def csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "sink") + ".csv"
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("job_id"), F.col("source").alias("company"), F.concat(F.when(F.col("doc_id") % 4 == 0, "=").otherwise(""), "text").alias("description"))
    export.write(rows, path)
    return export.read_csv(spark, path, rows.columns).select("job_id", *(F.coalesce(c, F.lit("")).alias(c) for c in ("company", "description")))


def _tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("o_orderkey")
    said = {
        "source_job_id": F.when(i % 2 == 0, i.cast("string")), "dedup_key": F.concat(F.lit("k:"), i.cast("string")), "company": F.concat(F.lit("C"), F.col("o_custkey").cast("string")), "title": F.col("o_orderpriority"), "workplace_type": F.when(i % 3 == 0, "hybrid").otherwise("moon"),
        "employment_type": F.lit("contract"), "canonical_url": F.lit("https://c.com/"), "salary_max": (i * 1000).cast("string"), "salary_currency": F.lit("eur"), "salary_interval": F.lit("Month"), "first_seen_at": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "captured_at": F.lit("2024-01-02T00:00:00Z"),
    }
    names = ("source_url", "location", "salary_min", "salary_text", "last_seen_at")
    return table(spark, sf_dir, "orders").select(*(c.alias(n) for n, c in (said | {n: none() for n in names}).items()))


def _tracker_sql(language: str) -> str:
    words = {"en": ("Hybrid", "Contract", "up to ", "/ month", "New"), "ru": ("Гибрид", "Контракт", "до ", "/ месяц", "Новая")}[language]
    values = {
        "ID": "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey::VARCHAR ELSE 'k:' || o_orderkey END", "Company": "'C' || o_custkey", "Role": "o_orderpriority", "URL": "'https://c.com/'", "Workplace": f"CASE WHEN o_orderkey % 3 = 0 THEN '{words[0]}' ELSE 'moon' END",
        "Employment type": f"'{words[1]}'", "Salary / currency": f"'{words[2]}' || replace(format('{{:,}}', o_orderkey * 1000), ',', ' ') || ' EUR {words[3]}'", "Status": f"'{words[4]}'", "Added": "strftime(o_orderdate, '%Y-%m-%d')", "Last updated": "'2024-01-02'",
    }
    return "SELECT " + ", ".join(f"{values.get(en, chr(39) * 2)} AS \"{ru if language == 'ru' else en}\"" for en, ru in export.TRACKER.items()) + " FROM orders"


def _tracker_back(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    path = new_path(spark, "tracker") + ".csv"
    export.write(_tracked(spark, sf_dir), path, kind)
    back = spark.read.options(header=True, escape='"').csv(path)
    return back.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in back.columns))


@query(_tracker_sql("en"))
def tracker_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tracker_back(spark, sf_dir, "tracker")


@query(_tracker_sql("ru"))
def tracker_sink_ru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tracker_back(spark, sf_dir, "tracker_csv_RU")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'invalid source' WHEN o_orderkey % 7 = 0 THEN 'invalid source_url' WHEN o_orderkey % 5 = 0 THEN 'invalid title' WHEN o_orderkey % 3 = 0 THEN 'invalid workplace_type' WHEN o_orderkey % 13 = 0 THEN 'invalid salary_min' END problem,
        CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 4 = 0 THEN 'partial' ELSE 'complete' END capture_status FROM orders
""")
def record_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        i, F.when(i % 11 == 0, "Bad Slug").otherwise("ok-1").alias("source"), F.when(i % 7 == 0, "ftp://x").otherwise("HTTPS://x/y").alias("source_url"), F.lit(" ").alias("note"), F.lit("Acme").alias("company"), F.when(i % 5 != 0, "t").alias("title"),
        F.when(i % 4 != 0, "d").otherwise(" \t").alias("description"), F.when(i % 3 == 0, "moon").otherwise("remote").alias("workplace_type"), F.when(i % 13 == 0, "lots").otherwise("12.5").alias("salary_min"), F.lit("2024-02-29").alias("posted_at"),
    )
    return normalize.downgraded(rows.withColumn("problem", normalize.problem(rows))).select("o_orderkey", "problem", "capture_status")


@query("SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'other' ELSE 'mine' END whose, count(*) n FROM orders GROUP BY 1")
def source_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("o_orderkey")
    mine, others = normalize.owned(table(spark, sf_dir, "orders").withColumn("source", F.when(i % 8 == 0, none()).when(i % 4 == 0, "x").otherwise("s")), "s")
    return history.table_counts(mine=mine, other=others).select(F.col("table").alias("whose"), F.col("rows").alias("n")).where("n > 0")


@query("""
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 's:own' || o_orderkey WHEN 1 THEN NULL WHEN 2 THEN 's:id:' || o_orderkey ELSE 's:url:https://e.com/' || o_orderkey END dedup_key FROM orders
""")
def dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit keys of the source, of another one (invalid), and default keys by id and by URL."""
    i = F.col("o_orderkey")
    k = i.cast("string")
    explicit = F.when(i % 4 == 0, F.concat(F.lit(" s:own"), k)).when(i % 4 == 1, F.concat(F.lit("t:own"), k)).otherwise(F.lit("  "))
    return table(spark, sf_dir, "orders").select(i, normalize.dedup_key(F.lit("s"), explicit, F.when(i % 4 != 3, k), U.canonicalize_url(F.concat(F.lit("HTTPS://E.com:443/"), k, F.lit("/?utm_x=1&trk=2#z")))).alias("dedup_key"))


@query(r"""
    SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'second' ELSE trim(text, E' \t\n\r') END shown, CASE WHEN doc_id % 4 = 0 THEN 0 ELSE 1 END present,
        replace(replace(trim(text, E' \t\n\r'), E'\r\n', E'\n'), E'\r', E'\n') AS "lines" FROM documents
""")
def alias_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first value that isn't empty; a blank one counts as a value and hides later ones."""
    i, body = F.col("doc_id") % 4, F.concat(F.lit("\n "), "text", F.lit("\t\r\n"))
    first = F.when(i == 0, "  ").when(i == 1, "").otherwise(body)
    found = T.first_value(first, F.lit("second"))
    return table(spark, sf_dir, "documents").select("doc_id", T.text(found).alias("shown"), T.text(found).isNotNull().cast("int").alias("present"), T.description_text(F.replace(body, F.lit("\n"), F.when(F.col("doc_id") % 2 == 0, "\r\n").otherwise("\r"))).alias("lines"))


@query("""
    SELECT page_id, CASE page_id % 5 WHEN 4 THEN NULL ELSE page_id::VARCHAR END listing_id, CASE page_id % 5 WHEN 4 THEN 'https://www.linkedin.com/about' ELSE 'https://www.linkedin.com/jobs/view/' || page_id || '/' END link,
        'a+~%2A%2F' AS encoded, page_id % 2 = 0 absolute, 'Role' || page_id AS title FROM pages
""")
def listing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("page_id")
    k = p.cast("string")
    said = F.when(p % 5 == 0, k).when(p % 5 == 1, F.concat(F.lit("urn:li:jobPosting:"), k)).when(p % 5 == 2, F.concat(F.lit("/jobs/view/a-b-"), k, F.lit("?x=1"))).when(p % 5 == 3, F.concat(F.lit("https://www.linkedin.com/jobs/search/?currentJobId="), k))
    listing = U.extract_listing_id(none(), said, F.col("url"))
    title = F.split_part(F.concat(F.lit("Role"), k, F.lit(" | Site | More")), F.lit(" | "), F.lit(1))
    return table(spark, sf_dir, "pages").select(p, listing.alias("listing_id"), U.listing_url(listing, F.lit("/about")).alias("link"), U.form_encoded(F.lit("a ~*/")).alias("encoded"), U.is_absolute(F.when(p % 2 == 0, "HtTps://h/x").otherwise("//h/x")).alias("absolute"), title.alias("title"))


@query("""
    SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '"by \\"talk\\""' WHEN 1 THEN p_size::VARCHAR WHEN 2 THEN p_size || '.5' END AS token, CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '{"a":1,"b":[2]}' ELSE 'plain' END decoded,
        CASE WHEN p_partkey % 2 = 0 THEN '2024-03-04' ELSE '' END AS "day" FROM part
""")
def export_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as JSON tokens, stored JSON read back, and the date part of a time."""
    p, size = F.col("p_partkey"), F.col("p_size").cast("string")
    amount = F.when(p % 4 == 0, 'by "talk"').when(p % 4 == 1, F.concat(size, F.lit(".000"))).when(p % 4 == 2, F.concat(size, F.lit(".50")))
    stored = F.when(p % 3 == 1, '{"b": [2], "a": 1}').when(p % 3 == 2, "plain").otherwise("")
    return table(spark, sf_dir, "part").select(p, T.json_number(amount).alias("token"), T.decode_json(stored).alias("decoded"), T.date_part(F.when(p % 2 == 0, " 2024-03-04T05:06:07Z ")).alias("day"))


@query("""
    WITH s AS (SELECT p_partkey, p_size lo, p_size * 2 hi, p_partkey % 5 k FROM part)
    SELECT p_partkey, CASE k WHEN 0 THEN lo WHEN 1 THEN lo WHEN 2 THEN hi END::BIGINT salary_min, CASE k WHEN 0 THEN hi WHEN 1 THEN lo WHEN 2 THEN hi END::BIGINT salary_max, CASE k WHEN 0 THEN 'year' WHEN 1 THEN 'hour' END salary_interval,
        CASE k WHEN 0 THEN lo || '–' || hi || ' USD/year' WHEN 1 THEN lo || '–' || lo || ' USD/hour' WHEN 2 THEN hi || '–' || hi END salary_text FROM s
""")
def posted_salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, lo, hi = F.col("p_partkey") % 5, F.col("p_size").cast("string"), (F.col("p_size") * 2).cast("string")
    said = (
        F.when(p == 0, F.concat(F.lit('{"currency":"USD","value":{"minValue":'), lo, F.lit(',"maxValue":"'), hi, F.lit('","unitText":"Per YEAR"}}')))
        .when(p == 1, F.concat(F.lit('{"currency":"USD","value":{"value":'), lo, F.lit(',"unitText":"HOUR"}}')))
        .when(p == 2, F.concat(F.lit('{"value":'), hi, F.lit("}")))
        .when(p == 3, '{"currency":"USD","value":{"minValue":"NaN","maxValue":"Infinity"}}')
    )
    pay = html.salary(said)
    return table(spark, sf_dir, "part").select("p_partkey", *(pay[c].cast("long").alias(c) for c in ("salary_min", "salary_max")), *(pay[c].alias(c) for c in ("salary_interval", "salary_text")))


@query("""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '1.0' WHEN 1 THEN '1' WHEN 2 THEN '"strasse x"' WHEN 3 THEN 'null' WHEN 4 THEN '["B","a"]' ELSE '1.0' END AS token FROM part""")
def hash_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON counts as its value, with case, 1.0 apart from 1; other text without case and spacing."""
    p = F.col("p_partkey") % 6
    said = F.when(p == 0, "1.0").when(p == 1, "1").when(p == 2, " STRAßE \t X").when(p == 4, '[ "B", "a" ]').when(p == 5, "1.00")
    return table(spark, sf_dir, "part").select("p_partkey", T.hash_token(said).alias("token"))


@query("""
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN '2024-05-06T07:08:09Z' WHEN 1 THEN '2024-05-06' WHEN 2 THEN 'next month' END AS stamp FROM events
""")
def naive_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A time without an offset is UTC; ten signs and unknown forms stay."""
    i = F.col("event_id") % 4
    return table(spark, sf_dir, "events").select("event_id", T.iso_value(F.when(i == 0, "2024-05-06T07:08:09.999").when(i == 1, "2024-05-06").when(i == 2, " next month ").otherwise("  ")).alias("stamp"))


@query("""
    SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN '' ELSE doc_id::VARCHAR END AS "id", CASE doc_id % 3 WHEN 0 THEN 'Org ' || doc_id WHEN 1 THEN 'Page Org' ELSE 'Stub Org' END company, CASE doc_id % 3 WHEN 0 THEN 'Lead ' || doc_id WHEN 1 THEN 'Head ' || doc_id ELSE 'Only title' END title,
        CASE doc_id % 3 WHEN 0 THEN 'Work' || chr(10) || 'Remote & more' WHEN 1 THEN 'Hybrid work in town' ELSE '' END description, CASE doc_id % 3 WHEN 0 THEN 'Berlin, BE, DE; Rome' WHEN 1 THEN 'Oslo' ELSE 'Stub town' END AS "location",
        CASE doc_id % 3 WHEN 0 THEN 'remote' WHEN 1 THEN 'hybrid' ELSE 'unknown' END workplace_type, CASE doc_id % 3 WHEN 0 THEN 'full-time' WHEN 1 THEN 'contract' ELSE 'unknown' END employment_type,
        CASE doc_id % 3 WHEN 0 THEN DATE '2024-02-03' WHEN 1 THEN DATE '2024-03-08' ELSE DATE '2024-03-03' END posted_at, CASE WHEN doc_id % 3 = 1 THEN 'Mid' END seniority_level, CASE WHEN doc_id % 3 = 1 THEN 'https://apply.example.com/x' END apply_url,
        CASE WHEN doc_id % 3 = 0 THEN '10–20 EUR/month' END salary_text, CASE WHEN doc_id % 3 = 2 THEN 'partial' ELSE 'complete' END capture_status FROM documents
""")
def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A detail page for each document: with a posting in JSON-LD, with markup only, or with nothing but a title, over a stub."""
    k, kind = F.col("doc_id").cast("string"), F.col("doc_id") % 3
    posting = F.concat(
        F.lit('<html><script type="application/ld+json">{broken</script><script type="application/ld+json">{"@graph":[{"@type":"Thing"},{"@type":["JobPosting"],"title":"Lead '), k,
        F.lit('","hiringOrganization":{"name":"Org '), k, F.lit('"},"description":"&lt;p&gt;Work&lt;/p&gt;&lt;script&gt;x()&lt;/script&gt;&lt;p&gt;Remote &amp;amp; more&lt;/p&gt;","datePosted":"2024-02-03T23:00:00+03:00","employmentType":["FULL_TIME"],"jobLocationType":"TELECOMMUTE",'),
        F.lit('"jobLocation":[{"address":{"addressLocality":"Berlin","addressRegion":"BE","addressCountry":{"name":"DE"}}},{"address":"Rome"},{"address":"Rome"}],"baseSalary":{"currency":"EUR","value":{"minValue":10,"maxValue":20,"unitText":"MONTH"}}}]}</script>'),
        F.lit('<link rel="canonical" href="https://www.linkedin.com/jobs/view/x-'), k, F.lit('"><h1>Other</h1></html>'),
    )
    markup = F.concat(
        F.lit('<div data-semaphore-content-urn="urn:li:jobPosting:'), k, F.lit('"><h1 class="topcard__title"> Head  '), k, F.lit('</h1><a class="topcard__org-name-link">Page\n Org</a><div class="topcard__flavor-row"><span class="topcard__flavor--bullet">Oslo</span></div>'),
        F.lit('<ul><li class="description__job-criteria-item"><h3 class="description__job-criteria-subheader">Seniority level</h3><span class="description__job-criteria-text">Mid</span></li><li class="description__job-criteria-item"><h3 class="description__job-criteria-subheader">Employment type</h3><span class="description__job-criteria-text">Contract</span></li></ul>'),
        F.lit('<span class="posted-time-ago__text">2 days ago</span><a class="apply-button" href="https://de.linkedin.com/y">in</a><a class="top-card-layout__cta" href="https://apply.example.com/x">out</a><div class="show-more-less-html__markup">Hybrid <!-- c -->work in town</div></div>'),
    )
    page = F.when(kind == 0, posting).when(kind == 1, markup).otherwise("<title>Only title | Site</title>")
    stub = F.struct(F.lit("Stub Org").alias("company"), F.lit("Stub title").alias("title"), F.lit("Stub town").alias("location"), F.lit("1 week ago").alias("posted_at"))
    pages = table(spark, sf_dir, "documents").select("doc_id", F.lit("https://e.com/p").alias("url"), page.alias("html"), stub.alias("stub"))
    found = detail.details(pages, F.lit("2024-03-10").cast("date"), stub="stub")
    return found.select("doc_id", F.coalesce("source_job_id", F.lit("")).alias("id"), "company", "title", "description", "location", "workplace_type", "employment_type", "posted_at", "seniority_level", "apply_url", "salary_text", "capture_status")


@query(r"""
    SELECT page_id, k::BIGINT place, CASE WHEN k = 1 THEN '' ELSE 'urn:li:jobPosting:' || page_id || k END entity_urn, 'https://www.linkedin.com/jobs/view/' || page_id || k || '?x=1' href, 'Lead ' || k title, 'Org ' || page_id company, 'Oslo' AS location,
        CASE k WHEN 0 THEN '2024-02-03' ELSE '2 days ago' END posted_at FROM pages, (SELECT unnest([0, 2]) k) WHERE page_id % 3 = 0
    UNION ALL SELECT page_id, k, '', 'https://www.linkedin.com/jobs/view/' || page_id || k, CASE k WHEN 0 THEN 'Only link' ELSE '' END, '', '', '' FROM pages, (SELECT unnest([0, 1]) k) WHERE page_id % 3 = 1
""".replace("k::BIGINT place", "(k // 2)::BIGINT place"))
def search_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search pages over the raw pages: cards with URNs (a link beside them is none), links only, and no cards."""
    k = F.col("page_id").cast("string")
    card = lambda i, time: F.concat(
        F.lit('<li><div class="base-card" data-entity-urn="urn:li:jobPosting:'), k, F.lit(f'{i}"><a class="base-card__full-link" href="/jobs/view/'), k, F.lit(f'{i}?x=1"> <span class="sr-only">Other</span></a><h3 class="base-search-card__title"> Lead\n {i} </h3><h4>Org '), k, F.lit(f'</h4><span class="job-search-card__location">Oslo</span>{time}</div></li>')
    )
    named = F.concat(F.lit("<ul>"), card(0, '<time datetime="2024-02-03">x</time>'), F.lit('<li><a href="/jobs/view/999">beside</a></li>'), card(2, "<time> 2 days\n ago</time>"), F.lit("</ul>"))
    links = F.concat(F.lit('<ul><li class="x"><h3>Only link</h3><a href="/jobs/view/'), k, F.lit('0">a</a></li></ul><div><a href="https://www.linkedin.com/jobs/view/'), k, F.lit('1">b</a></div><a href="/jobs/search">no</a>'))
    made = F.when(F.col("page_id") % 3 == 0, named).when(F.col("page_id") % 3 == 1, links).otherwise(F.lit(""))
    pages = table(spark, sf_dir, "pages").select("page_id", F.lit("https://www.linkedin.com/jobs/search?q=1").alias("url"), F.concat(made, F.lit("\n"), F.coalesce("html", F.lit(""))).alias("html"))
    return detail.search_cards(pages).drop("url", "card_text")


@query("""
    , c AS (SELECT DISTINCT run_id AS session, dedup_key AS identity FROM log), f AS (SELECT run_id AS session, dedup_key AS identity, min(seq) rank FROM log GROUP BY ALL),
    a AS (SELECT dedup_key AS identity, count(*) made, bool_or(event_type = 'purchase') ok FROM log WHERE seq % 17 = 0 GROUP BY 1)
    SELECT identity, min(rank) rank, (coalesce(any_value(made), 0) + 1)::BIGINT attempt FROM f LEFT JOIN a USING (identity) WHERE identity::INT % 9 <> 0 GROUP BY identity
    HAVING NOT bool_or(session > '2024-01-29' AND identity::INT % 5 = 0) AND NOT coalesce(any_value(ok), false) AND coalesce(any_value(made), 0) <= 1
""")
def due_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail requests that are due: found by sessions that have stopped, not known, without success, failed once at most."""
    rows = log(spark, sf_dir)
    stubs = rows.groupBy(F.col("run_id").alias("session"), F.col("dedup_key").alias("identity")).agg(F.min("seq").alias("rank")).withColumns({"source_job_id": F.col("identity"), "canonical_url": none()})
    last = (F.col("session") > "2024-01-29") & (F.col("identity").cast("int") % 5 == 0)
    stubs = stubs.withColumn("session", F.when(last, F.concat("session", F.lit(" open"))).otherwise(F.col("session")))
    sessions = stubs.select("session").distinct().withColumn("stop_reason", F.when(~F.col("session").endswith("open"), "max_results"))
    attempts = rows.where(F.col("seq") % 17 == 0).select(F.col("dedup_key").alias("identity"), (F.col("event_type") == "purchase").alias("ok"))
    known = rows.where(F.col("dedup_key").cast("int") % 9 == 0).select(F.col("dedup_key").alias("source_job_id")).distinct()
    return joins.due_requests(stubs, attempts, sessions, known, known.select(F.col("source_job_id").alias("canonical_url")))


@query(r"SELECT doc_id, array_to_string(list_filter(['Head ' || doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')), '© tail'], lambda x: x <> ''), chr(10)) shown FROM documents")
def html_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as pages, with scripts, styles, comments and entities around them."""
    body = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;amp;")), F.lit("<"), F.lit("&amp;lt;")), F.lit(">"), F.lit("&amp;gt;"))
    page = F.concat(F.lit("<h1>Head "), F.col("doc_id").cast("string"), F.lit("</h1><style>p{}</style><script>var t='</p>';</script><p> "), body, F.lit("<br></p><!-- c --><noscript>no</noscript>\n<i>&copy; tail</i>"))
    return modest_batches(table(spark, sf_dir, "documents")).select("doc_id", html.html_to_text(page).alias("shown"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '<div id=\"job-details\">' || repeat('b', 90 + (doc_id % 7)::INT) || '</div>' END block FROM documents")
def longest_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")
    page = F.concat(F.lit('<div class="jobs-description__content">'), F.repeat(F.lit("a"), F.lit(85)), F.lit('</div><div id="job-details">'), F.repeat(F.lit("b"), (F.lit(90) + n % 7).cast("int")), F.lit("</div>"))
    return modest_batches(table(spark, sf_dir, "documents")).select(n, html.longest_description(F.when(n % 2 == 0, page).otherwise('<div id="job-details">short</div>')).alias("block"))


@query("""
    SELECT s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN 'https://www.linkedin.com/jobs/search/?keywords=' || replace(url_encode(s_name || ' "x" *~'), '%20', '+') || '&location=' || replace(url_encode(n_name), '%20', '+')
        || CASE WHEN s_suppkey % 2 = 0 THEN '&f_TPR=r604800&f_E=4&f_WT=2&f_JT=F%2CC&sortBy=DD' ELSE '&f_E=2&sortBy=R' END END url,
        CASE WHEN s_suppkey % 5 <> 0 THEN CASE WHEN s_suppkey % 2 = 0 THEN 500 ELSE 7 END END::INT max_results, CASE s_suppkey % 3 WHEN 0 THEN 'tracker-csv' WHEN 1 THEN 'csv' ELSE 'jsonl' END format
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def driver_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as searches under three profiles, one of them disabled: what each asks for, and the format of its export."""
    c = config.Config([config.Profile("even", "k"), config.Profile("odd", "k", "Oslo", 7), config.Profile("off", "k", "Oslo", 7, False)])
    filters = {"even": vars(c.filters), "odd": {"date_posted": "someday", "experience_levels": ["entry", "wizard"], "sort_by": "relevant"}}
    key = F.col("s_suppkey")
    profile = F.when(key % 5 == 0, "off").when(key % 2 == 0, "even").otherwise("odd")
    rows = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).withColumn("profile", profile)  # nations: 25 rows at any scale
    words, url, most = F.concat("s_name", F.lit(' "x" *~')), none(), F.lit(None).cast("int")
    for name in ("even", "odd", "off"):
        try:
            asked = c.resolved(name)
        except ValueError:  # a disabled profile asks for nothing
            continue
        url = F.when(F.col("profile") == name, U.search_url_of(words, F.col("n_name"), filters[name])).otherwise(url)
        most = F.when(F.col("profile") == name, F.lit(int(asked["max_results"]))).otherwise(most)
    formats = [export.format_of(*x) for x in ((" Sheet", "a"), (None, "b.CSV"), (None, "c"))]
    return rows.select("s_suppkey", url.alias("url"), most.alias("max_results"), F.element_at(F.array(*map(F.lit, formats)), (key % 3 + 1).cast("int")).alias("format"))


@query("""
    SELECT 'unique_jobs' AS "table", count(*) AS rows FROM part UNION ALL SELECT 'snapshots', count(*) FROM part UNION ALL SELECT 'search_runs', 2 UNION ALL SELECT 'search_hits', 2 * count(*) FROM part
    UNION ALL SELECT 'missing', 0 UNION ALL SELECT 'new in the second run', 0
""")
def demo_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as listings in JSON Lines, imported by two runs: new runs and hits, no new listings or contents; and a store that isn't
    there."""
    path, lines, k = new_path(spark, "parts-store"), new_path(spark, "parts-jsonl"), F.col("p_partkey").cast("string")
    said = F.struct(k.alias("source_job_id"), F.concat(F.lit("https://example.com/p/"), k).alias("source_url"), F.col("p_brand").alias("company"), F.col("p_name").alias("title"), F.col("p_type").alias("description"))
    table(spark, sf_dir, "part").select(F.to_json(said).alias("value")).write.text(lines)
    missing = stores.Store(spark, path).log()
    for _ in range(2):
        stores.run_import(spark, "jsonl", path, path=lines)
    store = stores.Store(spark, path)
    again = store.batches().orderBy(F.desc("version")).limit(1).select(F.lit("new in the second run").alias("table"), (F.col("new_listings") + F.col("new_contents")).alias("rows"))
    return store.stats().unionByName(history.table_counts(missing=missing)).unionByName(again)


@query("""
    SELECT 'kept' AS "table", count(*) FILTER (WHERE p_partkey % 10 <> 0 AND p_partkey % 10 <> 5) AS rows FROM part UNION ALL SELECT 'another source', count(*) FILTER (WHERE p_partkey % 10 = 0) FROM part
    UNION ALL SELECT 'no valid identity', count(*) FILTER (WHERE p_partkey % 10 = 5) FROM part UNION ALL SELECT 'keys', count(DISTINCT p_partkey % 97) FILTER (WHERE p_partkey % 10 <> 0 AND p_partkey % 10 <> 5) FROM part
""")
def store_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the first of them committed twice: it replaces itself, and rejects are listed."""
    p, store = F.col("p_partkey"), stores.Store(spark, new_path(spark, "store"))
    rows = table(spark, sf_dir, "part").select(p.alias("seq"), F.lit("r").alias("run_id"), F.when(p % 10 == 0, "y").otherwise("x").alias("source"), F.when(p % 10 != 5, (p % 97).cast("string")).alias("source_job_id"), F.col("p_name").alias("title"))
    for batch, odd in (("1", 1), ("1", 1), ("2", 0)):
        store.append(rows.where(F.col("seq") % 2 == odd), batch, "x")
    keys = store.log().agg(F.count_distinct("dedup_key").alias("rows")).select(F.lit("keys").alias("table"), "rows")
    gone = store.rejects().groupBy(F.col("reason").alias("table")).agg(F.count("*").alias("rows"))
    return history.table_counts(kept=store.log()).unionByName(gone).unionByName(keys)


@query("""
    , r AS (SELECT *, CASE WHEN seq < 200 THEN 1 WHEN seq < 500 THEN 2 ELSE 3 END b, row_number() OVER (PARTITION BY dedup_key ORDER BY seq) n, row_number() OVER (PARTITION BY dedup_key, event_type ORDER BY seq) m FROM log)
    SELECT b::INT AS batch, count(*) processed, count(*) FILTER (WHERE n = 1) new_listings, count(*) FILTER (WHERE m = 1) new_contents, min(seq) first_seq, max(seq) last_seq FROM r GROUP BY 1
""")
def store_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of events as three batches of two writers, in the order of arrival, one of them sent again by the other writer: what
    each batch brought, by its own figures and by the log."""
    path = new_path(spark, "store")
    writers = stores.Store(spark, path), stores.Store(spark, path)
    number = F.when(F.col("seq") < 200, 1).when(F.col("seq") < 500, 2).otherwise(3)
    rows = log(spark, sf_dir).select("seq", "run_id", F.col("dedup_key").alias("source_job_id"), F.col("event_type").alias("title"), F.lit("events").alias("source"), number.alias("batch"))
    for writer, k in ((0, 1), (1, 2), (0, 2), (1, 3)):
        writers[writer].append(rows.where(F.col("batch") == k).drop("batch"), str(k))
    seen = writers[0].log().groupBy(number.alias("batch")).agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count("*").alias("stored"))
    figures = writers[0].batches().withColumn("batch", F.col("batch").cast("int"))
    return figures.join(seen, "batch").where(F.col("processed") == F.col("stored")).select("batch", "processed", "new_listings", "new_contents", "first_seq", "last_seq")


@query(_CONTENTS + " SELECT " + ", ".join(SHOWN) + " FROM j WHERE n = 1")
def store_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export from folds that grew over three batches, of one, three and many events."""
    rows, fold = observations(spark, sf_dir), None
    names = [f.name for f in stores.log_schema()]
    rows = rows.withColumns({c: none() for c in names if c not in rows.columns}).select(*names)
    contents = folds.contents(names)
    for low, high in ((None, 300), (300, 900), (900, None)):
        part = rows.where((F.col("seq") >= low if low else F.lit(True)) & (F.col("seq") < high if high else F.lit(True)))
        state = contents.of(part)
        fold = saved(state if fold is None else contents.merged(fold.unionByName(state)), "fold")
    return export.listings(folds.latest(fold, names), fold.select(F.col("first_seq").alias("seq"))).select(*SHOWN)


@query("""
    , e AS (SELECT run_id, min(captured_at) started_at, max(captured_at) FILTER (WHERE event_type = 'purchase') finished_at, sum(CASE WHEN event_type = 'error' THEN CASE WHEN seq % 2 = 0 THEN 1 ELSE -1 END ELSE 0 END) x, count(*) FILTER (WHERE event_type = 'error' AND seq % 2 = 0) error_count FROM log GROUP BY 1)
    SELECT run_id, started_at, finished_at, error_count, CASE WHEN finished_at IS NULL THEN 'running' WHEN error_count > 0 THEN 'failed' ELSE 'finished' END status FROM e
""")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of runs folded into a row per run; negative error counts are none."""
    kind = F.when(F.col("event_type") == "purchase", "finished").when(F.col("event_type") == "error", "errors").otherwise("started")
    rows = log(spark, sf_dir).withColumns({"kind": kind, "at": F.col("captured_at"), "reason": F.lit("finished"), "errors": F.when(F.col("event_type") == "error", F.when(F.col("seq") % 2 == 0, 1).otherwise(-1)), "processed": F.lit(1)})
    rows = rows.withColumns({c: none() for c in ("search_profile_id", "search_url", "requested_limit", "config")})
    firsts = rows.groupBy("run_id").agg(F.min("captured_at").alias("started_at"))
    return stores.run_table(rows).drop("started_at").join(firsts, "run_id").select("run_id", "started_at", "finished_at", "error_count", "status")


@query("""
    , f AS (SELECT profile, dedup_key, min(substr(captured_at, 1, 13)) r FROM log GROUP BY 1, 2), n AS (SELECT profile, r, count(*) k FROM f GROUP BY 1, 2), a AS (SELECT DISTINCT profile, substr(captured_at, 1, 13) AS round FROM log),
    g AS (SELECT a.profile, round, coalesce(k, 0) k FROM a LEFT JOIN n ON n.profile = a.profile AND r = round), i AS (SELECT *, count(*) FILTER (WHERE k > 0) OVER (PARTITION BY profile ORDER BY round) island FROM g)
    SELECT profile AS session, round, count(*) FILTER (WHERE k = 0) OVER (PARTITION BY profile, island ORDER BY round) stagnant FROM i
""")
def stagnant_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log(spark, sf_dir).select(F.col("profile").alias("session"), "dedup_key", F.substring("captured_at", 1, 13).alias("round"))
    new = rows.groupBy("session", "dedup_key").agg(F.min("round").alias("round")).groupBy("session", "round").agg(F.count("*").alias("new_keys"))
    rounds = rows.select("session", "round").distinct().join(new, ["session", "round"], "left").withColumn("new_keys", F.coalesce("new_keys", F.lit(0)))
    return history.stagnation(rounds, "session", "round").select("session", "round", "stagnant")


@query("""
    , k AS (SELECT seq, coalesce('events:id:' || source_job_id, 'events:url:' || canonical_url) d, source_job_id i, canonical_url u FROM log),
    x AS (SELECT *, coalesce('i' || i, 'u' || u, 'k' || CASE WHEN seq % 11 = 0 THEN 'events:' || seq END) who, CASE WHEN seq % 11 <> 0 THEN d WHEN i IS NOT NULL THEN 'events:' || i WHEN u IS NOT NULL THEN 'events:' || u ELSE 'events:' || seq END k FROM k),
    y AS (SELECT *, CASE WHEN who IS NOT NULL THEN min(seq) FILTER (WHERE k <> d) OVER (PARTITION BY who) END o, min(seq) FILTER (WHERE k = d) OVER (PARTITION BY who) w FROM x)
    SELECT seq, CASE WHEN k = d AND o < w THEN 'events:' || coalesce(i, u) ELSE k END dedup_key FROM y
""")
def legacy_identity_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """legacy_identity over every record: by id, by URL without one, and without either."""
    rows = log(spark, sf_dir).withColumn("default_key", normalize.default_key(F.col("source"), F.col("source_job_id"), F.col("canonical_url")))
    old = F.concat("source", F.lit(":"), F.coalesce("source_job_id", "canonical_url", F.col("seq").cast("string")))
    return identity.resolved_keys(rows.withColumn("dedup_key", F.when(F.col("seq") % 11 == 0, old).otherwise(F.col("default_key")))).select("seq", "dedup_key")


@query("""
    SELECT c_custkey, coalesce(nullif(o.p, ''), c_mktsegment) title, c_name company, coalesce(o.d, DATE '2000-01-01') posted_at, c_custkey::VARCHAR source_job_id, 'run' AS run_id, coalesce(o.p, '') description
    FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) p, arg_max(o_orderdate, o_orderkey)::DATE d FROM orders GROUP BY 1) o ON o_custkey = c_custkey
""")
def stub_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A detail's values over its stub's: the stub's id, date and run fields stay where the detail says nothing."""
    stubs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("dedup_key"), F.col("c_mktsegment").alias("title"), F.col("c_name").alias("company"), F.lit("2000-01-01").cast("date").alias("posted_at"), F.col("c_custkey").cast("string").alias("source_job_id"), F.lit("run").alias("run_id"))
    found = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("dedup_key")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("title"), F.max_by("o_orderdate", "o_orderkey").cast("date").alias("posted_at"), F.lit("").alias("company"), F.lit("").alias("source_job_id"), F.max_by("o_orderpriority", "o_orderkey").alias("description"))
    return joins.enriched(stubs, found).select(F.col("dedup_key").alias("c_custkey"), "title", "company", "posted_at", "source_job_id", "run_id", "description")
