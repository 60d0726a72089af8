"""Change tracking, sources and sinks on small logs."""

import json

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import history, identity, joins, normalize
from ledgermill.plans import export
from ledgermill.shared import saved
from ledgermill.sources import config, jsonl, registry

NOW = "2026-09-01T09:00:00Z"


def records(spark, *rows):
    names = sorted({k for r in rows for k in r})
    df = spark.createDataFrame([(i + 1, *(r.get(n) for n in names)) for i, r in enumerate(rows)], "seq long, " + ", ".join(f"{n} string" for n in names))
    return saved(normalize.normalized(df.withColumn("run_id", F.lit("r1")), F.lit(NOW).cast("timestamp"), keep=("seq", "run_id")), "log")


def rec(**k):
    return {"source": "example", "source_job_id": "42", "source_url": "https://example.com/42", "company": "Acme", "title": "Role", "description": "Text", "captured_at": NOW, "capture_status": "complete"} | k


def test_keys(spark):
    rows = [rec(), rec(source="Another"), rec(source_job_id=None), rec(dedup_key="example:42"), rec(dedup_key="other:42"), rec(source_job_id=None, source_url=None)]
    assert [r["dedup_key"] for r in records(spark, *rows).orderBy("seq").collect()] == ["example:id:42", "another:id:42", "example:url:https://example.com/42", "example:42", None, None]


def test_hash(spark):
    rows = [rec(), rec(title=" role ", captured_at="2026-09-02T09:00:00Z"), rec(title="Other"), rec(capture_status="partial")]
    h = [r["content_hash"] for r in records(spark, *rows).orderBy("seq").collect()]
    assert h[0] == h[1] and len(set(h)) == 3


def test_change_and_return(spark):
    log = records(spark, rec(), rec(description="B", captured_at="2026-09-02"), rec(captured_at="2026-09-03"))
    assert history.snapshots(log, "seq").count() == 2
    one = history.identities(log).first()
    first = history.snapshots(log, "seq").orderBy("seq").first()
    assert one["latest_hash"] == first["content_hash"] and one["first_seen_at"] == NOW and one["last_seen_at"] == "2026-09-03"


def test_partial_does_not_clear(spark):
    log = records(spark, rec(), rec(capture_status="partial", description=None))
    shown = history.latest(log).first()
    assert shown["description"] == "Text" and shown["seq"] == 1
    one = history.identities(log).first()
    assert one["latest_hash"] != one["latest_complete_hash"]


def test_hits(spark):
    rows = [("r", "k", 1, "h1", 4, None, "{}"), ("r", "k", 2, "h2", 2, 3, '{"a":1}'), ("r", "k", 3, "h3", None, 5, "{}")]
    df = spark.createDataFrame(rows, "run_id string, dedup_key string, seq long, content_hash string, position long, page_number long, metadata string")
    none = F.lit(None).cast("string")
    df = df.withColumns({c: none for c in ("profile", "query", "location", "search_url", "hit_url")} | {"discovered_at": F.col("seq")})
    got = history.hits(df).collect()
    assert len(got) == 1 and (got[0]["content_hash"], got[0]["position"], got[0]["page_number"], got[0]["metadata"], got[0]["discovered_at"], got[0]["profile"]) == ("h3", 2, 3, '{"a":1}', 1, "")


def test_legacy_keys(spark):
    rows = [(1, "s", "s:1", "s:id:1", "1"), (2, "s", "s:id:1", "s:id:1", "1"), (3, "s", "s:id:2", "s:id:2", "2"), (4, "s", "s:2", "s:id:2", "2"), (5, "s", "s:id:2", "s:id:2", "2"), (6, "s", "s:mine", "s:id:3", "3"), (7, "s", "s:id:3", "s:id:3", "3")]
    df = spark.createDataFrame(rows, "seq long, source string, dedup_key string, default_key string, source_job_id string").withColumn("canonical_url", F.lit(None).cast("string"))
    assert [r["dedup_key"] for r in identity.resolved_keys(df).orderBy("seq").collect()] == ["s:1", "s:1", "s:id:2", "s:2", "s:id:2", "s:mine", "s:id:3"]


def test_export(spark, tmp_path):
    log = records(spark, rec(salary_min="60000", salary_currency="usd", salary_interval="year", industries='["a","b"]'), rec(source_job_id="7", capture_status="partial", captured_at="2026-09-05T12:00:00+03:00", title="=x"))
    rows = export.latest_listings(log)
    assert [r["source_job_id"] for r in rows.collect()] == ["7", "42"] and rows.columns == list(export.EXPORT_FIELDS)
    assert [r["source_job_id"] for r in export.latest_listings(log, complete_only=True).collect()] == ["42"]
    assert export.latest_listings(log, limit=0).count() == 0 and export.latest_listings(log, since="2026-09-05T09:00:00Z").count() == 1
    assert "raw_json" in export.latest_listings(log, include_raw=True).columns
    for name, n in (("a.jsonl", 2), ("a.json", 2), ("a.csv", 3)):
        out = tmp_path / name
        assert export.write(rows, str(out)) == 2
        assert export.write(rows, str(out)) == 2
        data = out.read_text()
        if name == "a.jsonl":
            both = [json.loads(x) for x in data.splitlines()]
            assert both[1]["salary_min"] == 60000 and both[1]["industries"] == ["a", "b"] and both[0]["salary_min"] is None and list(both[0]) == list(export.EXPORT_FIELDS)
        elif name == "a.json":
            assert len(json.loads(data)) == 2
        else:
            assert len(data.splitlines()) == n and ",'=x," in data
    tracker = export.tracker(rows).collect()
    assert len(tracker[0]) == 26 and tracker[1]["Salary / currency"] == "from 60 000 USD / year" and tracker[0]["Added"] == "2026-09-05"
    assert export.tracker(rows, "ru").collect()[1]["Вилка / валюта"] == "от 60 000 USD / год"
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == ["a.csv", "a.json", "a.jsonl"]
    empty = tmp_path / "none.json"
    assert export.write(rows.limit(0), str(empty)) == 0 and json.loads(empty.read_text()) == []


def test_export_arguments(spark):
    assert export.format_of("Sheet", "x") == "tracker-csv" and export.format_of(None, "a.csv") == "csv" and export.format_of(None, "a.txt") == "jsonl"
    for bad in ("", "tomorrow"):
        with pytest.raises(ValueError):
            export.since_text(bad)
    with pytest.raises(ValueError):
        export.format_of("xml", "a")
    assert export.since_text("2026-08-01T03:00:00+03:00") == "2026-08-01T00:00:00Z"


GOOD = {"source_url": "https://example.com/1", "company": "A", "title": "T", "description": "D", "source_job_id": "1", "dedup_key": "x:1", "source": "other", "note": 5}


def test_jsonl(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join([json.dumps(GOOD), "", json.dumps(GOOD | {"source_job_id": "2", "description": " "}), json.dumps(GOOD | {"source_job_id": "3"}), "[1]", json.dumps(GOOD)]))
    found = jsonl.scan(spark, str(path))
    assert found.bad_line == 5 and found.records.count() == 3
    with pytest.raises(ValueError, match="line 5"):
        found.check()
    limited = jsonl.scan(spark, str(path), max_results=2)
    got = limited.records.orderBy("seq").collect()
    assert limited.bad_line is None and [r["source"] for r in got] == ["jsonl", "jsonl"] and [r["capture_status"] for r in got] == ["complete", "partial"] and [r["search_rank"] for r in got] == [1, 2]
    log = normalize.normalized(limited.records, keep=("seq", "run_id"))
    assert [r["dedup_key"] for r in log.orderBy("seq").collect()] == ["jsonl:id:1", "jsonl:id:2"]


def test_registry_and_demo(spark):
    assert [s.slug for s in registry.listed()] == ["demo", "jsonl"]
    for slug in ("demo", "Bad Slug"):
        with pytest.raises(ValueError):
            registry.register(registry.Source(slug, "", lambda s: None))
    with pytest.raises(ValueError):
        registry.load(spark, "jsonl")
    demo = registry.load(spark, "demo")
    twice = demo.unionByName(demo.withColumns({"seq": F.col("seq") + 4, "run_id": F.lit("again")}))
    log = normalize.normalized(twice, F.lit(NOW).cast("timestamp"), keep=("seq", "run_id")).withColumns({c: F.lit("") for c in ("profile", "query", "location")})
    flags = history.change_flags(log)
    got = flags.agg(*(F.sum(F.col(c).cast("int")).alias(c) for c in ("new_job", "new_snapshot", "new_hit"))).first()
    assert tuple(got) == (3, 3, 6)


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("defaults: {max_results: 25}\nsearches:\n- {id: a, keywords: ' x '}\n- {id: b, keywords: y, enabled: false, max_results: 3}\n")
    c = config.load(str(path))
    assert c.resolved("a") == {"keywords": "x", "location": "Worldwide", "max_results": 25, "filters": c.filters}
    with pytest.raises(ValueError):
        c.profile("b")
    for bad in ("searches: [{id: a, keywords: x}, {id: a, keywords: x}]", "nope: 1", "searches: [{id: a, keywords: ' '}]", "defaults: {max_results: 0}"):
        path.write_text(bad)
        with pytest.raises(ValueError):
            config.load(str(path))
    assert config.boolean("Yes") is True and config.boolean("off") is False


def test_cards_stubs_and_lookups(spark):
    cards = spark.createDataFrame([(1, "urn:li:jobPosting:5", "/jobs/view/5", "", "A"), (2, "", "https://x.linkedin.com/jobs/view/5", "T", "B"), (3, "", "", "no", "no")], "seq long, entity_urn string, href string, title string, company string").withColumns({c: F.lit("") for c in ("location", "posted_at", "card_text")})
    got = joins.merged_cards(cards).collect()
    assert len(got) == 1 and (got[0]["identity"], got[0]["title"], got[0]["company"], got[0]["location"]) == ("5", "T", "A", None)
    urls = spark.createDataFrame([(1, "/jobs/view/9"), (2, "https://www.linkedin.com/jobs/view/x-9"), (3, "https://e.com/a")], "rank long, url string")
    assert sorted((r["search_rank"], r["source_job_id"]) for r in joins.direct_stubs(urls).collect()) == [(1, "9"), (3, None)]
    log = records(spark, rec(), rec(source_job_id="43", description=" "))
    ids, _ = joins.known(log, "example")
    assert [r[0] for r in ids.collect()] == ["42"]


def test_stream(spark, tmp_path):
    from ledgermill.streaming import ingest

    names = sorted({k for r in (rec(),) for k in r})
    for i in range(2):
        rows = [(i * 2 + j, "r", *(rec(source_job_id=str(j))[n] for n in names)) for j in range(2)]
        spark.createDataFrame(rows, "seq long, run_id string, " + ", ".join(f"{n} string" for n in names)).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    schema = spark.read.parquet(str(tmp_path / "in/0")).schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    ingest.append_to_log(stream, str(tmp_path / "log"), str(tmp_path / "ck")).awaitTermination(60)
    log = ingest.read_log(spark, str(tmp_path / "log"))
    assert log.count() == 4 and history.identities(log).count() == 2


def test_numbers_of_many_wide_rows(spark):
    """Numbers over many partitions: every row once, in order, whatever the partitions are cut to."""
    wide = spark.range(0, 300_000, 1, 40).select((F.col("id") * 7 % 300_007).alias("first_seq"), F.repeat(F.md5(F.col("id").cast("string")), 8).alias("wide"))
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        got = history.numbered(wide)
        ranked = got.agg(F.count("*"), F.countDistinct("job_id"), F.min("job_id"), F.max("job_id"), F.count("wide")).first()
        assert tuple(ranked) == (300_000, 300_000, 1, 300_000, 300_000)
        back = got.alias("a").join(got.alias("b"), F.col("b.job_id") == F.col("a.job_id") + 1).where("a.first_seq >= b.first_seq")
        assert back.isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_export_shows_the_first_capture_of_a_content(spark):
    log = records(spark, rec(), rec(captured_at="2026-09-05T09:00:00Z"))
    row = export.latest_listings(log).first()
    assert (row["captured_at"], row["first_seen_at"], row["last_seen_at"], row["snapshot_id"]) == (NOW, NOW, "2026-09-05T09:00:00Z", 1)


def test_stagnation(spark):
    rounds = spark.createDataFrame([("s", i, n) for i, n in enumerate([3, 0, 0, 2, 0, 0, 0])], "session string, round long, new_keys long")
    assert [r["stagnant"] for r in history.stagnation(rounds, "session", "round").orderBy("round").collect()] == [0, 1, 2, 0, 1, 2, 3]


def test_session_chunks_keep_state(spark, tmp_path):
    """New cards of a session over several batches, up to its target, by rank."""
    from ledgermill.streaming import ingest

    for i, ids in enumerate((["a", "b", "a"], ["b", "c", "d", "e"])):
        spark.createDataFrame([("s", x) for x in ids] + [("t", "z")], "session string, identity string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("session string, identity string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run = ingest.session_chunks(stream, 4).writeStream.format("memory").queryName("chunks").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = {(r["session"], r["identity"]): r["rank"] for r in spark.table("chunks").collect()}
    assert got.pop(("t", "z")) == 1 and sorted(got.values()) == [1, 2, 3, 4] and len({i for _, i in got}) == 4
