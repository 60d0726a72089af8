"""Exports from many tasks as one file: the rows' order, the bytes, failures; cards of search pages; due requests."""

import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from ledgermill.functions import html
from ledgermill.operators import joins
from ledgermill.plans import export
from ledgermill.shared import same_place


def rows(spark, n):
    one = {c: F.concat(F.lit(f"{c} \"q\", "), F.col("id").cast("string")) for c in export.EXPORT_FIELDS if c not in ("job_id", "snapshot_id", "applicants_count")}
    df = spark.range(0, n, 1, 7).withColumns(one | {"job_id": F.col("id"), "snapshot_id": F.col("id"), "applicants_count": F.col("id"), "salary_min": F.lit("1.50"), "industries": F.lit('["a"]'), "description": F.lit("two\nlines é")})
    return df.select(*export.EXPORT_FIELDS).orderBy(F.desc("job_id"))


@pytest.mark.parametrize("n", [0, 1, 5_000])
def test_one_file_in_order(spark, tmp_path, n):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = rows(spark, n)
        for name in ("a.jsonl", "a.json", "a.csv", "a.tracker"):
            out = tmp_path / name
            assert export.write(df, str(out), "tracker" if name.endswith("tracker") else None) == n
            text = out.read_text()
            if name == "a.jsonl":
                ids = [json.loads(line)["job_id"] for line in text.splitlines()]
            elif name == "a.json":
                assert text.startswith("[\n") and text.endswith("\n]\n") and (n or text == "[\n\n]\n")
                ids = [r["job_id"] for r in json.loads(text)]
            else:
                with out.open(newline="") as f:
                    table = list(csv.reader(f))
                assert len(table) == n + 1 and len(table[0]) == (34 if name == "a.csv" else 26)
                ids = [int(r[0].split()[-1]) for r in table[1:]]
            assert ids == list(range(n))[::-1], name
        assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".") or p.is_dir()) == ["a.csv", "a.json", "a.jsonl", "a.tracker"]
        if n > 1:
            assert df.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_a_failure_leaves_the_earlier_file(spark, tmp_path):
    out = tmp_path / "x.jsonl"
    export.write(rows(spark, 3), str(out))
    before = out.read_bytes()
    with pytest.raises(Exception, match="broken"):
        export.write(rows(spark, 3).withColumn("title", F.raise_error(F.lit("broken")).cast("string")), str(out))
    assert out.read_bytes() == before and [p for p in tmp_path.iterdir() if p.name.startswith(".staged")] == []


def test_an_output_over_an_input_however_it_is_written(spark, tmp_path):
    (tmp_path / "store").mkdir()
    (tmp_path / "link").symlink_to(tmp_path / "store")
    here = os.path.relpath(tmp_path / "store")
    for output in (here, f"./{here}", str(tmp_path / "store"), f"file://{tmp_path}/store/", str(tmp_path / "x/../store"), str(tmp_path / "link"), str(tmp_path / "store/out.json")):
        with pytest.raises(ValueError, match="overwrite"):
            export.write(rows(spark, 1), output, "json", (str(tmp_path / "store"),))
    assert not same_place(spark, str(tmp_path / "store2"), str(tmp_path / "store"))


def test_cards_of_a_page():
    page = """<ul><li><div class=base-card data-entity-urn="urn:li:jobPosting:7"><a class="base-card__full-link" href="/jobs/view/7"><span class=sr-only>Hidden title</span></a>
        <h4> Org <b>One</b></h4><time>1 day
        ago</time></div></li><li data-entity-urn="urn:li:jobPosting:8"></li><li><a href="/jobs/view/9">no URN</a></li></ul>"""
    first, second = html.page_cards(page, "https://e.com/search")
    assert first == {"entity_urn": "urn:li:jobPosting:7", "href": "https://e.com/jobs/view/7", "title": "Hidden title", "company": "Org One", "location": "", "posted_at": "1 day ago", "card_text": "Hidden title Org One1 day ago"}
    assert (second["entity_urn"], second["href"]) == ("urn:li:jobPosting:8", "")
    links = html.page_cards('<div class="job-search-card"><h3>T</h3><a href="/jobs/view/9">x</a></div><a href="https://e.com/jobs/view/10">alone</a><li><p>no link</p></li>', "https://e.com/")
    assert [(c["href"], c["title"], c["card_text"]) for c in links] == [("https://e.com/jobs/view/9", "T", "Tx"), ("https://e.com/jobs/view/10", "", "alone")]
    assert html.page_cards(None, None) == html.page_cards("<p>x", None) == []


def test_due_requests(spark):
    stubs = spark.createDataFrame([("s", "a", 1, "a", None), ("s", "b", 2, "b", None), ("t", "b", 1, "b", None), ("s", "c", 3, "c", "u"), ("o", "d", 1, "d", None), ("s", "d", 9, "d", None), ("s", "e", 4, "e", None), ("s", "f", 5, "f", None), ("s", "g", 6, None, "known")], "session string, identity string, rank long, source_job_id string, canonical_url string")
    sessions = spark.createDataFrame([("s", "max_results"), ("t", "empty_search"), ("o", None)], "session string, stop_reason string")
    attempts = spark.createDataFrame([("a", True), ("b", False), ("e", False), ("e", None), ("f", False), ("f", True)], "identity string, ok boolean")
    ids, urls = spark.createDataFrame([("zz",)], "source_job_id string"), spark.createDataFrame([("known",)], "canonical_url string")
    due = lambda a, **o: {tuple(r) for r in joins.due_requests(stubs, a, sessions, ids, urls, **o).collect()}
    assert due(attempts) == {("b", 1, 2), ("c", 3, 1)}  # a: done; d: a session still looks; e: failed twice; f: done at last; g: known
    later = attempts.unionByName(spark.createDataFrame([("b", False), ("c", True)], "identity string, ok boolean"))
    assert due(later) == set() and due(later, retries=2) == {("b", 1, 3), ("e", 4, 3)}
    assert due(attempts, retries=0) == {("c", 3, 1)}


@pytest.mark.parametrize("n", [0, 1, 400])
def test_exports_are_read_by_many_tasks(spark, tmp_path, n):
    """Blocks of a few kilobytes: cells with line ends, quotes and long texts go over their edges."""
    said = ["plain", "", None, "two\nlines", 'a "quoted" one', '"', '""\n"', "\r\n", "\n\n", "x,\ny", "end,", "long \n" * 900, "=1", " \tpad "]
    df = spark.createDataFrame([(i, said[i % len(said)], said[(i * 5 + i // 14) % len(said)]) for i in range(n)], "job_id long, company string, description string").repartition(3)
    keys = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1k"}
    export.write(df, f"{tmp_path}/a.csv")
    export.write(df, f"{tmp_path}/a.json")
    with open(f"{tmp_path}/a.csv", newline="") as f:
        want = sorted(csv.reader(f))
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        back = export.read_csv(spark, f"{tmp_path}/a.csv", df.columns)
        got = sorted([["" if v is None else v for v in r] for r in back.collect()] + [df.columns])
        assert got == want
        rows = export.read_json(spark, f"{tmp_path}/a.json", "job_id long, company string, description string")
        assert sorted(map(repr, rows.collect())) == sorted(map(repr, df.collect()))
        assert n < 400 or rows.rdd.getNumPartitions() > 10
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
