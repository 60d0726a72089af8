"""JSON Lines: line numbers whatever the task slots, and what detail pages say of dates and pay."""

import json

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import detail
from ledgermill.sources import jsonl


@pytest.mark.parametrize("slots", [(2, 16), (16, 2)])
def test_line_numbers_when_task_slots_change(spark, tmp_path, slots):
    """Splits of a file depend on the slots: they change between planning the numbers and reading the lines."""
    n = 60_000
    for part in range(2):
        (tmp_path / f"{part}.jsonl").write_text("".join(f"line {part * n + i:07d} {'x' * 60}\n" if i % 10 else "\n" for i in range(n)))
    keys = {"spark.sql.files.minPartitionNum": str(slots[0]), "spark.sql.files.maxPartitionBytes": "1m", "spark.sql.files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = jsonl.lines(spark, str(tmp_path))
        spark.conf.set("spark.sql.files.minPartitionNum", str(slots[1]))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
        wrong = df.where(F.col("line") - 1 != F.substring("value", 6, 7).cast("long")).count()
        assert wrong == 0 and df.count() == 2 * n * 9 // 10 and df.agg(F.max("line")).first()[0] == 2 * n
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def posting(**fields):
    return f'<script type="application/ld+json">{json.dumps({"@type": "JobPosting"} | fields)}</script>'


def shown(spark, *pages):
    df = spark.createDataFrame([(i, "https://e.com/p", html, ("1 week ago",)) for i, html in enumerate(pages)], "i int, url string, html string, stub struct<posted_at: string>")
    return detail.details(df, F.lit("2024-03-10").cast("date"), stub="stub").orderBy("i").collect()


def test_dates_are_tried_place_by_place(spark):
    time, ago = '<time datetime="2024-02-01">x</time>', '<span class="posted-time-ago__text">2 days ago</span>'
    got = shown(spark, posting(datePosted="soon") + time, posting(datePosted="soon") + '<time datetime="whenever">x</time>', time, '<time datetime="whenever">x</time>' + ago, ago, "<p>none</p>", posting(datePosted="2024-01-05T23:00:00+03:00") + time, posting(datePosted="soon"), '<time datetime="">x</time>' + ago)
    assert [str(r["posted_at"]) for r in got] == ["2024-02-01", "None", "2024-02-01", "None", "2024-03-08", "2024-03-03", "2024-01-05", "2024-03-03", "2024-03-08"]


def test_an_amount_that_is_said_to_be_null(spark):
    pay = [{"value": {"minValue": None, "value": 5}}, {"value": {"minValue": None, "maxValue": 7, "value": 5}}, {"value": {"value": 5}}, {"value": 5}, {"value": None}, {"value": {"minValue": "x", "value": 5}}, {"value": {"minValue": None, "maxValue": None, "value": 5}}]
    got = shown(spark, *(posting(baseSalary=p) for p in pay))
    said = [tuple(None if r[c] is None else float(r[c]) for c in ("salary_min", "salary_max")) for r in got]
    assert said == [(None, 5), (None, 7), (5, 5), (5, 5), (None, None), (None, 5), (None, None)]


def test_a_scan_parses_no_more_than_it_must(spark, tmp_path, monkeypatch):
    """A bad line or the limit among the first lines: the others aren't parsed. Neither: all lines are."""
    monkeypatch.setattr(jsonl, "HEAD_LINES", 10)
    line = lambda i: json.dumps({"url": f"https://e.com/{i}", "source_url": f"https://e.com/{i}", "source_job_id": str(i), "company": "c", "title": "t", "description": "d"})
    for part in range(2):
        (tmp_path / f"{part}.jsonl").write_text("".join(("[1]" if i in (4, 30) else line(i)) + "\n" for i in range(part * 20, part * 20 + 20)))
    parsed, kept = [], jsonl.saved
    monkeypatch.setattr(jsonl, "saved", lambda df, name: parsed.append(kept(df, name)) or parsed[-1])
    found = jsonl.scan(spark, str(tmp_path))
    assert found.bad_line == 5 and found.records.count() == 4 and parsed[-1].count() == 10
    assert jsonl.scan(spark, str(tmp_path), max_results=4).records.count() == 4 and parsed[-1].count() == 10
    (tmp_path / "0.jsonl").write_text("".join(line(i) + "\n" for i in range(20)))
    found = jsonl.scan(spark, str(tmp_path))
    assert found.bad_line == 31 and found.records.count() == 30 and parsed[-1].count() == 40
    found = jsonl.scan(spark, str(tmp_path), max_results=25)
    assert found.bad_line is None and [r["search_rank"] for r in found.records.orderBy("seq").collect()] == list(range(1, 26))
