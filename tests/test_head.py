"""A scan that stops among its first lines doesn't look into later ones."""

from pyspark.sql import functions as F

from ledgermill.sources import jsonl


def test_later_lines_are_not_looked_into(spark, tmp_path, monkeypatch):
    whole = jsonl.text
    monkeypatch.setattr(jsonl, "HEAD_LINES", 10)
    monkeypatch.setattr(jsonl, "text", lambda c: F.when(c.contains("later"), F.raise_error(F.lit("looked into")).cast("string")).otherwise(whole(c)))
    line = '{"source_url": "https://e.com/1", "company": "a", "title": "b"}'
    (tmp_path / "a.jsonl").write_text("\n".join([line, " ", line, "[1]", *[line] * 10, '"later"']))
    found = jsonl.scan(spark, str(tmp_path))
    assert found.bad_line == 4
    assert [r["seq"] for r in found.records.orderBy("seq").collect()] == [1, 3]
    assert [r["seq"] for r in jsonl.scan(spark, str(tmp_path), max_results=2).records.orderBy("seq").collect()] == [1, 3]
