"""The registered queries over the smallest driver tables: against SQL where there is some, else their contracts."""

import os
from collections import defaultdict

import duckdb
import pytest

import corpus_pipeline
from ledgermill.llm import queries

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no driver tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DIR}/{f}'")
    df = queries.QUERIES[name](spark, DIR)
    want = con.sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    order = [want.columns.index(c) for c in sorted(want.columns)]
    assert sorted(repr([plain(r[c]) for c in sorted(df.columns)]) for r in df.collect()) == sorted(repr([plain(r[i]) for i in order]) for r in want.fetchall())


def test_one_query_for_each_operator():
    assert sorted({int(n[2:].split("_")[0]) for n in queries.QUERIES}) == list(range(1, 14))


def test_reruns_agree(spark):
    for name in ("op1_mixing", "op4_packing"):
        assert sorted(map(tuple, queries.QUERIES[name](spark, DIR).collect())) == sorted(map(tuple, queries.QUERIES[name](spark, DIR).collect()))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.saved(stage(spark, docs, DIR), "test-stage")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        if k == 2:
            kept = docs.count()
            assert 0.7 * n < kept < n and docs.select("text").distinct().count() == kept
    sequences = defaultdict(int)
    for r in docs.collect():
        sequences[r["sequence_id"]] += r["length"]
        assert len(r["ids"]) == r["length"]
    assert max(sequences.values()) <= 4096
    assert len(corpus_pipeline.STAGES) == 5
