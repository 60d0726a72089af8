"""The pipeline's stages on odd tables: nulls, empty and long texts, repeated rows and ids, clashing names, no rows."""

from collections import Counter, defaultdict

import corpus_pipeline

from test_small_cases import ODD, table

#: Ids of the rows that each stage keeps of ODD.
KEPT = [[1, 5, 6, 7, 8, 8, 9, 10, 11, None], [1, 5, 6, 9, 10, 11, None], [1, 5, 6, 9, 10, None]]


def after(docs):
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        docs = corpus_pipeline.saved(stage(docs.sparkSession, docs, "unread"), "test-stage")
        assert k == 4 or docs.columns == columns, name
        yield docs


def test_stages_on_odd_rows(spark):
    stages = list(after(table(spark, ODD)))
    for docs, want in zip(stages, KEPT):
        assert Counter(r["doc_id"] for r in docs.select("doc_id").collect()) == Counter(want)
    mixed = Counter(r["doc_id"] for r in stages[3].select("doc_id").collect())
    assert mixed.keys() <= set(KEPT[2]) and mixed[6] == mixed[9] == mixed[10] == 2 and mixed[5] >= 1  # small sources are taken twice
    filled, pieces = defaultdict(int), stages[4].collect()
    for r in pieces:
        assert len(r["ids"]) == r["length"]
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 4096 and {r["doc_id"] for r in pieces} == mixed.keys()


def test_stages_without_rows(spark):
    assert [docs.count() for docs in after(table(spark, []))] == [0] * 5
