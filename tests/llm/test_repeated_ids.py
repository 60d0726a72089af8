"""The n-gram join where different texts share an id."""

import random

from ledgermill.llm import ngram_join


def test_texts_of_one_id_are_linked_and_removed_one_by_one(spark):
    rng = random.Random(9)
    a, b, c = ([f"w{rng.randrange(10**6)}" for _ in range(200)] for _ in range(3))
    near = lambda words: " ".join([*words[:-2], "x", "y"])
    rows = [(1, " ".join(a)), (2, " ".join(b)), (5, near(a)), (5, near(b)), (5, " ".join(c)), (7, near(c))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in ngram_join.ngram_components(docs).collect())
    assert got == [(1, 1), (2, 2), (5, 1), (5, 2), (5, 5), (7, 5)]
    assert sorted(map(tuple, ngram_join.representatives(docs).collect())) == sorted([rows[0], rows[1], rows[4]])
