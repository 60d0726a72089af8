"""Components against a plain union of sets, and the number of rounds on long paths."""

import random

from pyspark.sql import functions as F

from ledgermill.llm.components import components


def plain(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {x: find(x) for x in root}


def test_small_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(5, 5), (7, None), (None, 8), (400, 401), (401, 400), (400, 401)]
    edges += [(1000, k) for k in range(1001, 1060)]
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["root"] for r in got.collect()} == plain(edges)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_rising_path_takes_few_rounds(spark):
    path = spark.range(10_000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    rounds = []
    got = components(path, rounds)
    assert got.where("root = 0").count() == 10_001 == got.count()
    assert len(rounds) <= 20 and rounds[1] < 0.7 * rounds[0]
