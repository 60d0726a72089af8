"""Large components of the n-gram join: pivots connect the copies of a text, blocks what is left, as all pairs would."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from ledgermill.llm import ngram_join


def brute(texts):
    sets = {}
    for i, t in texts.items():
        w = "".join(c.lower() if c < "\x80" else c for c in t).split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root = {i: i for i in texts}
    for a, b in combinations(sorted(texts), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {k: low if r == high else r for k, r in root.items()}
    return root


def family(r, base, copies, changes):
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(r.randrange(changes + 1)):
            w[r.randrange(len(w))] = f"n{r.randrange(10**6)}"
        out.append(" ".join(w + [f"t{i}" for i in range(r.randrange(6))]))
    return out


@pytest.mark.parametrize(("pivots", "sets", "seed"), [(32, 3, 1), (1, 3, 2), (0.01, 4, 3)])
def test_against_all_pairs(spark, monkeypatch, pivots, sets, seed):
    """Families whose members drift: some are linked only through others. Pivots that connect all, a few, or almost none."""
    monkeypatch.setattr(ngram_join, "PIVOTS", pivots)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", sets)
    r = random.Random(seed)
    texts = []
    for k in range(3):
        base = [f"w{k}_{i}" for i in range(70)]
        texts += family(r, base, 14, 3)
        for step in range(6):  # a chain: neighbours are linked, the ends aren't
            texts.append(" ".join([*base[step * 4 :], *(f"c{k}_{i}" for i in range(step * 4))]))
    r.shuffle(texts)
    named = dict(enumerate(texts))
    got = {row["doc_id"]: row["component_id"] for row in ngram_join.ngram_components(spark.createDataFrame(list(named.items()), "doc_id long, text string").repartition(3)).collect()}
    assert got == brute(named)


def groups(spark, n, size=100):
    return spark.range(n).select(F.xxhash64("id").alias("s1"), F.xxhash64("id", F.lit(1)).alias("s2"), F.col("id").alias("rep"), F.lit(size).cast("long").alias("n"), F.lit(7).cast("long").alias("comp"))


def test_copies_of_one_template_make_rows_linear_in_their_number(spark):
    rows = {}
    for n in (10_000, 100_000):
        tiles, large = ngram_join._laid_out(groups(spark, n))
        rows[n] = tiles.count()
        assert rows[n] < 1.3 * n and tiles.groupBy("tile").count().agg(F.max("count")).first()[0] < 2 * ngram_join.BLOCK_SETS
        one = large.select(F.col("s1").alias("node"), F.lit(1).cast("long").alias("root"))
        assert ngram_join._rest_laid_out(large, one) is None
        few = one.where(F.pmod("node", F.lit(n // 50)) != 0)  # about 50 sets aren't connected yet
        rest = ngram_join._rest_laid_out(large, few)
        assert rest.count() < 1.3 * n
    assert rows[100_000] < 11 * rows[10_000]
