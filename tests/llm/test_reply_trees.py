"""Reply trees on odd tables, against paths walked message by message."""

import math
import random

from pyspark.sql import functions as F

from ledgermill.llm import chat

SCHEMA = "tree string, node long, parent long, score double, role string, text string, rank long, place string, _m string"


def brute(rows, best=None):
    """(tree, leaf, rank) -> nodes from the root."""
    trees = {}
    for tree, node, parent, score in rows:
        if tree is not None and node is not None:
            key = (parent is not None, parent or 0, score is not None, score or 0.0)
            trees.setdefault(tree, {}).setdefault(node, []).append((key, parent, score))
    out = {}
    for tree, found in trees.items():
        nodes = {n: min(v)[1:] for n, v in found.items()}
        paths = []
        for leaf in nodes.keys() - {p for p, _ in nodes.values()}:
            path, at = [], leaf
            while at in nodes and at not in path:
                path.append(at)
                at = nodes[at][0]
            if at not in path:
                total = sum(s if s is not None and not math.isnan(s) else 0.0 for _, s in (nodes[n] for n in path))
                paths.append((-total / len(path), len(path), leaf, path[::-1]))
        for k, (_, _, leaf, path) in enumerate(sorted(paths)[:best]):
            out[tree, leaf, k + 1] = path
    return out


def found(df, best=None):
    out = {}
    for r in chat.reply_paths(df, best).orderBy("depth").collect():
        out.setdefault((r["tree"], r["leaf"], r["rank"]), []).append(r["node"])
    return out


def rows_of():
    rng = random.Random(4)
    rows = [("deep", i, i - 1 if i else None, 1.0) for i in range(70)]
    rows += [("wide", 0, None, 1.0)] + [("wide", i, 0, float(rng.randint(0, 4))) for i in range(1, 60)]
    rows += [("mix", i, rng.randint(0, i - 1) if i else None, float(rng.randint(0, 3))) for i in range(40)]
    rows += [("twice", 1, None, 2.0), ("twice", 1, None, 2.0), ("twice", 2, 1, 1.0), ("twice", 2, 1, 3.0), ("twice", 2, None, None), ("twice", 3, 2, None), ("twice", 3, 1, 1.0)]
    return rows + [(None, 1, None, 1.0), ("t", None, None, 1.0), ("t", 1, None, None), (None, None, None, None)]


def table(spark, rows):
    return spark.createDataFrame([(*r, "user" if (r[1] or 0) % 2 else "assistant", f"m{r[1]}", 7, "p", "m") for r in rows], SCHEMA)


def test_deep_wide_and_repeated(spark, monkeypatch):
    rows = rows_of()
    df = table(spark, rows).cache()
    want = brute(rows)
    assert found(df) == want
    monkeypatch.setattr(chat, "WIDE", 10)  # the wide trees are ranked over range partitions
    assert found(df.repartition(3), 5) == brute(rows, 5)
    assert {(r["tree"], r["leaf"], r["rank"]): r["formatted"].count(chat.START) for r in chat.formatted(df).collect()} == {k: len(v) for k, v in want.items()}
    assert chat.formatted(df.limit(0)).count() == 0


def test_repeated_texts_give_one_turn(spark):
    df = table(spark, [("t", 1, None, 1.0)]).withColumn("text", F.explode(F.array(F.lit("b"), F.lit("a"), F.lit(None).cast("string"))))
    got = chat.formatted(df).collect()
    assert [r["formatted"] for r in got] == ["<|im_start|>user\n<|im_end|>\n"]
