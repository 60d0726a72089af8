"""Mixing in the pipeline moves each text once, and tables that nothing reads any more are removed."""

import random
from pathlib import Path

import corpus_pipeline
import pytest

from ledgermill.llm import mixing, ngram_join
from ledgermill.shared import alone, saved, shared_dir

SCHEMA = "doc_id long, text string, source string, n_chars int"


def documents(spark, n=3000):
    r = random.Random(7)
    rows = [(k if k % 50 else None, " ".join(f"w{r.randrange(99)}" for _ in range(r.choice((0, 1, 5, 40, 900)))), r.choice(["a", "b", "c", "d", None]), k) for k in range(n)]
    return spark.createDataFrame(rows + rows[:20] * 2, SCHEMA)


def tables(spark):
    folder = Path(shared_dir(spark).removeprefix("file://")) / "ledgermill"
    return {p.name.rsplit("-", 1)[0] for p in folder.iterdir()} if folder.exists() else set()


def test_trained_is_what_training_rows_are(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART_WORDS", 30_000, raising=False)
    monkeypatch.setattr(mixing, "CELL_ROWS", 20)
    docs = saved(documents(spark), "trained-docs")
    want, got = mixing.training_rows(mixing.mix(docs)).collect(), mixing.trained(docs).collect()
    named = lambda rows: [tuple(r) for r in rows if r["doc_id"] is not None]  # noqa: E731  (rows without an id are interchangeable)
    assert sorted(map(str, named(want))) == sorted(map(str, named(got)))
    assert sum(len(r["text"].split()) for r in want) == sum(len(r["text"].split()) for r in got)
    place = {}
    for i, r in enumerate(named(want)):
        place.setdefault(r, []).append(i)
    once = [place[r][0] for r in named(got) if len(place[r]) == 1]
    assert once == sorted(once) and len(once) > 500


def test_a_text_moves_once(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART_WORDS", 30_000, raising=False)
    docs = saved(documents(spark), "trained-docs")
    plan = corpus_pipeline.mixed(spark, docs, "unread")._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
    assert len(moves) == 1, moves


def test_only_the_classes_are_left(spark):
    before = tables(spark)
    docs = spark.createDataFrame([(k, f"one two three four five six {k // 2}") for k in range(40)], "doc_id long, text string")
    assert ngram_join.ngram_components(docs).where("component_id <> doc_id").count() == 20
    assert tables(spark) - before <= {"ngram-classes"}
    assert ngram_join.representatives(docs).count() == 20
    assert tables(spark) - before <= {"ngram-classes", "ngram-gone", "ngram-mixed"}


def test_alone_leaves_its_result_only(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_before = spark.conf.get(key)
    out = alone(spark, lambda: saved(spark.range(9).groupBy("id").count(), "alone-inner").where("id > 3"), "alone-out")
    assert out.count() == 5 and "alone-out" in tables(spark) and "alone-inner" not in tables(spark)
    with pytest.raises(ValueError):
        alone(spark, lambda: (_ for _ in ()).throw(ValueError()), "alone-out")
    assert spark.conf.get(key) == set_before


def test_levels_grow_with_the_shingles():
    assert [ngram_join.level_bits(n) for n in (0, 1000, 20_000_000, 100_000_000, 10**12)] == [16, 16, 24, 26, 27]
