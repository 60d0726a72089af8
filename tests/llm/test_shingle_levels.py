"""Rarity of shingles: counted over all sets, and not blurred by the many shingles that one set has alone."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from ledgermill.llm import ngram_join


def table_of(texts, tasks):
    """The table of levels of texts that are dealt over so many map tasks."""
    rows = []
    for k in range(tasks):
        own = texts[k::tasks]
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(own)), pa.int64()), pa.array([t.encode() for t in own], pa.binary())], names=["doc_id", "text"])
        for b in ngram_join._names_and_counts(iter([batch])):
            rows += [(n, c) for n, c in zip(b.column(1).to_pylist(), b.column(5).to_pylist(), strict=True) if c is not None]
    rows.sort(key=lambda r: r[0])
    whole = pa.RecordBatch.from_arrays([pa.array([n for n, _ in rows], pa.int64()), pa.array([c for _, c in rows], pa.binary())], names=["n", "counts"])
    part = 1 << (ngram_join.LEVEL_BITS - 1 - ngram_join.SLICE_BITS)
    table = np.zeros(part << ngram_join.SLICE_BITS, dtype=np.uint8)
    for b in ngram_join._leveled(iter([whole])):
        for n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            table[n * part : (n + 1) * part] = np.frombuffer(x, dtype=np.uint8)
    return table


def corpus():
    r = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [" ".join(f"w{r.randrange(10**9)}" for _ in range(300)) for _ in range(400)]
    return [f"{t} {passage}" if k < 20 else t for k, t in enumerate(texts)] + ["a b c d e"] * 2, passage


def test_levels_are_those_of_the_counts(monkeypatch):
    monkeypatch.setattr(ngram_join, "COUNTED", 20_000)  # several slices' parts from a task
    texts, _ = corpus()
    table = table_of(texts, 3)
    sets = ngram_join.shingle_sets([t.encode() for t in texts])
    counts = Counter((np.concatenate(sets) >> np.uint64(32)).tolist())
    most = Counter()
    for key, n in counts.items():
        entry = key >> (32 - ngram_join.LEVEL_BITS)
        most[entry] = max(most[entry], (n - 1).bit_length())
    for s in sets:
        assert ngram_join._level_of(table, s).tolist() == [most[int(x) >> (64 - ngram_join.LEVEL_BITS)] for x in s]


def test_a_passage_stands_out_where_shingles_are_many_times_the_entries(monkeypatch):
    """As in a large corpus: 29 shingles an entry, nearly all of them of one text only."""
    monkeypatch.setattr(ngram_join, "LEVEL_BITS", 12)
    monkeypatch.setattr(ngram_join, "SKETCH_BITS", 12, raising=False)
    texts, passage = corpus()
    table = table_of(texts, 4)
    common = ngram_join._level_of(table, ngram_join.shingle_sets([passage.encode()])[0])
    rare = np.concatenate([ngram_join._level_of(table, s) for s in ngram_join.shingle_sets([t.encode() for t in texts[20:400]])])
    assert (common >= 5).all()
    assert (rare < 5).mean() > 0.98
    assert (rare == 0).mean() > 0.95
