"""Phrase collocations against a plain count, at widths that let almost everything through, and on odd tables."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgermill.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, words string, a long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "p", 1, "w", 2) for i, (t, lang) in enumerate(rows)], SCHEMA)


def plain_counts(rows, longest=5):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\t]+", piece)
            n[lang] += len(ws)
            for m in range(1, longest + 1):
                f.update((lang, tuple(ws[i : i + m])) for i in range(len(ws) - m + 1))
    return f, n


def plain(rows, threshold, first, percent=100):
    f, n = plain_counts(rows)
    candidates = {k: a for k, a in f.items() if a >= threshold and len(k[1]) > 1}
    out = []
    for lang in n:
        mine = {p: a for (where, p), a in candidates.items() if where == lang}
        found = []
        for p, a in mine.items():
            inside = any(len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * b >= percent * a for q, b in mine.items())
            if not inside:
                score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -score) for rank, (score, a, p, left, right) in enumerate(sorted(found)[:first], 1)]
    return sorted(out)


def made_up(seed, n, vocabulary):
    r = random.Random(seed)
    names = ["The", "of", "x", "ß", "Ünï", "漢字", "a b", "-", "$"] + [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(len(names))]
    rows = []
    for _ in range(n):
        ws = r.choices(names, weights, k=r.randrange(0, 60))
        at = r.randrange(0, len(ws) + 1)
        ws[at:at] = r.choice([[], ["new", "york", "city", "hall"], ["New", "York"], ["go", "go", "go", "go", "go", "go"]])
        text = "".join(w + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", ";\x0b"]) for w in ws)
        rows.append((r.choice([text, text, text, None, ""]) if r.random() < 0.2 else text, r.choice(["en", "en", "en", "de", None, "und", ""])))
    return rows


@pytest.mark.parametrize(("threshold", "first", "bits"), [(5, 2000, None), (3, 7, 16), (40, 2000, None)])
def test_against_a_plain_count(spark, threshold, first, bits):
    rows = made_up(threshold, 400, 30)
    got = collocations.collocations(table(spark, rows).repartition(3), threshold=threshold, first=first, bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, threshold, first)


def test_sketch_too_narrow_loses_nothing(spark, monkeypatch):
    """With counters far fewer than phrases nearly all survive the sketch; the exact count decides."""
    monkeypatch.setattr(collocations, "LEAST_BITS", 16)
    rows = [(" ".join(f"a{i} b{i} c{i % 7}" for i in range(k, 20_000 + k)), "en") for k in range(6)]
    f, _ = plain_counts(rows)
    got = {(r["lang"], tuple(r["phrase"].split(" "))): r["n"] for r in collocations.frequent(table(spark, rows), threshold=6, bits=16).where("length > 0").collect()}
    assert got == {k: v for k, v in f.items() if v >= 6}


def test_sketch_counters_are_never_below_the_count():
    rows = made_up(1, 200, 20)
    f, _ = plain_counts(rows, 2)
    batch = pa.RecordBatch.from_arrays([pa.array([None if t is None else t.encode() for t, _ in rows], pa.binary()), pa.array(["und" if x is None else x for _, x in rows], pa.string())], names=["text", "lang"])
    parts = [b for i in range(0, len(rows), 50) for b in collocations._sketched((1, 2), 19, None, 1000)(iter([batch.slice(i, 50)]))]
    total = Counter()
    for b in parts:
        for cell, places, counts in zip(*(c.to_pylist() for c in b.columns)):
            at, n = collocations._unpacked(counts, places)
            for a, m in zip(at.tolist(), n.tolist()):
                total[cell, a] += m
    seen = 0
    for phrases, until, vocabulary, langs in collocations.runs(iter([batch]), 2):
        for n, starts, h in phrases.lengths(2, None, until):
            for row in range(collocations.ROWS):
                at = collocations.slots(h, row, 19)
                for s, slot in zip(starts.tolist(), at.tolist()):
                    phrase = tuple(vocabulary[int(phrases.ids[s + k])].as_py().decode() for k in range(n))
                    cell = ((n * collocations.ROWS + row) << 32) + (slot >> collocations.SLICE_BITS)
                    assert total[cell, slot & 0xFFFF] >= f[langs[int(phrases.lang[s])].as_py(), phrase]
                    seen += 1
    assert seen > 1000


def test_blocks_of_one_long_text_join_up(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 64)
    rows = [(" ".join(["x y z u v w q"] * 500), "en"), ("y z. " * 300, "en"), (" ", None)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t, _ in rows], pa.binary()), pa.array(["en", "en", "und"], pa.string())], names=["text", "lang"])

    class Shared:
        value = staticmethod(lambda n, h: None)

    for held in (1 << 20, 3):  # handed on at the end, or after each block
        monkeypatch.setattr(collocations, "HELD", held)
        parts = list(collocations._counted(5, Shared)(iter([batch])))
        rows_of = sorted((r for b in parts for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: r[0])
        again = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows_of), parts[0].schema)], schema=parts[0].schema)
        got = {}
        for b in collocations._summed(1)(iter([again])):
            for lang, length, phrase, n in zip(*(c.to_pylist() for c in b.columns)):
                key = lang.decode(), tuple(phrase.decode().split(" ")) if length else ()
                assert length == len(key[1]) and key not in got
                got[key] = n
        f, n = plain_counts(rows)
        assert {k: v for k, v in got.items() if k[1]} == dict(f) and got["en", ()] == n["en"] and got.get(("und", ()), 0) == 0


def test_subsumed_by_dropped_ones_and_ties(spark):
    rows = [("big red dog runs home", "en")] * 12 + [("red dog", "en")] * 3 + [("tie a", "fr"), ("tie b", "fr")] * 10
    assert sorted(map(tuple, collocations.collocations(table(spark, rows), threshold=10).collect())) == plain(rows, 10, 2000)
    phrases = {r["phrase"] for r in collocations.collocations(table(spark, rows), threshold=10).collect()}
    assert phrases == {"big red dog runs home", "red dog", "tie a", "tie b"}
    assert "red dog" not in {r["phrase"] for r in collocations.collocations(table(spark, rows), threshold=10, percent=80).collect()}


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000
    rows = [("en", 0, "", 7 * big), ("en", 1, "a", 2 * big), ("en", 1, "b", big + 1), ("en", 2, "a b", big)]
    got = collocations.scored(spark.createDataFrame(rows, "lang string, length int, phrase string, n long")).first()
    assert got["score"] == 1000 * big * 7 * big // (2 * big * (big + 1)) and (got["l"], got["r"]) == (2 * big, big + 1)


def test_no_rows_and_bad_parameters(spark):
    for rows in ([], [(None, None), ("", "en"), (" \t.", "en")]):
        assert collocations.collocations(table(spark, rows)).collect() == []
    for wrong in ({"longest": 6}, {"longest": 0}, {"threshold": 0}, {"threshold": 1 << 16}):
        with pytest.raises(ValueError):
            collocations.frequent(table(spark, []), **wrong)


def test_words_as_the_pattern_says():
    texts = ["A b.C\tD", "", "é!É x\x00y", "  ", "end", ","]
    coded, piece, text = collocations.words(pa.array([t.encode() for t in texts], pa.binary()))
    assert [w.decode() for w in coded.to_pylist()] == ["a", "b", "c", "d", "é", "É", "x\x00y", "end"]
    assert text.tolist() == [0, 0, 0, 0, 2, 2, 2, 4] and (np.diff(piece) > 0).tolist() == [False, True, False, True, True, False, True]
