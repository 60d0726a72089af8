"""Each operator on odd tables: nulls, empty and long texts, ties, repeated rows, no rows, clashing extra columns."""

import hashlib
import pickle
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import chat, exact_dedup, fingerprints, langid, licenses, mixing, ngram_join, packing, queries, revisits, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, doc string, key string, target double, place string, _found string, _gone string, __langid string, row string, words string"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))


def table(spark, rows):
    """rows: (doc_id, text, source). The extra columns' names clash with those that operators use inside."""
    return spark.createDataFrame([(i, t, "en" if i and i % 2 else None, s, len(t or ""), 1, "d", "k", 1.0, "p", "f", "g", "l", "r", "w") for i, t, s in rows], SCHEMA)


ODD = [
    (1, "The MIT License and\tmore words here", "a"), (2, None, "a"), (3, "", None), (4, " \t\n", "b"), (5, LONG, "a"), (6, "same text of five words and more", "b"), (7, "same  text of five words and more", "b"),
    (8, "same text of five words and more", "é"), (8, "same text of five words and more", "é"), (None, "no id here at all, really", "a"), (None, None, None), (9, "Ünïcödé 漢字 🙂 text", "z"), (10, "one", "b"), (11, "One", "b"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ODD).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_mixing(spark, odd, none):
    got = mixing.mix(odd).select("doc.doc_id", "doc.text", "size", "source_size", "target", "taken", "passes").collect()
    assert len(got) == len(ODD) and all(r["size"] == len(words(r["text"])) and 0 <= r["taken"] <= 2 * r["size"] for r in got)
    total = sum(r["size"] for r in got)
    per = defaultdict(list)
    for (_, _, s), r in zip(sorted(ODD, key=repr), sorted(got, key=lambda r: repr((r["doc_id"], r["text"])))):
        per[s].append(r)
    assert abs(sum(rs[0]["target"] for rs in per.values()) - 1.5 * total) < 1e-6
    for rs in per.values():
        assert abs(sum(r["taken"] for r in rs) - rs[0]["target"]) < 1 and rs[0]["source_size"] == sum(r["size"] for r in rs)
        assert all(0 <= p["position"] <= 1 and p["words"] > 0 for r in rs for p in r["passes"])
    rows = mixing.training_rows(mixing.mix(odd))
    assert rows.columns == odd.columns and sum(len(words(r["text"])) for r in rows.collect()) == sum(r["taken"] for r in got)
    assert mixing.mix(none).count() == 0 and mixing.training_rows(mixing.mix(none)).count() == 0


def test_demand_is_inverted(spark):
    for knots in mixing.SCHEDULES + (((0.0, 0.0), (0.25, 2.0), (1.0, 0.0)),):
        areas = mixing._areas(knots)
        shares = [i / 50 for i in range(51)]
        df = spark.createDataFrame([(s,) for s in shares], "s double")
        for s, t in zip(shares, (r[0] for r in df.select(mixing.inverse_demand(F.col("s"), knots)).collect())):
            seen = sum((min(b, max(a, t)) - a) * (x + (x + (y - x) * (min(b, max(a, t)) - a) / (b - a))) / 2 for (a, x), (b, y) in zip(knots, knots[1:]))
            assert abs(seen - s * areas[-1]) < 1e-6
    with pytest.raises(ValueError):
        mixing.check_schedule(((0.0, 1.0), (0.5, 1.0)))


def brute_base(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    at = [(i, label) for p, label in licenses.BASE_PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_licenses(spark, odd, none):
    got = licenses.scan(odd).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _, _ in ODD)
    rng = random.Random(1)
    bits = ["mit", "MIT", "license", "apache", "general", "public", " ", "-", "\n", "é", "licenseé", "_", "x", "spdx-license-identifier: MIT OR (GPL-2.0-only AND BSD-3-Clause)\n"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", "."]) for _ in range(rng.randint(0, 40))) for _ in range(300)] + [t for _, t, _ in ODD]
    for r, t in zip(licenses.scan(table(spark, [(k, t, "a") for k, t in enumerate(texts)])).orderBy("doc_id").collect(), texts):
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(t)
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert licenses.scan(none).count() == 0


def test_license_expressions():
    e = licenses.parse("MIT or GPL-2.0-only with Classpath-exception-2.0 AND (Apache-2.0)")
    assert e.alternatives == {frozenset({"mit"}), frozenset({"gpl-2.0-only with classpath-exception-2.0", "apache-2.0"})}
    assert e.permitted({"mit"}) and not e.permitted({"apache-2.0"}) and licenses.parse("MIT AND ISC").permitted({"mit", "isc"})
    for line, value in (("MIT */", "MIT"), (" MIT -->", "MIT"), ("MIT ##", "MIT"), ('MIT "" #', 'MIT ""'), ("MIT''", "MIT"), ("MIT *) ", "MIT"), ("", ""), ("#", "")):
        assert licenses.tag_value(line) == value
    began = time.perf_counter()
    assert licenses.Scanner({}).tags(b"SPDX-License-Identifier: MIT" + b" " * 1_000_000 + b"x\n")[:2] == (1, 1) and time.perf_counter() - began < 1
    for bad in ("", "MIT OR", "(MIT", "MIT)", "MIT ISC", "AND", "MIT / ISC", "(MIT OR ISC) WITH x"):
        with pytest.raises(ValueError):
            licenses.parse(bad)


def test_revisits(spark):
    head = "array<struct<name:string,value:string>>"
    schema = f"record_id long, url string, date long, kind string, etag string, last_modified string, digest string, headers {head}, block string, found string"
    h = [("etag", "a"), ("content-length", "5"), ("vary", "x")]
    rows = [
        (1, "http://WWW.e.com/a/?utm_x=1&b=2&a=1#z", 10, "response", "a", None, "d1", h, "", ""), (2, "https://e.com:443/a?a=1&b=2", 20, "revisit", 'W/a', None, None, [("content-length", "0"), ("vary", "y"), ("date", "t")], "", ""),
        (3, "//e.com/a?a=1&b=2", 10, "revisit", "a", None, None, None, "", ""), (4, "https://e.com/a?a=1&b=2", 20, "response", "b", None, "d2", None, "", ""), (5, "https://e.com/a?a=1&b=2", 21, "revisit", "a", None, None, None, "", ""),
        (6, None, 5, "response", "a", None, "d", None, "", ""), (7, None, 6, "revisit", "a", None, None, None, "", ""), (8, "https://e.com/a?b=2&a=1", 30, "revisit", None, None, "d2", None, "", ""), (9, "https://e.com/a?b=2&a=1", 30, "request", None, None, None, None, "", ""),
        (10, "https://e.com/n", None, "response", "a", None, "d", None, "", ""), (11, "https://e.com/n", None, "revisit", "a", None, None, None, "", ""), (12, "https://e.com/n", 40, "revisit", "a", None, None, None, "", ""),
        (13, None, None, "revisit", "a", None, None, None, "", ""), (14, "http://r.com/", 5, "response", "t", None, "r", None, "", ""), (14, "http://r.com/", 5, "response", "t", None, "r", None, "", ""),
        (15, "http://r.com", 6, "revisit", "t", None, None, None, "", ""), (15, "http://r.com", 6, "revisit", "t", None, None, None, "", ""),
    ]
    every = revisits.resolve(spark.createDataFrame(rows, schema)).collect()
    got = {r["record_id"]: r for r in every}
    assert len(every) == len(got) + 1  # the repeated one
    lost = ("orphan", None, None)
    assert {k: (r["status"], r["refers_to"], r["digest"]) for k, r in got.items()} == {2: ("resolved", 1, "d1"), 3: ("orphan", None, None), 5: ("mismatch", None, None), 7: ("orphan", None, None), 8: ("resolved", 4, "d2"), 11: lost, 12: lost, 13: lost, 15: ("resolved", 14, "r")}
    assert [tuple(x) for x in got[2]["headers"]] == [("content-length", "5"), ("date", "t"), ("etag", "a"), ("vary", "y")] and got[2]["url"] == "e.com/a?a=1&b=2"
    assert revisits.resolve(spark.createDataFrame([], schema)).count() == 0


def test_revisits_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(revisits, "BLOCK_RECORDS", 40)
    rng = random.Random(3)
    rows = [(i, f"http://e.com/{rng.choice('aaab')}", rng.randrange(120), rng.choice(["response", "revisit"]), "x", None, None, None) for i in range(400)]
    df = spark.createDataFrame(rows, "record_id long, url string, date long, kind string, etag string, last_modified string, digest string, headers array<struct<name:string,value:string>>")
    got = {r["record_id"]: r["refers_to"] for r in revisits.resolve(df).collect()}
    for i, u, d, k, *_ in rows:
        if k == "revisit":
            assert got[i] == max(((e, j) for j, v, e, q, *_ in rows if q == "response" and v == u and e < d), default=(0, None))[1]


def test_pack_is_whole_and_tight():
    rng = random.Random(5)
    for n in (0, 1, 2, 50, 3000):
        lengths = [rng.choice([0, 1, rng.randint(1, 400), rng.randint(1, 20_000), 4096, 8192]) for _ in range(n)]
        sequences = packing.pack(lengths)
        seen = defaultdict(list)
        for s in sequences:
            assert s and 0 < sum(p[2] for p in s) <= 4096
            for d, start, k in s:
                seen[d].append((start, k))
        for d, size in enumerate(lengths):
            at = 0
            for start, k in sorted(seen[d]):
                assert start == at and k > 0
                at += k
            assert at == size
        padding = sum(4096 - x for x in (sum(p[2] for p in s) for s in sequences) if x & (x - 1))
        assert padding <= 0.004 * max(1, sum(lengths)) + 1


def test_best_fit_is_the_tightest():
    rng = random.Random(6)
    tree, open_, n = packing.CapacityTree(64), [], 0
    for _ in range(2000):
        least = rng.randint(0, 64)
        want = min((c for c in open_ if c >= least), default=None)
        assert tree.tightest(least) == want
        if want is not None and rng.random() < 0.6:
            tree.take(want)
            open_.remove(want)
        else:
            c = rng.randint(1, 64)
            tree.put(c, n)
            open_.append(c)
            n += 1


def test_packing(spark, odd, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    got = packing.packed(odd, path, with_ids=True).collect()
    want = Counter((i, tuple(t.encode(x or "", add_special_tokens=False).ids) + (2,)) for i, x, _ in ODD)
    pieces = defaultdict(list)
    for r in got:
        assert zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
    for (i, ids), n in want.items():
        parts = [r for r in pieces[i, len(ids)]]
        assert sum(r["length"] for r in parts if tuple(r["ids"]) == ids[r["start"] : r["start"] + r["length"]]) >= n * len(ids)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 4096
    assert packing.packed(none, path).count() == 0


def test_chunks_tokenize_like_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, chunked, rng = Tokenizer.from_file(path), packing.ChunkTokenizer(path), random.Random(7)
    signs = list("abeinoSTé'.,-!1２ \t\n\x0b\x0c\x1c\x85\xa0İßΣσ́🙂한가") + ["'s", "<|endoftext|>", "tion", "the", "ing"]
    for _ in range(3000):
        s = "".join(rng.choice(signs) for _ in range(rng.randint(0, 20)))
        assert np.frombuffer(chunked.encode([s.encode()])[0], "<u4").tolist() == whole.encode(s, add_special_tokens=False).ids, s


def brute_components(rows):
    sets, links = {}, defaultdict(set)
    for i, t in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            o = len(sets[a] & sets[b])
            if a < b and o and 100 * o >= 75 * len(sets[a] | sets[b]):
                links[a].add(b), links[b].add(a)
    root = {}
    for i in ids:
        todo = [i]
        while todo:
            if (x := todo.pop()) not in root:
                root[x] = i
                todo += links[x]
    return {i: (len(sets[i]), root[i]) for i in ids}


def near_copies(seed, n):
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(60)]
    passage = [rng.choice(vocabulary) for _ in range(55)]
    for g in range(n):
        base = [rng.choice(vocabulary) + str(rng.randrange(9)) for _ in range(rng.choice([3, 6, 12, 40, 90]))] + passage * rng.choice([0, 0, 1])
        for _ in range(rng.choice([1, 1, 2, 5, 14])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = rng.choice(["new", "Old", "w1"])
            rows.append(" ".join(w[: len(w) - rng.choice([0, 0, 2])]))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_ngram_join(spark, odd, none, monkeypatch):
    rows = near_copies(11, 60)
    want = brute_components(rows)
    assert sum(r != i for i, (_, r) in want.items()) > 50
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r[0]: (r[1], r[2]) for r in ngram_join.ngram_components(df).collect()} == want
    # The same in many small tiles, as for one component that no task can hold.
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 3)
    assert {r[0]: (r[1], r[2]) for r in ngram_join.ngram_components(df).collect()} == want


def test_ngram_join_odd(spark, odd, none):
    got = sorted((r[0] if r[0] is not None else -1, r[1], r[2] if r[2] is not None else -1) for r in ngram_join.ngram_components(odd).collect())
    named = brute_components([(i, t) for i, t, _ in ODD if i is not None])
    assert [(i, n, c) for i, n, c in got if i >= 0] == sorted((i, *named[i]) for i, _, _ in ODD if i is not None)
    assert [x for x in got if x[0] < 0] == [(-1, 0, -1), (-1, 2, -1)]
    assert ngram_join.ngram_components(none).count() == 0
    kept = ngram_join.representatives(odd)
    assert kept.columns == odd.columns and 7 not in {r["doc_id"] for r in kept.collect()}


def test_prefixes_meet():
    rng = np.random.default_rng(2)
    for _ in range(300):
        x = rng.choice(10_000, rng.integers(1, 60), replace=False)
        y = np.union1d(rng.choice(x, rng.integers(1, len(x) + 1), replace=False), rng.choice(10_000, rng.integers(0, 8), replace=False))
        if ngram_join.linked(len(np.intersect1d(x, y)), len(x), len(y)):
            assert set(np.sort(x)[: ngram_join.prefix_length(len(x))]) & set(np.sort(y)[: ngram_join.prefix_length(len(y))])
            a, b = x.astype(np.uint64), y.astype(np.uint64)
            assert ngram_join.may_link(ngram_join.bitmap(a).tobytes(), ngram_join.bitmap(b).tobytes(), len(a), len(b))


def test_exact_dedup(spark, odd, none):
    def brute(rows):
        groups = defaultdict(list)
        for i, t, _ in rows:
            groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
        return Counter((i, min((x for x in g if x is not None), default=None), len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for i in g)

    got = exact_dedup.dedup(odd).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == brute(ODD)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in got}) == len({r["text_sha256"] for r in kept}) and all(r["doc_id"] == r["keep_id"] for r in kept)
    rest = exact_dedup.deduplicated(odd)
    assert rest.columns == odd.columns and sorted(str(r["doc_id"]) for r in rest.collect()) == sorted(str(r["doc_id"]) for r in kept)
    twice = table(spark, [(1, "x y", "a"), (1, "x y", "a"), (2, "x  y", "a"), (1, "z", "a")])
    assert sorted((r["doc_id"], r["text"]) for r in exact_dedup.deduplicated(twice).collect()) == [(1, "x y"), (1, "z")]
    assert exact_dedup.dedup(none).count() == 0 and exact_dedup.deduplicated(none).count() == 0


def test_directory():
    rng = random.Random(8)
    counts = {p: rng.randint(1, 5) for p in rng.sample(range(1 << 10), 600)} | {77: 500}
    d = exact_dedup.directory(counts, most=40, max_depth=10)
    assert len(d.slots) == 1 << d.depth and set(d.slots) == set(range(len(d.buckets)))
    held = Counter()
    for p, n in counts.items():
        b = d.slots[p >> (10 - d.depth)]
        depth, prefix = d.buckets[b]
        assert p >> (10 - depth) == prefix
        held[b] += n
    assert all(n <= 40 or d.buckets[b][0] == 10 for b, n in held.items())


def test_dedup_in_many_buckets(spark):
    rows = [(i, f"text {i % 70}", "a") for i in range(200)]
    docs = table(spark, rows)
    index = exact_dedup.build(docs, bucket_entries=10)
    assert len(index.directory.buckets) > 4 and index.entries.agg(F.sum("n")).first()[0] == 200
    assert index.entries.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 10
    found = exact_dedup.resolved(docs, index).collect()
    assert sorted((r["keep_id"], r["group_size"]) for r in found) == [(i, 3 if i < 60 else 2) for i in range(70)]
    # The directory decides who owns a text: with a wrong slot its owner lacks the entry and says so.
    slots = index.directory.slots
    slots[:] = slots[1:] + slots[:1]
    with pytest.raises(Exception, match="has no entry for a text"):
        exact_dedup.resolved(docs, index)


def test_hot_text_is_sent_once_by_a_task(monkeypatch):
    monkeypatch.setattr(exact_dedup, "COMBINE_BYTES", 20_000)
    rows = [(1, b"h", b"hot" * 40) if i % 2 else (i, b"s%d" % i, b"text %d" % i) for i in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["key", "sha", "text"])
    out = [r for b in exact_dedup._combined(exact_dedup.Directory(0, [0], [(0, 0)]))(iter([batch])) for r in b.to_pylist()]
    assert [r["n"] for r in out if r["key"] == 1] == [2000] and sum(r["n"] for r in out) == 4000


def test_dedup_with_many_contested_keys(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "small", lambda df: df)
    rows = [(i, f"text {i % 70}", "a") for i in range(200)]
    got = exact_dedup.dedup(table(spark, rows)).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got} == {(i, i % 70, 3 if i % 70 < 60 else 2, i < 70) for i in range(200)}


def brute_chat(rows):
    out = []
    for turns in rows.values():
        turns = sorted(turns, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1] or "", r[2] or ""))
        loss = "".join(t or "" for _, r, t in turns if r == "assistant")
        out.append((len(turns), hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return Counter(out)


def test_chat_round_trip(spark, tmp_path):
    rng = random.Random(9)
    bits = ["<|im_end|>", "<|im_start|>", "assistant", "\n", "\\", "\\n", "\\|", "<", "|", "<|", "<\\|", " ", "é🙂", "ok"]
    convs = {c: [(t, rng.choice(["user", "assistant", "system", None, "a\nb\\n", "<|x"]), rng.choice([None, "", "".join(rng.choice(bits) for _ in range(12))])) for t in range(rng.randint(1, 9))] for c in range(1, 40)}
    convs[None] = [(None, "user", "x"), (1, "assistant", "y"), (1, "assistant", "y")]
    rows = [(c, *t) for c, turns in convs.items() for t in turns]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("tree", F.lit("x")).write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.QUERIES["op7_chat"](spark, str(tmp_path)).collect()
    odd = "<|im_end|><|im_start|>assistant ok"
    assert Counter((r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got) == brute_chat(convs | {-1: [(0, "user", odd), (1, "assistant", odd)]})
    assert {r["conv_id"] for r in got} == {*convs, -1}


def test_reply_trees(spark):
    # 1 - 2 - 3, 2 - 4 - 5, an orphan 6, and 7 <-> 8
    rows = [(1, None, 0.0), (2, 1, 1.0), (3, 2, 5.0), (4, 2, 1.0), (5, 4, None), (6, 99, 2.0), (7, 8, 1.0), (8, 7, 1.0)]
    df = spark.createDataFrame([("t", *r, "user" if r[0] % 2 else "assistant", f"m{r[0]}") for r in rows], "tree string, node long, parent long, score double, role string, text string")
    paths = defaultdict(list)
    for r in chat.reply_paths(df).orderBy("depth").collect():
        paths[r["rank"], r["leaf"]].append(r["node"])
    # 6 and 1 - 2 - 3 have the same mean score: the shallower path is first.
    assert dict(paths) == {(1, 6): [6], (2, 3): [1, 2, 3], (3, 5): [1, 2, 4, 5]}
    best = chat.formatted(df, best=2).where("leaf = 3").collect()
    assert chat.formatted(df, best=1).first()["leaf"] == 6 and len(best) == 1 and best[0]["formatted"].count("<|im_start|>") == 3 and len(best[0]["loss_spans"]) == 1
    s = best[0]["loss_spans"][0]
    assert best[0]["formatted"][s["start"] : s["start"] + s["length"]] == "m2"
    assert chat.formatted(df.limit(0)).count() == 0


def test_token_counts(spark, odd, none):
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    exact = Tokenizer(models.Unigram(token_counts.vocabulary(path), 0, True))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always")

    def brute(t):
        w = [x.decode() for x in token_counts.words((t or "").encode())]
        return len(exact.encode(" ".join(w), add_special_tokens=False).ids) if w else 0

    got = token_counts.token_counts(odd, path).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_tokens"]) for r in got) == Counter((i, len(words(t)), brute(t)) for i, t, _ in ODD)
    rng, c = random.Random(10), token_counts.counter(path)
    for _ in range(4000):
        s = "".join(rng.choice("abcdetinoSé🙂한가<0x4>.▁é́") for _ in range(rng.randint(0, 14))) + rng.choice(["", "", "<0x41>", "</s>", "<unk>"])
        assert sum(c[w] for w in token_counts.words(s.encode())) == brute(s), s
    assert token_counts.token_counts(none, path).count() == 0


def test_caches_hold_bounded_bytes(monkeypatch):
    rng = random.Random(15)
    spaceless = ["".join(rng.choice("漢字文章列語") for _ in range(400)) for _ in range(50)]
    c = token_counts.counter(public_tokenizers.path("piece_bpe_32k.model"))
    c.clear()
    tokenizer = packing.ChunkTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    first = [c[t.encode()] for t in spaceless], tokenizer.encode([t.encode() for t in spaceless])
    ngram_join.shingle_sets([t.encode() for t in spaceless])
    assert not c and not tokenizer.cache and not any(len(w) > ngram_join.CACHED_WORD for w in ngram_join._hashes)
    assert first == ([c[t.encode()] for t in spaceless], tokenizer.encode([t.encode() for t in spaceless]))
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 10)
    assert [c[str(k).encode()] for k in range(100)] and len(c) <= 10
    monkeypatch.setattr(packing, "CACHE_CHUNKS", 10)
    few = [b" ".join(b"%d" % k for k in range(i, i + 7)) for i in range(100)]
    want = [tokenizer.encode([t])[0] for t in few]
    assert len(tokenizer.cache) <= 20 and want == packing.ChunkTokenizer(public_tokenizers.path("word_bpe_49k.json")).encode(few)


def test_ties_keep_the_longest_last_piece():
    c = token_counts.Counter([("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0)])
    assert c.pieces("▁ab") == 2 and c.pieces("▁aé") == 3  # ▁|ab before ▁a|b; é counts two bytes


def test_fingerprints(spark, none, monkeypatch):
    rng = random.Random(12)
    rows = [(3 * i, "".join(rng.choice("abcdefgh é🙂") for _ in range(rng.choice([0, 1, 2, 5, 40, 300, 5000]))), "a") for i in range(60)] + [(1000, None, "a"), (1001, LONG, "b"), (1002, LONG, None)]
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", 7)
    got = {r["doc_id"]: r for r in fingerprints.neighbour_fingerprints(table(spark, rows).repartition(4)).collect()}
    assert len(got) == len(rows)
    texts = [t or "" for _, t, _ in rows]
    for k, (i, _, _) in enumerate(rows):
        after = texts[(k + 1) % len(rows)]
        edited = fingerprints.edited_text(texts[k], after)
        r = got[i]
        assert r["n_chars"] == len(texts[k]) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert [r["fingerprint"], r["edited_fingerprint"]] == fingerprints.fingerprints([texts[k], edited])
        assert r["near_edited"] == fingerprints.likeness(r["fingerprint"], r["edited_fingerprint"]) and r["near_next"] == fingerprints.likeness(r["fingerprint"], got[rows[(k + 1) % len(rows)][0]]["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert got[1001]["near_next"] == 1.0 and got[1001]["fingerprint"] == got[1002]["fingerprint"]
    assert fingerprints.neighbour_fingerprints(none).count() == 0
    one = fingerprints.neighbour_fingerprints(table(spark, [(5, "abcd", "a")])).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    again = fingerprints.neighbour_fingerprints(table(spark, [(None, "first", "a"), (1, "b", "a"), (1, "b", "a"), (2, "c", "a")])).collect()
    assert Counter(r["doc_id"] for r in again) == Counter([None, 1, 1, 2])


def test_likeness_follows_edits(spark):
    rng = random.Random(13)
    text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(3000))
    few, many = list(text), list(text)
    for _ in range(3):
        few[rng.randrange(3000)] = "!"
    for _ in range(900):
        many[rng.randrange(3000)] = "!"
    other = "".join(rng.choice("abcdefghijklmnop ") for _ in range(3000))
    # Walks fall into step again after an insertion most of the time, not always.
    longer = [text[:at] + "xyz" + text[at:] for at in range(100, 2900, 100)]
    a, b, c, d, *e = fingerprints.fingerprints([text, "".join(few), "".join(many), other, *longer])
    assert fingerprints.likeness(a, b) > 0.95 > fingerprints.likeness(a, c) > fingerprints.likeness(a, d) and fingerprints.likeness(a, d) < 0.2
    assert np.median([fingerprints.likeness(a, x) for x in e]) > 0.8
    rows = [(1, text), (2, "".join(few)), (3, other), (4, other), (5, None), (None, text)]
    got = {(r["doc_id"], r["class_id"]) for r in fingerprints.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (None, 1)}


LETTERS = {"aa": "abcde", "bb": "fghij", "cc": "äöüxy"}


def sample_texts(seed, n):
    rng, out = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(list(LETTERS))
        out.append((i, " ".join("".join(rng.choice(LETTERS[lang] + "st") for _ in range(rng.randint(2, 8))) for _ in range(rng.choice([3, 20, 100]))), lang))
    return out


def test_langid(spark, none):
    rows = sample_texts(14, 300) + [(900, None, "aa"), (901, "123 !!", "bb"), (902, "", None), (None, "abc abd", None), (903, LONG, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit("old") for c in ("lang_pred", "score", "__langid", "row", "found", "_id")})
    model = langid.learned(docs)
    found = langid.identify(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "__langid", "row", "found", "_id", "lang_pred", "score"]
    got = found.withColumn("held", langid.held_out()).collect()
    assert len(got) == len(rows) and all(r["lang_pred"] in (*LETTERS, "und") and 0 <= r["score"] <= 1 for r in got)
    for r in got:
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert r["lang_pred"] == "und"
        if r["doc_id"] is not None:
            assert r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in got if r["held"] and r["doc_id"] < 300]
    assert held and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and {900, 901, 902}.isdisjoint(r["doc_id"] for r in kept.collect()) and kept.count() >= 300
    # Repeated ids with other texts, and more languages than the sample has room for, are learned alike in any order.
    again = docs.unionByName(docs.withColumn("text", F.concat("text", F.lit(" more")))).repartition(5)
    assert pickle.dumps(langid.learned(again).weights) == pickle.dumps(langid.learned(again.repartition(2)).weights)
    blank = langid.learned(none)
    assert blank.labels == [] and langid.identify(none, blank).count() == 0 and blank.predict("abc") == ("und", 0.0)
    # Held-out rows change nothing.
    changed = docs.withColumn("lang", F.when(langid.held_out(), "zz").otherwise(F.col("lang")))
    assert langid.learned(changed).predict("abcde abc")[0] == model.predict("abcde abc")[0] == "aa" and "zz" not in langid.learned(changed).labels
