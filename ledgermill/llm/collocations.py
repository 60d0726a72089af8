"""Phrase collocations: merged count-min sketches find what can be frequent, exact counts of that, scores, subsumption.

A phrase is a run of words within a piece of a text. First every task sketches the phrases of its texts, by language, and
the sketches of all tasks are added up, a slice of counters at a time. A counter is never below the count of a phrase that
falls on it, so a phrase whose counters all reach the threshold may be frequent and any other isn't. Then every task counts
just those phrases, exactly, and the counts are added up by phrase. Phrases of three words and more are sketched after those
of one and two, and only where all their word pairs may be frequent: most texts' phrases are gone by then.

What the sketch lets through too much costs time and is gone after the exact count: results don't depend on its width."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import modest_batches, released, saved, small

LONGEST, THRESHOLD, FIRST, SUBSUMED = 5, 100, 2000, 100
UNKNOWN = "und"
#: Lengths that are sketched together; a later round's phrases must have survived the earlier ones in all their parts.
ROUNDS = ((1, 2), (3, 4, 5))
#: Counters of a row of a sketch: about a 16th of the words, between these bounds, and an 8th of that in later rounds. Tasks get
#: a bit of each: 2 rows x 2^27 bits for a length at most, and less than 80 MB for all.
ROWS, LEAST_BITS, MOST_BITS, SLICE_BITS, FEWER_BITS = 2, 19, 27, 16, 3
#: Words, and bytes of text, that a task holds at a time; a longer text is taken in runs of so many words.
BLOCK, BLOCK_BYTES = 1 << 21, 8 << 20
#: Counted phrases that a task holds before it hands them on, and slices that they are added up in.
HELD, SLICES = 1 << 20, 256
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[32, 9]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\v\f\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ROW_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """The words of a block of texts (binary) as one dictionary-encoded array, the piece and the text that each stands in."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, dtype=np.uint8)
    offsets = offsets - offsets[0]
    kind = _KIND[raw]
    inside = kind == 0
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][full], offsets[1:][full] - 1  # of texts that aren't empty
    opens[first], closes[last] = inside[first], inside[last]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    at = np.concatenate(([0], np.cumsum(ends - starts)))
    text = np.searchsorted(offsets, starts, side="right") - 1
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts) + text  # both grow from left to right, so a change of either shows
    kept = _LOWER[raw[inside]]
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(kept)])
    return found.dictionary_encode(), piece, text


class Phrases:
    """The phrases of a run of words: of each length, where they begin, a local number and a hash."""

    def __init__(self, ids: np.ndarray, hashes: np.ndarray, piece: np.ndarray, lang: np.ndarray, lang_hash: np.ndarray):
        self.ids, self.piece, self.lang, self.word_hash = ids, piece, lang, hashes
        self.hash = _mixed(hashes[ids] ^ lang_hash[lang])

    def lengths(self, longest: int, alive=None, until: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, starts, hashes) for phrases that start before word `until`; alive(length, hashes) says which are gone on
        with: a phrase is looked at if its parts without the first and without the last word were kept."""
        end = len(self.ids) if until is None else until
        starts, h = np.arange(len(self.ids)), self.hash
        for n in range(1, longest + 1):
            if n > 1:
                live = np.zeros(len(self.ids) + 1, dtype=bool)
                live[starts] = True
                ok = live[starts + 1] & (starts + n - 1 < len(self.ids))
                starts, h = starts[ok], h[ok]
                same = self.piece[starts] == self.piece[starts + n - 1]
                starts, h = starts[same], h[same]
                h = _mixed(h * np.uint64(0xA0761D6478BD642F) + self.word_hash[self.ids[starts + n - 1]])
            if alive is not None:
                keep = alive(n, h)
                if keep is not None:
                    starts, h = starts[keep], h[keep]
            first = int(np.searchsorted(starts, end))
            yield n, starts[:first], h[:first]


def runs(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[Phrases, int, pa.Array, pa.Array]]:
    """The phrases of a task's rows (text binary, lang string) by blocks: a run of words, how many of them phrases may begin
    with (the others only end them), the distinct words and languages."""
    gathered, size = [], 0

    def block(rows: list[pa.RecordBatch]) -> Iterator[tuple[Phrases, int, pa.Array, pa.Array]]:
        texts = pc.fill_null(pa.chunked_array([b.column(0) for b in rows]).combine_chunks(), b"")
        langs = pa.chunked_array([b.column(1) for b in rows]).combine_chunks().dictionary_encode()
        coded, piece, text = words(texts)
        ids, lang = np.asarray(coded.indices), np.asarray(langs.indices)[text]
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
        lang_hash = np.fromiter((xxhash.xxh3_64_intdigest(x.encode()) for x in langs.dictionary.to_pylist()), dtype=np.uint64, count=len(langs.dictionary))
        for i in range(0, len(ids), BLOCK):
            end = min(len(ids), i + BLOCK + longest - 1)
            yield Phrases(ids[i:end], hashes, piece[i:end], lang[i:end], lang_hash), min(BLOCK, len(ids) - i), coded.dictionary, langs.dictionary

    for b in batches:
        gathered.append(b)
        size += b.column(0).nbytes
        if size >= BLOCK_BYTES:
            yield from block(gathered)
            gathered, size = [], 0
    if gathered:
        yield from block(gathered)


def slots(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return _mixed(h * _ROW_FACTORS[row]) >> np.uint64(64 - bits)


class Survivors:
    """Which counters of each length and row reached the threshold: a bit each."""

    def __init__(self, maps: dict[tuple[int, int], np.ndarray]):
        self.maps = maps

    def __call__(self, n: int, h: np.ndarray) -> np.ndarray | None:
        out = None
        for row in range(ROWS):
            if (n, row) not in self.maps:
                return None
            at = slots(h, row, len(self.maps[n, row]).bit_length() + 2)
            hit = (self.maps[n, row][(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            out = hit if out is None else out & hit
        return out


def _packed(at: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted places within a slice and their counts, as gaps and columns, compressed."""
    gaps = np.diff(at, prepend=0).astype(np.uint16)
    return pa.compress(gaps.tobytes() + n.astype(np.uint16).tobytes(), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(pa.decompress(blob, decompressed_size=4 * n, codec="zstd", asbytes=True), dtype=np.uint16)
    return np.cumsum(both[:n], dtype=np.int64), both[n:].astype(np.int64)


def _sketched(lengths: tuple[int, ...], bits: int, before, threshold: int):
    """A task's rows -> its sketch: the counters that aren't 0, slice by slice."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alive = before.value if before is not None else None
        for phrases, until, _, _ in runs(batches, lengths[-1]):
            for n, _, h in phrases.lengths(lengths[-1], alive, until):
                if n not in lengths or not len(h):
                    continue
                for row in range(ROWS):
                    at, many = np.unique(slots(h, row, bits), return_counts=True)
                    part = (at >> np.uint64(SLICE_BITS)).astype(np.int64)
                    inside = (at & np.uint64((1 << SLICE_BITS) - 1)).astype(np.int64)
                    many = np.minimum(many, threshold, out=many)  # no counter need go on past it
                    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
                    ends = np.append(cuts[1:], len(part))
                    cells = ((n * ROWS + row) << 32) + part[cuts]
                    blobs = [_packed(inside[a:b], many[a:b]) for a, b in zip(cuts, ends, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(ends - cuts, pa.int32()), pa.array(blobs, pa.binary())], names=["cell", "places", "counts"])
        released()

    return sketch


def _merged(threshold: int):
    """Sketches sorted by slice -> a bit for each counter that reaches the threshold."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, None

        def done() -> pa.RecordBatch:
            bits = np.packbits(total >= threshold, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([bits], pa.binary())], names=["cell", "bits"])

        for b in batches:
            for cell, places, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if cell != current:
                    if current is not None:
                        yield done()
                    current, total = cell, np.zeros(1 << SLICE_BITS, dtype=np.int64)
                at, n = _unpacked(counts, places)
                total[at] += n
        if current is not None:
            yield done()

    return merge


def survivors(rows: DataFrame, bits: int, threshold: int, longest: int):
    """The broadcast Survivors of all rounds. What comes to the driver is a bit a counter, see above."""
    spark, found, shared = rows.sparkSession, {}, None
    for k, lengths in enumerate(tuple(n for n in r if n <= longest) for r in ROUNDS):
        if not lengths:
            continue
        wide = max(SLICE_BITS, bits - FEWER_BITS * min(k, 1))
        sketches = rows.mapInArrow(_sketched(lengths, wide, shared, threshold), "cell long, places int, counts binary")
        merged = saved(sketches.repartition("cell").sortWithinPartitions("cell").mapInArrow(_merged(threshold), "cell long, bits binary"), "collocation-sketch")
        found |= {(n, row): np.zeros(1 << (wide - 3), dtype=np.uint8) for n in lengths for row in range(ROWS)}
        width = 1 << (SLICE_BITS - 3)
        for r in merged.toLocalIterator():
            part = r["cell"] & 0xFFFFFFFF
            found[divmod(r["cell"] >> 32, ROWS)][part * width : (part + 1) * width] = np.frombuffer(r["bits"], dtype=np.uint8)
        if shared is not None:
            shared.unpersist()
        shared = spark.sparkContext.broadcast(Survivors(dict(found)))
    return shared


def _numbered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of numbers as their own numbers: the first place and the count of each, and each pair's number."""
    _, first, own, n = np.unique(a.astype(np.int64) << 32 | b.astype(np.int64), return_index=True, return_inverse=True, return_counts=True)
    return first, own, n


def _sliced(total: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Counts as a row per slice of their phrases' hashes, sorted and compressed."""
    slices: dict[int, list[bytes]] = {}
    for key in total:
        slices.setdefault(xxhash.xxh3_64_intdigest(key) % SLICES, []).append(key)
    blobs = []
    for keys in slices.values():
        keys.sort()
        lengths = np.array([len(k) for k in keys], dtype=np.int32).tobytes()
        blobs.append(np.array([total[k] for k in keys], dtype=np.int64).tobytes() + lengths + b"".join(keys))
    packed = [pa.compress(b, codec="zstd", asbytes=True) for b in blobs]
    yield pa.RecordBatch.from_arrays([pa.array(list(slices), pa.int32()), pa.array([len(k) for k in slices.values()], pa.int32()), pa.array([len(b) for b in blobs], pa.int32()), pa.array(packed, pa.binary())], names=["slice", "phrases", "size", "counts"])


def _counted(longest: int, shared):
    """A task's rows -> its exact counts of surviving phrases, and of all words, by slices. A key is language, 0xFF (which no text
    has), phrase."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        for phrases, until, vocabulary, langs in runs(batches, longest):
            names = langs.cast(pa.binary())
            for lang, n in zip(names.to_pylist(), np.bincount(phrases.lang[:until], minlength=len(langs)).tolist(), strict=True):
                total[lang + b"\xff"] = total.get(lang + b"\xff", 0) + n
            number = np.zeros(len(phrases.ids) + 1, dtype=np.int64)  # of the phrase of the last length that starts at a word
            for n, starts, _ in phrases.lengths(longest, shared.value):  # past `until` too: what begins there is counted later
                if n == 1:
                    first, own, _ = _numbered(phrases.lang[starts], phrases.ids[starts])
                else:
                    first, own, _ = _numbered(number[starts], phrases.ids[starts + n - 1])
                number[starts] = own
                many = np.bincount(own[: int(np.searchsorted(starts, until))], minlength=len(first))
                at = starts[first[many > 0]]
                if len(at):
                    texts = [vocabulary.take(pa.array(phrases.ids[at + k])) for k in range(n)]
                    joined = pc.binary_join_element_wise(*texts, pa.scalar(b" ", pa.binary())) if n > 1 else texts[0]
                    keys = pc.binary_join_element_wise(names.take(pa.array(phrases.lang[at])), joined, pa.scalar(b"\xff", pa.binary()))
                    for key, m in zip(keys.to_pylist(), many[many > 0].tolist(), strict=True):
                        total[key] = total.get(key, 0) + m
            if len(total) > HELD:
                yield from _sliced(total)
                total.clear()
        if total:
            yield from _sliced(total)
        total.clear()
        released()

    return count


def _summed(threshold: int):
    """Counts sorted by slice -> (lang, length, phrase, n) of the phrases that reach the threshold, and the languages' words."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, {}

        def done() -> pa.RecordBatch:
            kept = [(*k.split(b"\xff", 1), n) for k, n in total.items() if n >= threshold or k.find(b"\xff") == len(k) - 1]
            lengths = [p.count(b" ") + 1 if p else 0 for _, p, _ in kept]
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in kept], pa.binary()), pa.array(lengths, pa.int32()), pa.array([k[1] for k in kept], pa.binary()), pa.array([k[2] for k in kept], pa.int64())], names=["lang", "length", "phrase", "n"])

        for b in batches:
            for part, phrases, size, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part != current:
                    if total:
                        yield done()
                    current, total = part, {}
                raw = pa.decompress(counts, decompressed_size=size, codec="zstd", asbytes=True)
                at = 12 * phrases
                for n, length in zip(np.frombuffer(raw, dtype=np.int64, count=phrases).tolist(), np.frombuffer(raw, dtype=np.int32, count=phrases, offset=8 * phrases).tolist(), strict=True):
                    key = raw[at : at + length]
                    total[key] = total.get(key, 0) + n
                    at += length
        if total:
            yield done()
        total.clear()
        released()

    return add


def frequent(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", threshold: int = THRESHOLD, longest: int = LONGEST, bits: int | None = None) -> DataFrame:
    """(lang, length, phrase, n): every phrase of up to `longest` words with a count of threshold or more in its language,
    exactly counted, and a row of length 0 with the language's number of words.

    Null and empty texts have no words; a null language is `und`. Rows count as often as they stand. Only these two columns
    are read. bits: the binary logarithm of a sketch row's width, else about a 16th of the words."""
    if not 1 <= longest <= LONGEST:
        raise ValueError(f"phrases have 1 to {LONGEST} words")
    if not 1 <= threshold < 1 << 16:
        raise ValueError("a threshold is positive and below 65,536")
    rows = modest_batches(docs).select(F.col(text_col).cast("binary").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    if bits is None:
        size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
        bits = min(MOST_BITS, max(LEAST_BITS, (size // 96).bit_length()))
    shared = survivors(rows, bits, threshold, longest)
    counts = rows.mapInArrow(_counted(longest, shared), "slice int, phrases int, size int, counts binary")
    whole = counts.repartition("slice").sortWithinPartitions("slice").mapInArrow(_summed(threshold), "lang binary, length int, phrase binary, n long")
    return saved(whole.select(F.col("lang").cast("string").alias("lang"), "length", F.col("phrase").cast("string").alias("phrase"), "n"), "collocation-counts")


def _part(first: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice("words", first, n), " ")


def scored(counts: DataFrame) -> DataFrame:
    """Phrases of two words and more of frequent()'s rows with l, r and score of their worst cut: floor(1000 * a * n / (l * r))
    in whole numbers. A cut's parts are at least as frequent as the phrase, so their counts are there."""
    totals = counts.where("length = 0").select("lang", F.col("n").alias("total"))  # a row a language
    whole = counts.where("length > 0").select("lang", "phrase", "n")
    cuts = counts.where("length > 1").withColumn("words", F.split("phrase", " ")).select("lang", "length", "phrase", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = cuts.select("lang", "length", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("first"), _part(F.col("k") + 1, F.col("length") - F.col("k")).alias("rest"))
    left = whole.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = whole.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(small(totals), "lang")
    wide = lambda c: f"cast({c} as decimal(38, 0))"  # noqa: E731  (1000 * a * n has under 38 digits up to 10^17 words)
    both = both.withColumn("score", F.expr(f"(1000BD * {wide('a')} * {wide('total')}) div ({wide('l')} * {wide('r')})"))
    worst = both.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("w"), F.first("a").alias("a"), F.first("total").alias("n"), F.first("length").alias("length"))
    return worst.select("lang", "phrase", "length", "a", F.col("w.l").alias("l"), F.col("w.r").alias("r"), "n", F.col("w.score").alias("score"))


def without_subsumed(phrases: DataFrame, percent: int = SUBSUMED) -> DataFrame:
    """Phrases that don't stand in a longer one with at least `percent` of their count; all rows of phrases count as longer ones."""
    inner = F.expr("flatten(transform(sequence(2, length - 1), m -> transform(sequence(1, length - m + 1), i -> array_join(slice(words, i, m), ' '))))")
    longer = phrases.where("length > 2").withColumn("words", F.split("phrase", " ")).select("lang", F.explode(inner).alias("phrase"), "a")
    most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    joined = phrases.join(most, ["lang", "phrase"], "left")
    return joined.where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).drop("longer")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", threshold: int = THRESHOLD, first: int = FIRST, percent: int = SUBSUMED, longest: int = LONGEST, bits: int | None = None) -> DataFrame:
    """Each language's first phrases by score: lang, rank, phrase, a, l, r, n, score. Ties: the more frequent, then the
    smaller by bytes. No rows, or none frequent: no phrases."""
    phrases = saved(scored(frequent(docs, text_col, lang_col, threshold, longest, bits)), "collocation-scores")
    kept = without_subsumed(phrases, percent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may have millions: each of 64 parts gives its first ones, and only those meet
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    near = kept.withColumn("_part", part).withColumn("_n", F.row_number().over(W.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_n") <= first)
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
