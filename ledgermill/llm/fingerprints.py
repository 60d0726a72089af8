"""Document fingerprints by a randomised edit embedding.

A pointer walks over a text's characters: at each step it stays or moves on by one, as a random bit shared by all texts
says for that step and character. Two texts' walks fall into step again soon after an edit, so the outputs at equal
steps differ in few places where the edit distance is small. A text is walked in segments of SEGMENT code points, all
segments of a batch at a time. The fingerprint samples the outputs (SAMPLES of each octave of steps, so that short and
long texts are sampled alike), a hex digit each: 4 bits of a shared hash of the step and of the three characters there.
Bands of sampled positions find candidates; the weighted share of equal samples verifies them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import modest_batches, rows_of, saved, small
from .components import components

SEGMENT = 4096
SAMPLES = 32
#: Documents of a block of neighbours by id, about, and the most blocks: what bounds the driver's list of block borders.
BLOCK_ROWS, MAX_BLOCKS = 4_000, 20_000
#: Code points that a task embeds at a time.
BATCH_CHARS = 3_000_000
#: Bands of sampled positions for each level of length, and positions of a band.
BANDS, BAND_WIDTH = 16, 6
#: Samples between two levels of length.
LEVEL = 8
LEAST_LIKENESS = 0.75
#: Members of a band value that are compared in one block, about.
GROUP = 512


@lru_cache(maxsize=1)
def _walk() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Moves by (step, character class); the sampled steps; each sample's weight; the samples' salts."""
    rng = np.random.default_rng(20_240_501)
    steps = 3 * SEGMENT
    moves = rng.integers(0, 2, size=(steps, 256), dtype=np.uint8).astype(np.int64)
    moves[:, 0] = 0  # class 0 is the end
    at, weights, low = list(range(SAMPLES)), [1.0] * SAMPLES, SAMPLES
    while low < steps:
        high = min(2 * low, steps)
        new = np.unique(low + (np.arange(SAMPLES) + rng.random(SAMPLES)) * (high - low) / SAMPLES // 1).astype(int)
        new = new[new < high]
        at += new.tolist()
        weights += [(high - low) / len(new)] * len(new)
        low = high
    return moves, np.array(at), np.array(weights), rng.integers(1, 1 << 32, size=len(at), dtype=np.uint64)


def _classes(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(c < 128, np.maximum(c, 1), 128 + ((c * np.uint32(0x9E3779B1)) >> np.uint32(25))).astype(np.uint8)


_HEX = np.frombuffer(b"0123456789abcdef-", dtype=np.uint8)


def fingerprints(texts: list[str]) -> list[str]:
    """A string for each text: its segments' samples, joined by dots; a segment's string ends where its walk does."""
    moves, at, _, salts = _walk()
    parts, owners = [], []
    for k, t in enumerate(texts):
        x = _classes(t)
        for i in range(0, len(x), SEGMENT):
            parts.append(x[i : i + SEGMENT])
            owners.append(k)
    out: list[list[str]] = [[] for _ in texts]
    if not parts:
        return [""] * len(texts)
    lengths = np.array([len(p) for p in parts])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    ends = np.cumsum(lengths + 3)
    text = np.zeros(ends[-1], dtype=np.uint8)
    here = ends - lengths - 3
    for k, s in zip(order, here):
        text[s : s + len(parts[k])] = parts[k]
    found = np.full((len(parts), len(at)), 16, dtype=np.uint8)
    active = np.searchsorted(-3 * lengths, -np.arange(3 * lengths[0]), side="left").tolist()  # segments that are walked at each step
    sample, sampled = 0, at.tolist() + [-1]
    for step, n in enumerate(active):
        p = here[:n]
        c = text[p]
        if step == sampled[sample]:
            h = ((c.astype(np.uint64) * np.uint64(65_537) + text[p + 1]) * np.uint64(65_537) + text[p + 2] + np.uint64(1)) * salts[sample]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            found[:n, sample] = np.where(c == 0, 16, (h >> np.uint64(60)).astype(np.uint8))
            sample += 1
        p += moves[step][c]
    rows: list[str] = [""] * len(parts)
    for k, row in zip(order, _HEX[found]):
        rows[k] = row.tobytes().decode().rstrip("-")
    for k, row in zip(owners, rows):
        out[k].append(row)
    return [".".join(x) for x in out]


def likeness(a: str, b: str) -> float:
    """The weighted share of equal samples among those that either text has, 0 to 1; 1 for two empty texts."""
    if a == b:
        return 1.0
    weights = _walk()[2]
    same = every = 0.0
    x, y = a.split("."), b.split(".")
    for k in range(max(len(x), len(y))):
        u = np.frombuffer((x[k] if k < len(x) else "").encode(), dtype=np.uint8)
        v = np.frombuffer((y[k] if k < len(y) else "").encode(), dtype=np.uint8)
        n = min(len(u), len(v))
        same += weights[:n][u[:n] == v[:n]].sum()
        every += weights[: max(len(u), len(v))].sum()
    return float(min(1.0, same / every)) if every else 1.0


@lru_cache(maxsize=None)
def _band_positions(level: int) -> list[list[int]]:
    """The samples of each band of a level: from the first LEVEL * level of a segment, by their weights, so from all
    octaves of a segment of about that length. Bands of short levels are narrower. Level 0 is for fewer samples than
    LEVEL: of its pairs, one at least is equal in any two texts that are alike."""
    if level == 0:
        return [[0, 1], [2, 3], [4, 5]]
    weights = _walk()[2][: LEVEL * level]
    rng = np.random.default_rng([7, level])
    return [sorted(rng.choice(len(weights), min(BAND_WIDTH, 1 + level), replace=False, p=weights / weights.sum()).tolist()) for _ in range(BANDS)]


@lru_cache(maxsize=None)
def _levels(samples: int) -> range:
    """The levels of a segment of so many samples: from that of the shortest segment that can be alike, to its own."""
    held = np.cumsum(_walk()[2])
    shortest = int(np.searchsorted(held, LEAST_LIKENESS * held[samples - 1] * (1 - 1e-9))) + 1
    return range(shortest // LEVEL, samples // LEVEL + 1)


def bands(fingerprint: str) -> list[str]:
    """The band values of each segment, as 'segment:level:band:samples'. Empty for an empty text only.

    If two texts are alike, one segment at least is as alike, and has a level in common."""
    out = []
    for s, part in enumerate(fingerprint.split(".")):
        for level in _levels(len(part)) if part else ():
            for b, at in enumerate(_band_positions(level)):
                if at[-1] < len(part):
                    out.append(f"{s}:{level}:{b}:" + "".join([part[i] for i in at]))
        if len(part) == 1:
            out.append(f"{s}:0:0:{part}")
    return out


def edited_text(text: str, following: str) -> str:
    """text with its last floor(n / 2) code points replaced by the first as many (or all) of the next document."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, shared_bands int"


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of docs: the fingerprint of its text and of its edited text, and the likeness of the first to the
    second (near_edited) and to the next document's (near_next). The next document is the next by id, after the last
    the first; rows of one id stand in a fixed order, null ids before all others, null texts are empty.
    shared_bands: how many band values the text and the edited text share. An only document is its own next.

    Texts are moved once, compressed. Ids are cut into blocks at approximate quantiles; each block's first document is also sent to
    the block before, so that every block has its last document's next one."""
    spark = docs.sparkSession
    slim = modest_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("at"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = slim.select("at").count()
    k = min(MAX_BLOCKS, max(1, -(-rows // BLOCK_ROWS)))
    cuts = slim.select(F.col("doc_id").cast("double").alias("x")).where("x is not null").approxQuantile("x", [i / k for i in range(1, k)], 1 / (4 * k)) if k > 1 else []
    borders = np.unique(np.array(cuts, dtype=np.float64)).astype(np.int64)

    def block_of(at: np.ndarray) -> np.ndarray:
        return np.searchsorted(borders, at, side="right").astype(np.int32)

    @F.arrow_udf("int")
    def block(at: pa.Array) -> pa.Array:
        return pa.array(block_of(at.to_numpy(zero_copy_only=False)), pa.int32())

    firsts = sorted((r["block"], r["first"]) for r in slim.select("at", block("at").alias("block")).groupBy("block").agg(F.min("at").alias("first")).collect())  # at most MAX_BLOCKS
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}  # the first block's goes to the last

    @F.arrow_udf("array<int>")
    def placed(at: pa.Array) -> pa.Array:
        ids = at.to_numpy(zero_copy_only=False)
        return pa.array([[int(b)] if (p := before.get(int(i))) is None else [int(b), -1 - p] for i, b in zip(ids, block_of(ids))], pa.list_(pa.int32()))

    @F.arrow_udf("binary")
    def squeezed(texts: pa.Array) -> pa.Array:
        press = zstandard.ZstdCompressor(level=1)
        return pa.array([press.compress(t) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())

    dealt = slim.select("doc_id", "at", squeezed("text").alias("text"), placed("at").alias("places")).withColumn("place", F.explode("places")).withColumn("block", F.when(F.col("place") < 0, -1 - F.col("place")).otherwise(F.col("place")))
    ordered = dealt.repartition("block").sortWithinPartitions("block", (F.col("place") < 0), "at", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[str] = []
        size, current, ended = 0, None, False
        press = zstandard.ZstdDecompressor()

        def flush() -> Iterator[pa.RecordBatch]:
            """All held documents but the last, which is then the first of the next flush."""
            n = len(texts) - 1
            edited = [edited_text(texts[i], texts[i + 1]) for i in range(n)]
            prints = fingerprints(texts + edited)
            own, other = prints[: n + 1], prints[n + 1 :]
            shared = [len(set(bands(a)) & set(bands(b))) for a, b in zip(own, other)]
            columns = [ids[:n], [len(t) for t in texts[:n]], [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], own[:n], other]
            columns += [[likeness(a, b) for a, b in zip(own, other)], [likeness(a, b) for a, b in zip(own, own[1:])], shared]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _OUT.split(", ")])

        for b in rows_of(batches, 128):
            for i, text, place, blk in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "place", "block")), strict=True):
                if blk != current:
                    if len(texts) > 1:
                        yield from flush()
                    ids, texts, size, current, ended = [], [], 0, blk, False
                if ended:
                    continue  # further rows of the next block's first id
                ids.append(i)
                texts.append(press.decompress(text).decode("utf-8", "replace"))
                size += len(texts[-1])
                ended = place < 0
                if size >= BATCH_CHARS and len(texts) > 1:
                    yield from flush()
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
        if len(texts) > 1:
            yield from flush()

    return ordered.select("doc_id", "text", "place", "block").mapInArrow(run, _OUT).withColumnRenamed("doc_id", id_col)


def _laid_out(fingerprint: str) -> np.ndarray:
    """A row for each segment, its samples as bytes and zeros behind them."""
    parts = fingerprint.split(".")
    out = np.zeros((len(parts), len(_walk()[1])), dtype=np.uint8)
    for row, part in zip(out, parts):
        row[: len(part)] = np.frombuffer(part.encode(), dtype=np.uint8)
    return out


def links(prints: list[str], sides: list[int], least: float) -> list[tuple[int, int]]:
    """Pairs of places whose likeness is `least` or more, as many as connect all that such pairs connect. Where there are
    two sides, only pairs of both count. A pair is left out only if it is connected already or its lengths rule it out:
    likeness is at most the lesser weight by the greater."""
    weights = _walk()[2]
    laid = [_laid_out(p) for p in prints]
    held = [(x != 0) @ weights for x in laid]  # by segment
    total = np.array([h.sum() for h in held])
    order = np.argsort(total, kind="stable")
    side, label = np.array(sides)[order], np.arange(len(order))
    every_side = len(set(sides)) < 2
    slack, out, start = 1e-9, [], 0
    while start < len(order):
        # A run of places of about one weight, compared with all that stand before or in it.
        end = start + 1
        while end < len(order) and end - start < 64 and total[order[end]] * least <= total[order[start]]:
            end += 1
        n = max(len(laid[k]) for k in order[start:end])
        block, block_held = np.zeros((end - start, n, len(weights)), dtype=np.uint8), np.zeros((end - start, n))
        for row, k in enumerate(order[start:end]):
            block[row, : len(laid[k])], block_held[row, : len(laid[k])] = laid[k], held[k]
        first = int(np.searchsorted(total[order], total[order[start]] * least * (1 - slack), side="left"))
        for i in range(first, end):
            k, after = order[i], max(i + 1, start)
            rows = np.arange(after, end)
            rows = rows[(label[rows] != label[i]) & (every_side | (side[rows] != side[i]))]
            if not len(rows):
                continue
            m = min(n, len(laid[k]))
            own, theirs = laid[k][:m], block[rows - start]
            same = (((theirs[:, :m] == own) & (own != 0)) @ weights).sum(axis=1)
            longest = np.maximum(block_held[rows - start, :m], held[k][:m]).sum(axis=1) + block_held[rows - start, m:].sum(axis=1) + held[k][m:].sum()
            for j in rows[same >= (least - slack) * longest]:
                if label[j] != label[i] and likeness(prints[k], prints[order[j]]) >= least:
                    label[label == label[j]] = label[i]
                    out.append((int(k), int(order[j])))
        start = end
    return out


def near_duplicates(docs: DataFrame, least: float = LEAST_LIKENESS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of docs: doc_id and class_id, the smallest id that verified candidates connect it to.

    Equal fingerprints are one class from the start. Fingerprints that share a band value are candidates, and all their
    pairs are verified. Band values with the same members (by 128 bits of hashes) are taken once. The members of a large
    one are dealt to blocks of about GROUP, and each pair of blocks is a task's work of its own. Banding can miss a pair,
    as any sampling can; verification admits none below `least`. It is meant for copies with up to 0.2 % of their characters
    changed, of which it finds 0.9 or more; with more edits walks part for longer, and fewer reach `least`.

    Null texts are empty and one class; rows without an id have the class of rows with their fingerprint, or null; repeated
    rows are rows of one class; an empty table gives no rows; other columns aren't read."""

    @F.arrow_udf("string")
    def printed(texts: pa.Array) -> pa.Array:
        return pa.array(fingerprints([t or "" for t in texts.to_pylist()]), pa.string())

    @F.arrow_udf("array<string>")
    def banded(prints: pa.Array) -> pa.Array:
        return pa.array([bands(p) for p in prints.to_pylist()], pa.list_(pa.string()))

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, reps, prints, sides = None, [], [], []

        def found() -> pa.RecordBatch:
            pairs = links(prints, sides, least) if len(prints) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([reps[p[e]] for p in pairs], pa.int64()) for e in (0, 1)], names=["a", "b"])

        for b in rows_of(batches, 1024):
            for *key, side, rep, fp in zip(*(b.column(c).to_pylist() for c in ("band", "low", "high", "side", "rep", "fp")), strict=True):
                if key != tile:
                    yield found()
                    tile, reps, prints, sides = key, [], [], []
                reps.append(rep)
                prints.append(fp)
                sides.append(side)
        yield found()

    every = saved(modest_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), printed(F.col(text_col)).alias("fp")), "prints")
    classes = saved(every.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "print-classes")
    # Two fingerprints have one smallest id where rows of one id differ: classes are named by a hash of the fingerprint until the end.
    named = classes.select(F.xxhash64("fp").alias("rep"), "fp")
    held = saved(named.select("rep", F.explode(banded("fp")).alias("band")).select("rep", F.xxhash64("band").alias("band")), "print-bands")
    members = [F.count("*").alias("n"), F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("s"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("x")]
    groups = held.groupBy("band").agg(*members).where("n > 1").groupBy("n", "s", "x").agg(F.min("band").alias("band"))
    groups = saved(groups.select("band", F.ceil(F.col("n") / GROUP).cast("int").alias("k")), "print-groups")
    dealt = held.join(small(groups), "band").withColumn("side", F.pmod(F.xxhash64("rep", F.lit(2)), F.col("k")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select("rep", "band", "side", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"))
    tiles = dealt.join(named, "rep").select("band", "low", "high", "side", "rep", "fp").repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
    roots = components(tiles.mapInArrow(verified, "a long, b long"))
    known = classes.withColumn("node", F.xxhash64("fp")).join(roots, "node", "left").select("fp", "rep", F.coalesce("root", "node").alias("root"))
    known = saved(known, "print-roots")
    known = saved(known.join(known.groupBy("root").agg(F.min("rep").alias("class_id")), "root").select("fp", "class_id"), "print-known")
    return every.join(small(known), "fp", "left").select(F.col("doc_id").alias(id_col), "class_id")
