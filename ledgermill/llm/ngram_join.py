"""N-gram Jaccard join: near-duplicate documents by the overlap of their word shingles, exactly.

1. Each text becomes a sorted array of 64-bit hashes of its distinct shingles. Equal sets are one node from here on,
   named by a 128-bit hash, so groups of copies of any size are combined in the map tasks that read them.
2. The documents of each shingle are counted, by 32 bits of its hash, in slices of the hashes that tasks own. A table of levels
   (powers of two of these counts) orders shingles from rare to common. Two sets with Jaccard
   0.75 or more share a shingle among the first quarter of either in any such order, so each set posts only those, and none that
   occurs once.
   Postings travel as packed arrays by hash range. Where at most FEW sets meet under a shingle, their pairs are taken if
   sizes and the shingle's places allow a link, and kept if their bitmap signatures do: the bits in which two differ
   bound their overlap from above. Where more meet, they are joined in a chain by size, never in all pairs. The
   components of pairs and chains hold every link.
3. Each component is laid out as tiles. A small one is one tile. A large one is cut into blocks by size band, and each block
   first meets some pivots, sets of its own and the next bands: the near copies of one text are connected by these, in rows
   that grow with their number. Of what isn't connected then, a tile is a pair of blocks whose bands can link; pairs within the
   largest group that is connected already are left out. In a tile, bitmaps as wide as its largest set asks bound the overlap
   again, and only pairs that pass and aren't connected yet are intersected as sorted arrays.
4. Links found in tiles are joined to components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .common import alone, modest_batches, released, rows_of, saved, small
from .components import components

N = 5
#: Shingles are counted in so many slices of their hashes, each by one task: sorted differences, some 1.5 bytes a shingle.
SLICE_BITS = 10
#: Entries of the table of levels, of 4 bits each: as many as the sets have shingles for every two, and from 2^LEAST_BITS to
#: 2^LEVEL_BITS, 64 MB, whatever the corpus. Only shingles of several sets make entries, so those
#: of one set, nearly all of a corpus, don't crowd it. A shingle that falls on another's entry looks as common as that: rarity
#: is then a guess, and more sets meet under common shingles and are compared for nothing.
LEVEL_BITS, LEAST_BITS = 27, 16
#: Shingles that a map task sorts for counting at a time.
COUNTED = 1 << 21
#: So many sets that meet under a shingle are compared in pairs; more are chained.
FEW = 8
#: Postings of a hash range, about.
RANGE_POSTINGS = 400_000
#: Postings that a map task packs at a time.
PACK_POSTINGS = 600_000
#: A block of a tile holds about so many sets, and so many shingles, at most.
BLOCK_SETS, BLOCK_SHINGLES = 400, 1_000_000
#: Sets of a size band of a large component that its blocks meet first, about.
PIVOTS = 32
#: Words whose hashes a Python worker keeps, and the longest of them in bytes: 20 MB.
CACHE_WORDS, CACHED_WORD = 100_000, 64
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHED_WORD and len(self) < CACHE_WORDS:
            self[word] = h
        return h


_hashes = _Hashes()


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct N-word shingles; words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased. With
    fewer words, the whole sequence is one shingle; without words, none."""
    if len(_hashes) >= CACHE_WORDS:
        _hashes.clear()
    words = [(t or b"").lower().split() for t in texts]
    sizes = [len(w) for w in words]
    h = np.fromiter(map(_hashes.__getitem__, chain.from_iterable(words)), dtype=np.uint64, count=sum(sizes))
    if len(h) >= N:
        s = h[: len(h) - N + 1] * _MIX[0]
        for k in range(1, N):
            s += h[k : len(h) - N + 1 + k]
            s ^= s >> np.uint64(32)
            s *= _MIX[k]
        s ^= s >> np.uint64(29)
    out, at = [], 0
    for w, n in zip(words, sizes):
        if n >= N:
            x = np.sort(s[at : at + n - N + 1])
            out.append(x if len(x) < 2 else x[np.concatenate(([True], x[1:] != x[:-1]))])
        elif n:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(w), seed=n)], dtype=np.uint64))
        else:
            out.append(np.empty(0, dtype=np.uint64))
        at += n
    return out


def prefix_length(n: int) -> int:
    """So many of a set's first shingles in any fixed order meet those of every set with Jaccard 0.75 or more."""
    return n - (3 * n + 3) // 4 + 1


def linked(overlap: int, n: int, m: int) -> bool:
    return 100 * overlap >= 75 * (n + m - overlap) and overlap > 0


def bitmap(s: np.ndarray, bits: int = 0) -> np.ndarray:
    """Which hashes modulo a power of two occur, 1 to 2 bits for each of the set's shingles, as 64-bit words."""
    bits = bits or max(64, 1 << max(0, len(s) - 1).bit_length())
    row = np.zeros(bits, dtype=bool)
    row[(s & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(row, bitorder="little").view(np.uint64)


def may_link(x: bytes, y: bytes, n: int, m: int) -> bool:
    """Whether sets of n and m shingles with these bitmaps can link. The wider one is folded to the other's width."""
    a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
    if len(a) > len(b):
        a, b = b, a
    while len(b) > len(a):
        b = b[: len(b) // 2] | b[len(b) // 2 :]
    differ = int(np.bitwise_count(a ^ b).sum())
    return 7 * ((n + m - differ) // 2) >= 3 * (n + m)


def _name(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    for b in rows_of(batches, 256):
        yield b.column(0).to_pylist(), shingle_sets(b.column(1).to_pylist())
    _hashes.clear()
    released()


_LOW = 32 - SLICE_BITS


def _sliced(held: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """The shingles' upper 32 bits by slice: sorted differences, by byte planes, compressed."""
    keys = np.sort((np.concatenate(held) >> np.uint64(32)).astype(np.uint32))
    press = zstandard.ZstdCompressor(level=1)
    at = np.searchsorted(keys, np.arange(1 << SLICE_BITS, dtype=np.uint32) << np.uint32(_LOW)).tolist() + [len(keys)]
    for i in range(1 << SLICE_BITS):
        if at[i] < at[i + 1]:
            steps = np.diff(keys[at[i] : at[i + 1]] & np.uint32((1 << _LOW) - 1), prepend=np.uint32(0))
            yield i, press.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes())


def level_bits(shingles: int) -> int:
    """The bits of the table of levels for sets of so many shingles in all."""
    return min(LEVEL_BITS, max(LEAST_BITS, (shingles // 2).bit_length()))


def _levels(parts: list[bytes], bits: int) -> np.ndarray:
    """The levels of a slice's entries, of 2^bits in all: 0 where no shingle occurs twice, else k for one that occurs more than 2^(k-1) times and at
    most 2^k, the most common's; 15 at most."""
    press = zstandard.ZstdDecompressor()
    keys = [np.cumsum(np.ascontiguousarray(np.frombuffer(press.decompress(c), dtype=np.uint8).reshape(4, -1).T).view(np.uint32).ravel(), dtype=np.uint32) for c in parts]
    key = np.sort(np.concatenate(keys))
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    n = np.diff(np.concatenate((starts, [len(key)])))
    some = n > 1
    entry = (key[starts[some]] >> np.uint32(32 - bits)).astype(np.int64)
    out = np.zeros(1 << (bits - SLICE_BITS), dtype=np.uint8)
    np.maximum.at(out, entry, np.minimum(np.ceil(np.log2(n[some])), 15).astype(np.uint8))
    return out


def _names_and_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document (its set's name and size), then rows of the task's shingles by slice."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("bits", pa.binary()), ("counts", pa.binary())])
    held: list[np.ndarray] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        rows = list(_sliced(held))
        none = pa.nulls(len(rows), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.array([i for i, _ in rows], pa.int64()), none, none, pa.nulls(len(rows), pa.binary()), pa.array([c for _, c in rows], pa.binary())], schema=schema)
        held.clear()

    for ids, sets in _read(batches):
        names = [_name(s) for s in sets]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([a for a, _ in names], pa.int64()), pa.array([b for _, b in names], pa.int64()), pa.array([bitmap(s).tobytes() for s in sets], pa.binary()), pa.nulls(len(ids), pa.binary())], schema=schema)
        held += sets
        size += sum(map(len, sets))
        if size > COUNTED:
            yield from flush()
            size = 0
    if size:
        yield from flush()


def _leveled(batches: Iterator[pa.RecordBatch], bits: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows (slice, counts) sorted by slice -> a row per slice: its levels, two to a byte."""
    bits, current, held = bits or LEVEL_BITS, None, []

    def flush() -> pa.RecordBatch:
        x = _levels(held, bits)
        return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([(x[0::2] | (x[1::2] << 4)).tobytes()], pa.binary())], names=["n", "levels"])

    for b in rows_of(batches, 256):
        for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if k != current:
                if held:
                    yield flush()
                current, held = k, []
            held.append(c)
    if held:
        yield flush()
    released()


def _level_of(table: np.ndarray, s: np.ndarray) -> np.ndarray:
    at = s >> np.uint64(64 - len(table).bit_length())  # two entries a byte
    return (table[(at >> np.uint64(1)).astype(np.int64)] >> ((at & np.uint64(1)).astype(np.uint8) * np.uint8(4))) & np.uint8(15)


def _components_in(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges to each node's smallest connected node, of the graph with edges a-b."""
    nodes, inverse = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    some = root != np.arange(len(nodes))
    return nodes[some], nodes[root[some]]


def _unique(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _meetings(keys: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The postings of a hash range, as edges a-b and whether they are of a chain. places: of the shingle in its set's
    order, in 65536ths of the set, rounded down."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = k[1:] == k[:-1]
    order = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
    order = order[np.lexsort((nodes[order], sizes[order], keys[order]))]
    k, v = keys[order], nodes[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (v[1:] != v[:-1])  # copies that several map tasks posted
    order = order[new]
    k, v, n = keys[order], nodes[order], sizes[order].astype(np.int64)
    at = (places[order].astype(np.int64) * n) >> 16
    starts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.empty(0, dtype=np.int64)
    runs = np.diff(np.concatenate((starts, [len(k)])))
    few = np.repeat(runs <= FEW, runs)
    a, b = [v[:0]], [v[:0]]
    for d in range(1, min(FEW, len(k))):
        i = np.flatnonzero((k[d:] == k[:-d]) & few[d:])
        j = i + d
        least = (3 * (n[i] + n[j]) + 6) // 7  # of what must be shared, this shingle and what stands after it in either
        ok = (4 * n[i] >= 3 * n[j]) & (at[i] <= n[i] - least) & (at[j] <= n[j] - least)
        a.append(v[i[ok]])
        b.append(v[j[ok]])
    x, y = _unique(np.concatenate(a), np.concatenate(b))
    chained = (k[1:] == k[:-1]) & ~few[1:] & (4 * n[:-1] >= 3 * n[1:])
    c, e = _components_in(v[:-1][chained], v[1:][chained]) if chained.any() else (v[:0], v[:0])
    return np.concatenate((x, c)), np.concatenate((y, e)), np.repeat([False, True], [len(x), len(c)])


def _tile_links(sets: list[np.ndarray], ids: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """For each set of a tile the smallest id that it is connected to. sides: 0 and 1 for the tile's two blocks, of which
    only pairs across are compared, or all 2: every pair."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    order = np.lexsort((ids, n))
    sets, n, sides, own = [sets[i] for i in order], n[order], sides[order], ids[order]
    bits = 1 << min(15, max(9, int(2 * n[-1]).bit_length()))
    maps = np.zeros((len(sets), bits // 64), dtype=np.uint64)
    for i, s in enumerate(sets):
        maps[i] = bitmap(s, bits)
    root = own.copy()
    for i in range(len(sets) - 1):
        end = int(np.searchsorted(n, 4 * n[i] // 3, side="right"))
        if end <= i + 1:
            continue
        js = i + 1 + np.flatnonzero(root[i + 1 : end] != root[i])
        js = js[(sides[js] == 2) | (sides[js] != sides[i])]
        for part in np.array_split(js, len(js) * bits // (1 << 26) + 1):  # at most 8 MB of bitmaps at a time
            differ = np.bitwise_count(maps[part] ^ maps[i]).sum(axis=1, dtype=np.int64)
            most = (n[i] + n[part] - differ) // 2
            for j in part[7 * most >= 3 * (n[i] + n[part])]:
                if root[j] != root[i] and linked(len(np.intersect1d(sets[i], sets[j], assume_unique=True)), int(n[i]), int(n[j])):
                    a, b = sorted((int(root[i]), int(root[j])))
                    root[root == b] = a
    out = np.empty(len(sets), dtype=np.int64)
    out[order] = root
    return out


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tile, single, side, s1, shingles) sorted by tile -> (node, root, single) of the sets linked to one of a smaller name."""
    current, single = None, True
    found: dict[tuple[int, int], np.ndarray] = {}

    def flush() -> pa.RecordBatch:
        keys = list(found)
        ids, sides = np.array([k[0] for k in keys], dtype=np.int64), np.array([k[1] for k in keys])
        root = _tile_links([found[k] for k in keys], ids, sides)
        some = root != ids
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(root[some]), pa.array([single] * int(some.sum()), pa.bool_())], names=["node", "root", "single"])

    for b in rows_of(batches, 256):
        for tile, one, side, name, shingles in zip(*(b.column(c).to_pylist() for c in ("tile", "single", "side", "s1", "shingles")), strict=True):
            if tile != current:
                if len(found) > 1:
                    yield flush()
                current, single, found = tile, one, {}
            found[name, side] = np.frombuffer(shingles, dtype="<u8")
    if len(found) > 1:
        yield flush()


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of docs: doc_id (long), n_shingles, component_id: the smallest doc_id reachable by links of Jaccard
    0.75 or more over distinct 5-word shingles.

    Null, empty and blank texts have no shingles and are linked with nothing. Rows without an id are grouped with equal
    sets only; component_id is then the smallest id among those, or null. Repeated ids are one document's rows if
    their texts agree, else documents of one name. Other columns aren't read."""
    return _components(docs, id_col, text_col).select(F.col("doc_id").alias(id_col), "n_shingles", "component_id")


def _components(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """ngram_components() with the name of each row's set, (s1, s2), as a table; what it was made from is removed. Sets are told
    apart by s1, not by an id."""
    return alone(docs.sparkSession, lambda: _classes(docs, id_col, text_col), "ngram-classes")


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    slim = modest_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    first = saved(slim.mapInArrow(_names_and_counts, "doc_id long, n long, s1 long, s2 long, bits binary, counts binary"), "ngram-names")
    names = first.where("counts is null").select("doc_id", "n", "s1", "s2")
    named = first.where("counts is null and n > 0").groupBy("s1", "s2")
    reps = saved(named.agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.count("*").alias("copies"), F.first("bits").alias("bits")), "ngram-sets")
    postings = reps.agg(F.sum("n")).first()[0] or 0
    ranges = max(1, postings // 4 // RANGE_POSTINGS)
    bits = level_bits(postings)
    table = np.zeros(1 << (bits - 1), dtype=np.uint8)
    slices = first.where("counts is not null").select("n", "counts").repartition("n").sortWithinPartitions("n")
    part = 1 << (bits - 1 - SLICE_BITS)
    for r in saved(slices.mapInArrow(lambda batches: _leveled(batches, bits), "n long, levels binary"), "ngram-levels").toLocalIterator():  # LEVEL_BITS bound what comes here: 64 MB
        table[r["n"] * part : (r["n"] + 1) * part] = np.frombuffer(r["levels"], dtype=np.uint8)
    levels = spark.sparkContext.broadcast(table)
    del table

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels.value
        seen: set[tuple[int, int]] = set()
        hashes: list[np.ndarray] = []
        nodes: list[int] = []
        sizes: list[int] = []
        starts: list[int] = []
        lengths: list[int] = []

        def flush() -> Iterator[pa.RecordBatch]:
            h, k = np.concatenate(hashes), np.array(lengths)
            node, size = np.repeat(np.array(nodes, dtype=np.int64), k), np.repeat(np.array(sizes, dtype=np.uint32), k)
            place = np.concatenate([np.arange(a, a + m, dtype=np.uint64) * np.uint64(65536) // np.uint64(n) for a, m, n in zip(starts, lengths, sizes)]).astype(np.uint16)
            r = ((h & np.uint64(0xFFFFFFFF)) * np.uint64(ranges)) >> np.uint64(32)
            order = np.argsort(r, kind="stable")
            r, key, node, size, place = r[order], (h[order] >> np.uint64(32)).astype(np.uint32), node[order], size[order], place[order]
            at = np.concatenate(([0], np.flatnonzero(r[1:] != r[:-1]) + 1, [len(r)])).tolist()
            rows = [(int(r[a]), key[a:b].tobytes(), node[a:b].tobytes(), size[a:b].tobytes(), place[a:b].tobytes()) for a, b in zip(at, at[1:])]
            for i in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows[i : i + 4096]), (pa.int32(), *[pa.binary()] * 4))], names=["range", "keys", "nodes", "sizes", "places"])

        held = 0
        for _, sets in _read(batches):
            for s in sets:
                if not len(s) or (name := _name(s)) in seen:
                    continue
                seen.add(name)
                level = _level_of(table, s)
                rare = np.argsort(level, kind="stable")[: prefix_length(len(s))]
                alone = int(np.count_nonzero(level[rare] == 0))  # come first; no other set has them, so nothing meets there
                if alone == len(rare):
                    continue
                hashes.append(s[rare[alone:]])
                nodes.append(name[0])
                sizes.append(len(s))
                starts.append(alone)
                lengths.append(len(rare) - alone)
                held += len(rare) - alone
            if len(seen) > 200_000:
                seen.clear()
            if held >= PACK_POSTINGS:
                yield from flush()
                hashes.clear(), nodes.clear(), sizes.clear(), starts.clear(), lengths.clear()
                held = 0
        if held:
            yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by range: only one range's postings are held at a time."""
        current, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            a, b, chained = _meetings(*(np.concatenate([np.frombuffer(x[i], dtype=t) for x in held]) for i, t in enumerate((np.uint32, np.int64, np.uint32, np.uint16))))
            for i in range(0, len(a), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 16)]) for x in (a, b, chained)], names=["a", "b", "chained"])

        for batch in rows_of(batches, 64):
            for r, *arrays in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r != current:
                    if held:
                        yield from flush()
                    current, held = r, []
                held.append(arrays)
        if held:
            yield from flush()
        held.clear()
        released()

    @F.arrow_udf("boolean")
    def may(x: pa.Array, y: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        return pa.array([may_link(*p) for p in zip(*(c.to_pylist() for c in (x, y, n, m)), strict=True)], pa.bool_())

    posted = slim.mapInArrow(post, "range int, keys binary, nodes binary, sizes binary, places binary")
    met = saved(posted.repartition(min(ranges, 20_000), "range").sortWithinPartitions("range").mapInArrow(meet, "a long, b long, chained boolean").distinct(), "ngram-met")
    levels.destroy()
    x, y = (reps.select(F.col("s1").alias(k), F.col("n").alias(f"n_{k}"), F.col("bits").alias(f"bits_{k}")) for k in ("a", "b"))
    pairs = met.where("not chained").select("a", "b").join(x, "a").join(y, "b").where(may("bits_a", "bits_b", "n_a", "n_b"))
    near = components(met.where("chained").select("a", "b").unionByName(pairs.select("a", "b")))
    groups = saved(reps.where("rep is not null").join(near.select(F.col("node").alias("s1"), F.col("root").alias("comp")), "s1").select("s1", "s2", "rep", "n", "comp"), "ngram-groups")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _read(batches):
            names = [_name(s) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in names], pa.int64()), pa.array([b for _, b in names], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["s1", "s2", "shingles"])

    def linked_in(laid: DataFrame) -> DataFrame:
        tiles = saved(laid, "ngram-tiles")
        texts = slim.join(small(tiles.select(F.col("rep").alias("doc_id")).distinct()), "doc_id", "left_semi")
        sets = texts.mapInArrow(shingled, "s1 long, s2 long, shingles binary").join(small(tiles), ["s1", "s2"])
        tiled = sets.select("tile", "single", "side", "s1", "shingles").repartition("tile").sortWithinPartitions("tile")
        return saved(tiled.mapInArrow(_tiles, "node long, root long, single boolean"), "ngram-links")

    first_tiles, large = _laid_out(groups)
    links = linked_in(first_tiles)
    if large is not None:
        clusters = components(links.where("not single").select(F.col("node").alias("a"), F.col("root").alias("b")))
        rest = _rest_laid_out(large, clusters)
        if rest is not None:
            links = saved(links.unionByName(linked_in(rest)), "ngram-links")
    # A component that is one tile is done there; links of others are joined.
    across = components(links.where("not single").select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = links.where("single").select("node", "root").unionByName(across.select("node", "root"))
    members = saved(roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct().select(F.col("node").alias("s1"), "root"), "ngram-members")
    lows = members.join(reps.select("s1", "rep"), "s1").groupBy("root").agg(F.min("rep").alias("low"))
    known = reps.join(members.join(lows, "root").select("s1", "low"), "s1", "left").where("copies > 1 or low is not null")
    known = saved(known.select("s1", "s2", F.coalesce("low", "rep").alias("component_id")), "ngram-known")
    out = names.join(small(known), ["s1", "s2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "s1", "s2")


def _blocks(sets: Column, shingles: Column) -> Column:
    return F.ceil(F.greatest(sets / BLOCK_SETS, shingles / BLOCK_SHINGLES)).cast("int")


def _laid_out(groups: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The first tiles, (s1, s2, rep, tile, side, single): small components whole, and each block of a large one with its pivots;
    and the sets of large components (None: there are none)."""
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(4 / 3))).cast("int")  # linked sets' bands differ by 1 at most
    groups = groups.withColumn("band", band)
    bands = groups.groupBy("comp", "band").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    whole = bands.groupBy("comp").agg(F.sum("sets").alias("all_sets"), F.sum("shingles").alias("all_shingles"))
    is_small = (F.col("all_sets") <= BLOCK_SETS) & (F.col("all_shingles") <= BLOCK_SHINGLES)
    sized = saved(bands.join(whole, "comp").withColumn("single", is_small).withColumn("blocks", _blocks(F.col("sets"), F.col("shingles"))), "ngram-bands")
    one = groups.join(small(sized.where("single").select("comp").distinct()), "comp", "left_semi")
    one = one.select("s1", "s2", "rep", F.xxhash64("comp").alias("tile"), F.lit(2).alias("side"), F.lit(True).alias("single"))
    share = F.least(F.lit(PIVOTS) / F.col("sets"), F.lit(BLOCK_SHINGLES / 4) / F.col("shingles"))  # of a band's sets that are pivots
    large = saved(sized.where("not single").select("comp", "band", "blocks", share.alias("share")), "ngram-large")
    if large.isEmpty():
        return one, None
    cut = saved(groups.join(small(large), ["comp", "band"]).withColumn("block", F.pmod(F.xxhash64("s2"), F.col("blocks")).cast("int")), "ngram-cut")
    pivots = cut.where(F.xxhash64("s1", "s2", F.lit(5)) / F.lit(2.0**64) + 0.5 < F.col("share")).select("s1", "s2", "rep", "comp", "band")
    near = small(large.select("comp", F.col("band").alias("band2"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block2")))
    tile = lambda band, block: F.xxhash64("comp", band, block, F.lit("pivots")).alias("tile")
    members = cut.select("s1", "s2", "rep", tile("band", "block"), F.lit(0).alias("side"), F.lit(False).alias("single"))
    meet = pivots.join(near, "comp").where("abs(band2 - band) <= 1").select("s1", "s2", "rep", tile("band2", "block2"), F.lit(1).alias("side"), F.lit(False).alias("single"))
    return one.unionByName(members).unionByName(meet), cut.select("s1", "s2", "rep", "n", "comp", "band")


def _rest_laid_out(large: DataFrame, clusters: DataFrame) -> DataFrame | None:
    """The tiles of what the pivots left: pairs of blocks whose bands can link, but none within a component's largest cluster.
    None: nothing is left."""
    known = large.join(clusters.select(F.col("node").alias("s1"), "root"), "s1", "left").withColumn("root", F.coalesce("root", "s1"))
    sizes = saved(known.groupBy("comp", "root").agg(F.count("*").alias("sets")), "ngram-clusters")
    most = saved(sizes.groupBy("comp").agg(F.max(F.struct("sets", "root"))["root"].alias("largest"), F.count("*").alias("clusters")).where("clusters > 1"), "ngram-largest")
    if most.isEmpty():
        return None
    left = saved(known.join(small(most.drop("clusters")), "comp").withColumn("apart", (F.col("root") != F.col("largest")).cast("int")).drop("root", "largest"), "ngram-left")
    parts = saved(left.groupBy("comp", "band", "apart").agg(_blocks(F.count("*"), F.sum("n")).alias("blocks")), "ngram-parts")
    cut = left.join(small(parts), ["comp", "band", "apart"]).withColumn("me", F.struct("band", "apart", F.pmod(F.xxhash64("s2"), F.col("blocks")).cast("int").alias("block")))
    mates = parts.select("comp", "band", "apart", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).select("comp", F.struct("band", "apart", "block").alias("other"))
    pairs = cut.join(small(saved(mates, "ngram-mates")), "comp").where((F.abs(F.col("me.band") - F.col("other.band")) <= 1) & (F.col("me.apart") + F.col("other.apart") > 0))
    first = F.col("me") < F.col("other")
    low, high = F.when(first, F.col("me")).otherwise(F.col("other")), F.when(first, F.col("other")).otherwise(F.col("me"))
    side = F.when(F.col("me") == F.col("other"), 2).when(first, 0).otherwise(1)
    return pairs.select("s1", "s2", "rep", F.xxhash64("comp", low, high).alias("tile"), side.alias("side"), F.lit(False).alias("single"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay when of each component the document with the smallest id does; rows without an id stay.
    Of an id with several texts, only the rows whose set belongs to a smaller id go. Columns of any name are kept."""
    found = _components(docs, id_col, text_col).where("doc_id is not null").select("doc_id", (F.col("doc_id") != F.col("component_id")).alias("goes"), "s1", "s2")
    gone = saved(found.where("goes").select("doc_id").distinct(), "ngram-gone")
    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("words"))
    rest = whole.join(small(gone), "doc_id", "left_anti").select("row.*")
    mixed = saved(found.where("not goes").select("doc_id").distinct().join(small(gone), "doc_id", "left_semi"), "ngram-mixed")
    if mixed.isEmpty():
        return rest

    @F.arrow_udf("struct<s1:long,s2:long>")
    def named(texts: pa.Array) -> pa.Array:
        names = [_name(x) for x in shingle_sets(texts.to_pylist())]
        _hashes.clear()
        return pa.StructArray.from_arrays([pa.array([n[k] for n in names], pa.int64()) for k in (0, 1)], names=["s1", "s2"])

    some = whole.join(small(mixed), "doc_id", "left_semi").withColumn("name", named("words"))
    some = some.select("row", "doc_id", F.col("name.s1").alias("s1"), F.col("name.s2").alias("s2"))
    stay = some.join(found.where("goes").select("doc_id", "s1", "s2").distinct(), ["doc_id", "s1", "s2"], "left_anti")
    return rest.unionByName(stay.select("row.*"))
