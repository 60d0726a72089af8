"""Packing: tokenized documents into training windows by best-fit decreasing.

Documents longer than a window are first cut into full windows and a rest. Rests and short documents are placed from
the longest down, each into the open window with the least remaining capacity that holds it; a segment tree indexed by
remaining capacity finds that window. What best fit leaves open is then closed: the emptiest windows are dissolved and
their pieces cut to fill the larger holes of the others, and the one window that stays open is split at powers of two,
which need no padding.

A task packs its own input block by block (a bounded number of tokens each), so nothing is shuffled, memory is
bounded, and a lost task is simply run again with the same result."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import modest_batches, released, rows_of

WINDOW = 4096
END_ID = 2
#: Tokens of a block that is packed at a time, 4 bytes each.
BLOCK_TOKENS = 4_000_000
#: Holes smaller than this stay padding: no document is cut for them.
LEAST_HOLE = 16
#: Cached white-space separated chunks of text per Python worker, and the longest of them in bytes: 60 MB at most. Longer
#: ones are held for 64 texts only.
CACHE_CHUNKS, CACHED_CHUNK = 250_000, 64


class CapacityTree:
    """A segment tree over capacities 0..size: leaves hold the open windows of just that capacity, inner nodes how many
    there are below."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: dict[int, list[int]] = defaultdict(list)

    def _add(self, capacity: int, n: int) -> None:
        i, count = capacity + self.leaves, self.count
        while i:
            count[i] += n
            i >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        self._add(capacity, 1)

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least `least` that an open window has."""
        i, count = least + self.leaves, self.count
        if count[i]:
            return least
        while i > 1:  # up to the first node whose right sibling holds windows, then down to its leftmost leaf
            if not i & 1 and count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None

    def take(self, capacity: int) -> int:
        self._add(capacity, -1)
        return self.open[capacity].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Windows as lists of indexes into lengths, each at most `window` long; ties go in input order."""
    tree, out = CapacityTree(window), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        capacity = tree.tightest(n)
        if capacity is None:
            at, capacity = len(out), window
            out.append([i])
        else:
            at = tree.take(capacity)
            out[at].append(i)
        if capacity > n:
            tree.put(capacity - n, at)
    return out


def pack(lengths: list[int], window: int = WINDOW, least_hole: int = LEAST_HOLE) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) pieces; each token of each document lies in exactly one. Documents of
    length 0 have no piece."""
    full = [[(d, s, window)] for d, n in enumerate(lengths) for s in range(0, n - window + 1, window)]
    rests = [(d, n - n % window, n % window) for d, n in enumerate(lengths) if n % window]
    windows = [[rests[i] for i in w] for w in best_fit_decreasing([r[2] for r in rests], window)]
    windows = [(sum(p[2] for p in w), w) for w in windows]
    full += [w for n, w in windows if window - n < least_hole]
    gaps = sorted(((n, w) for n, w in windows if window - n >= least_hole), key=lambda x: -x[0])
    # The emptiest is dissolved into the holes of the fullest, until one is left.
    i, j = 0, len(gaps) - 1
    last: list[tuple[int, int, int]] = []
    while i <= j:
        if i == j:
            last = gaps[i][1]
            break
        (n, into), (m, pieces) = gaps[i], gaps[j]
        d, s, k = pieces.pop()
        part = min(k, window - n)
        into.append((d, s, part))
        n, m = n + part, m - part
        if part < k:
            pieces.append((d, s + part, k - part))
        gaps[i], gaps[j] = (n, into), (m, pieces)
        if not pieces:
            j -= 1
        if window - n < least_hole:
            full.append(into)
            i += 1
    return full + split_at_powers(last)


def split_at_powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Sequences whose lengths are the powers of two that the pieces' length is the sum of."""
    left, out = sum(p[2] for p in pieces), []
    queue = pieces[::-1]
    while left:
        room = size = 1 << (left.bit_length() - 1)
        sequence = []
        while room:
            d, s, k = queue.pop()
            part = min(k, room)
            sequence.append((d, s, part))
            if part < k:
                queue.append((d, s + part, k - part))
            room -= part
        out.append(sequence)
        left -= size
    return out


#: Chunks with anything but ASCII signs and Latin letters, or with the start of a special token.
_OTHER = re.compile("[^\\x21-\\x7e\\xc0-\\u024f\\n]|<\\|")


def _byte_letters() -> str:
    """The visible character that stands for each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return "".join(chr(b if b in kept else next(rest)) for b in range(256))


class ChunkTokenizer:
    """Token ids as little-endian unsigned 32-bit bytes. The vocabulary drops white space and no piece crosses it, so a
    text's ids are its white-space separated chunks' ids, end to end; chunks are cached.

    New chunks of ASCII and Latin letters are encoded many at a time by a faster encoder of the same merges (ranked by
    merge, with a capital E, which lower-cased text lacks, for the end of a word); all others by the tokenizer itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[bytes, bytes] = {}
        spec = json.loads(Path(path).read_text())
        self.fast = spec["model"].get("end_of_word_suffix") == "</w>" and self._ranked(spec)

    def _ranked(self, spec: dict) -> bool:
        import tiktoken

        parts = {p["type"]: p for p in spec["pre_tokenizer"].get("pretokenizers", [])}
        if set(parts) != {"Split", "ByteLevel"} or [n["type"] for n in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]:
            return False
        shown = {c: bytes([b]) for b, c in enumerate(_byte_letters())}

        def raw(token: str) -> bytes:
            word = token.removesuffix("</w>")
            return b"".join(shown[c] for c in word) + b"E" * (word != token)

        ranks = {bytes([b]): b for b in range(256)}
        for b in range(256):
            ranks.setdefault(bytes([b, 69]), len(ranks))
        for m in spec["model"]["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            ranks.setdefault(raw(a) + raw(b), len(ranks))
        special = {t["content"] for t in spec["added_tokens"]}
        self.ids = np.zeros(len(ranks), dtype="<u4")
        for token, i in spec["model"]["vocab"].items():
            if token not in special and (r := ranks.get(raw(token))) is not None:
                self.ids[r] = i
        self.merges = tiktoken.Encoding("merges", pat_str=r"[^E\n]+E|\n", mergeable_ranks=ranks, special_tokens={})
        self.pieces = regex.compile(parts["Split"]["pattern"]["Regex"])
        return True

    def learn(self, chunks: set[bytes]) -> None:
        new = list(chunks.difference(self.cache))
        if len(self.cache) + len(new) > CACHE_CHUNKS:
            self.cache.clear()
            new = list(chunks)
        for i in range(0, len(new), 4096):
            some = new[i : i + 4096]
            texts = [c.decode("utf-8", "replace") for c in some]
            if self.fast and _OTHER.search("\n".join(texts)):
                odd = [bool(_OTHER.search(t)) for t in texts]
                self._slow([c for c, o in zip(some, odd) if o], [t for t, o in zip(texts, odd) if o])
                some, texts = [c for c, o in zip(some, odd) if not o], [t for t, o in zip(texts, odd) if not o]
            (self._quick if self.fast else self._slow)(some, texts)

    def _slow(self, chunks: list[bytes], texts: list[str]) -> None:
        for c, e in zip(chunks, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            self.cache[c] = np.array(e.ids, dtype="<u4").tobytes()

    def _quick(self, chunks: list[bytes], texts: list[str]) -> None:
        marked = self.pieces.sub(r"\g<0>E", "\n".join(texts).lower()) + "\n"
        ranks = self.merges.encode_to_numpy(marked)
        ends = np.flatnonzero(ranks == 10)
        ids, at = self.ids[ranks].tobytes(), 0
        if len(chunks):
            for c, e in zip(chunks, (4 * ends).tolist(), strict=True):
                self.cache[c] = ids[at:e]
                at = e + 4

    def encode(self, texts: list[bytes]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), 64):
            split = [t.split() for t in texts[i : i + 64]]
            words = set().union(*split)
            if not words <= self.cache.keys():
                self.learn(words)
            get = self.cache.__getitem__
            out += [b"".join(map(get, s)) for s in split]
            for w in [w for w in words if len(w) > CACHED_CHUNK]:
                del self.cache[w]
        return out


_tokenizers: dict[str, ChunkTokenizer] = {}


def chunk_tokenizer(path: str) -> ChunkTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = ChunkTokenizer(path)
    return _tokenizers[path]


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
WITH_IDS = SCHEMA + ", ids array<int>"


def packed(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with with_ids the ids.

    A document's tokens are its ids and end_id. Null and blank texts have end_id alone. Rows with equal or null ids are
    separate documents. Other columns aren't read; an empty table gives no rows. Sequences are numbered by the task
    and its count, unique in the result; their order follows the input's, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = chunk_tokenizer(tokenizer_path), np.uint32(end_id).tobytes()
        sequence = TaskContext.get().partitionId() << 36
        ids: list[int | None] = []
        tokens: list[bytes] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            lengths = [len(t) // 4 for t in tokens]
            out: list[tuple] = []
            for pieces in pack(lengths, window):
                offset = 0
                for d, s, n in pieces:
                    part = memoryview(tokens[d])[4 * s : 4 * (s + n)]
                    out.append((ids[d], s, n, zlib.crc32(part), lengths[d], sequence, offset, *([np.frombuffer(part, "<u4").astype(np.int32)] if with_ids else [])))
                    offset += n
                sequence += 1
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
            names = [x.split()[0] for x in WITH_IDS.split(", ")]
            step = 256 if with_ids else 8192
            for i in range(0, len(out), step):
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*out[i : i + step]), kinds, strict=True)], names=names[: len(kinds)])

        for b in rows_of(batches, 512):
            ids += b.column(0).to_pylist()
            new = [t + end for t in tokenizer.encode([t or b"" for t in b.column(1).to_pylist()])]
            tokens += new
            held += sum(map(len, new)) // 4
            if held >= block_tokens:
                yield from flush()
                ids.clear(), tokens.clear()
                held = 0
        if tokens:
            yield from flush()
            ids.clear(), tokens.clear()
        released()

    slim = modest_batches(docs).select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    return slim.mapInArrow(run, WITH_IDS if with_ids else SCHEMA)
