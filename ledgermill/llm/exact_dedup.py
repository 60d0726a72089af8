"""Exact dedup over an extendible-hash index on shared files.

Texts are equal when they are identical after replacing each run of [\\x20\\x09-\\x0D] by one space. An index entry is a
distinct (64-bit key, SHA-256) with its count and its first row, combined map-side, so a group of copies of any size is
a few rows before any shuffle. The directory starts with one bucket; while a bucket holds more entries than it may, it
is split by one more leading bit of the key, and the directory doubles when the bucket is as deep as the directory. So a
bucket is a range of keys; its file stands in the shared folder, a folder per bucket, and one owner task has it. Texts of
keys with more than one row probe the directory and are sent to their bucket's owner, copies within a map task combined
first. The owner reads the bucket's entries and its texts in the order of keys, chains the different texts of a key,
compares bytes, and says for each chain link which row stays and how many rows it has. A text whose entry isn't in its
owner's bucket is an error, never a silent loss."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import dropped, modest_batches, null_key, released, rows_of, saved, small

#: Entries of a bucket; a bucket of more is split.
BUCKET_ENTRIES = 8_000
#: Buckets that a driver plans for, about: where entries are so many that there would be more, each may hold more entries.
#: An owner reads its bucket in order and holds one key's texts, so its memory doesn't depend on that.
BUCKETS = 1 << 15
#: Leading bits of the key by which entries are counted: 2 ** 18 counts at most come to the driver.
COUNTED_BITS = 18
#: Bytes of texts that a map task combines at a time.
COMBINE_BYTES = 16 << 20


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


@dataclass
class Directory:
    """slots[prefix of `depth` bits] is a bucket; buckets[b] is (local depth, prefix of so many bits)."""

    depth: int
    slots: list[int]
    buckets: list[tuple[int, int]]


def directory(counts: dict[int, int], most: int = BUCKET_ENTRIES, max_depth: int = COUNTED_BITS) -> Directory:
    """counts: entries by the key's first max_depth bits, beyond which keys aren't told apart."""
    sums = [counts]  # by depth, from the deepest
    for _ in range(max_depth):
        up: dict[int, int] = {}
        for p, n in sums[-1].items():
            up[p >> 1] = up.get(p >> 1, 0) + n
        sums.append(up)
    d, todo = Directory(0, [0], [(0, 0)]), [0]
    while todo:
        b = todo.pop()
        depth, prefix = d.buckets[b]
        if sums[max_depth - depth].get(prefix, 0) <= most or depth == max_depth:
            continue
        if depth == d.depth:  # the directory doubles: each slot becomes two that share its bucket
            d.slots, d.depth = [s for s in d.slots for _ in range(2)], d.depth + 1
        d.buckets[b] = (depth + 1, 2 * prefix)
        d.buckets.append((depth + 1, 2 * prefix + 1))
        width = 1 << (d.depth - depth - 1)
        for i in range((2 * prefix + 1) * width, (2 * prefix + 2) * width):
            d.slots[i] = len(d.buckets) - 1
        todo += [b, len(d.buckets) - 1]
    return d


@dataclass
class Index:
    """rows: a row per document row (doc_id, row, key, sha). entries: the bucket files (bucket, key, sha, keep_id, keep_row,
    n)."""

    rows: DataFrame
    entries: DataFrame
    directory: Directory


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_entries: int = BUCKET_ENTRIES) -> Index:
    spark, text = docs.sparkSession, normalized(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text")).select("doc_id", F.monotonically_increasing_id().alias("row"), F.xxhash64("_text").alias("key"), F.unhex(F.sha2("_text", 256)).alias("sha"))
    rows = saved(rows, "dedup-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    entries = saved(rows.groupBy("key", "sha").agg(first.alias("first"), F.count("*").alias("n")).select("key", "sha", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "n"), "dedup-entries")
    prefix = F.shiftrightunsigned("key", 64 - COUNTED_BITS).cast("int")
    counts = {r["p"]: r["n"] for r in entries.groupBy(prefix.alias("p")).agg(F.count("*").alias("n")).collect()}  # at most 2 ** COUNTED_BITS
    d = directory(counts, max(bucket_entries, 2 * sum(counts.values()) // BUCKETS))
    if d.depth == 0:
        placed = entries.withColumn("bucket", F.lit(0))
    else:
        slots = spark.createDataFrame(list(enumerate(d.slots)), "slot int, bucket int")  # at most 2 ** COUNTED_BITS rows
        placed = entries.withColumn("slot", F.shiftrightunsigned("key", 64 - d.depth).cast("int")).join(F.broadcast(slots), "slot").drop("slot")
    index = Index(rows, saved(placed.repartition(len(d.buckets), "bucket"), "dedup-index", partition_by="bucket"), d)
    dropped(entries)
    return index


_TEXT = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("sha", pa.binary()), ("text", pa.binary()), ("n", pa.int64())])
_OWNED = "bucket int, key long, sha binary, text binary, n long"


def _combined(d: Directory):
    """A map task's texts, each with its bucket by the directory. Equal texts are one row with their number: a bounded
    number of bytes is held at a time, and texts met again stay while there is room, so that a task sends a hot one once."""
    slots, shift = np.array(d.slots, dtype=np.int32), 64 - d.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0

        def flush(gone: list[bytes]) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(gone), 1024):
                some = [(t, *held.pop(t)) for t in gone[i : i + 1024]]
                buckets = [int(slots[(k % (1 << 64)) >> shift]) for _, k, _, _ in some]
                columns = buckets, [k for _, k, _, _ in some], [s for _, _, s, _ in some], [t for t, _, _, _ in some], [n for _, _, _, n in some]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _TEXT, strict=True)], schema=_TEXT)

        for batch in rows_of(batches, 512):
            for key, sha, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if text in held:
                    held[text][2] += 1
                else:
                    held[text] = [key, sha, 1]
                    size += len(text) + 200
            if size >= COMBINE_BYTES:
                again = [t for t, (_, _, n) in held.items() if n > 1]
                kept = sum(len(t) + 200 for t in again)
                if kept > COMBINE_BYTES // 2:
                    again, kept = [], 0
                yield from flush(list(held.keys() - set(again)))
                size = kept
        yield from flush(list(held))
        released()

    return run


_RESOLVED = "bucket int, key long, sha binary, keep_id {0}, keep_row long, group_size long"


def _owner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An owner's rows, sorted by bucket and key, entries before texts. The different texts of a key form a chain, told
    apart by their bytes; each link belongs to the entry with its digest, which the bucket must hold."""
    at, entries, chain = None, {}, []  # entries: sha -> (keep_id, keep_row); chain: [text, sha, n]

    def found() -> list[tuple]:
        if len({sha for _, sha, _ in chain}) < len(chain):
            raise RuntimeError("two different texts have one SHA-256")
        if any(sha not in entries for _, sha, _ in chain):
            raise RuntimeError(f"bucket {at[0]} has no entry for a text that the directory sent to it")
        return [(*at, sha, *entries[sha], n) for _, sha, n in chain]

    for batch in rows_of(batches, 256):
        out = []
        for bucket, key, sha, text, n, keep_id, keep_row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "key", "sha", "text", "n", "keep_id", "keep_row")), strict=True):
            if (bucket, key) != at:
                out += found() if at else []
                at, entries, chain = (bucket, key), {}, []
            if text is None:
                entries[sha] = keep_id, keep_row
                continue
            for link in chain:
                if link[0] == text:
                    link[2] += n
                    break
            else:
                chain.append([text, sha, n])
        if out:
            yield _answers(out, batch.schema.field("keep_id").type)
        kind = batch.schema.field("keep_id").type
    if at and (out := found()):
        yield _answers(out, kind)
    released()


def _answers(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.binary(), id_type, pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds, strict=True)], names=["bucket", "key", "sha", "keep_id", "keep_row", "group_size"])


def resolved(docs: DataFrame, index: Index, text_col: str = "text") -> DataFrame:
    """For each text of a key with more than one row: bucket, key, sha, keep_id, keep_row and group_size as its owner says."""
    contested = saved(index.entries.groupBy("key").agg(F.sum("n").alias("rows")).where("rows > 1").select("key"), "dedup-contested")
    few = small(contested)
    texts = modest_batches(docs).select(normalized(F.col(text_col)).alias("_text")).select(F.xxhash64("_text").alias("key"), F.unhex(F.sha2("_text", 256)).alias("sha"), F.col("_text").cast("binary").alias("text"))
    if few is contested:  # too many keys to broadcast: a hot text is combined before any shuffle
        texts = texts.mapInArrow(_combined(index.directory), _OWNED).join(contested, "key", "left_semi").select("bucket", "key", "sha", "text", "n")
    else:
        texts = texts.join(few, "key", "left_semi").mapInArrow(_combined(index.directory), _OWNED)
    entries = index.entries.join(few, "key", "left_semi").select("bucket", "key", "sha", F.lit(None).cast("binary").alias("text"), "n", "keep_id", "keep_row")
    kind = index.entries.schema["keep_id"].dataType
    rows = entries.unionByName(texts.withColumns({"keep_id": F.lit(None).cast(kind), "keep_row": F.lit(None).cast("long")}))
    owners = rows.repartition(min(len(index.directory.buckets), BUCKETS), "bucket").sortWithinPartitions("bucket", "key", F.col("text").isNotNull())
    return saved(owners.mapInArrow(_owner, _RESOLVED.format(kind.simpleString())), "dedup-resolved")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of docs: doc_id, keep_id, group_size, kept, text_sha256 (lowercase hex, of the normalized text).

    Null text: empty. Of equal texts the row with the smallest id stays, null ids last; among rows equal in id too, the
    first read. keep_id is null only if all ids of a group are. An empty table gives no rows; other columns aren't
    read."""
    index = build(docs, id_col, text_col)
    groups = resolved(docs, index, text_col)
    df = index.rows.join(small(groups), ["key", "sha"], "left")
    alone = F.col("keep_row").isNull()
    return df.select(
        F.col("doc_id").alias(id_col),
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    found = saved(dedup(docs, id_col, text_col).select(F.col(id_col).alias("_id"), "kept", "text_sha256"), "dedup-found")
    gone = saved(found.where("not kept").groupBy("_id", "text_sha256").agg(F.lit(1).alias("_gone")).select(null_key(F.col("_id")).alias("_key"), "text_sha256"), "dedup-gone")
    marked = docs.select(F.struct("*").alias("_doc"), null_key(F.col(id_col)).alias("_key"), F.sha2(normalized(F.col(text_col)), 256).alias("text_sha256"))
    rest = marked.join(small(gone), ["_key", "text_sha256"], "left_anti")
    # Rows equal in id and text, of which one stays: its pair is also among those that go.
    again = found.where("kept").select(null_key(F.col("_id")).alias("_key"), "text_sha256").join(gone, ["_key", "text_sha256"], "left_semi")
    again = saved(again, "dedup-again")
    if not again.isEmpty():
        one = marked.join(small(again), ["_key", "text_sha256"], "left_semi").dropDuplicates(["_key", "text_sha256"])
        rest = rest.unionByName(one)
    return rest.select("_doc.*")
