"""Old identities as they were when a record came: an ordered fold over narrow events."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..shared import saved, small

_RECORD, _LEAVES, _COMES = 0, 1, 2
_NAMES = ("source", "who", "seq", "dedup_key")


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events sorted by (source, who, seq, kind) -> the records that an older identity takes, with its key. What is held is the older
    identities that a value leads to at one time."""
    at, there, settled = None, {}, False
    for b in batches:
        out = []
        for source, who, seq, kind, key, born in zip(*(c.to_pylist() for c in b.columns)):
            if (source, who) != at:
                at, there, settled = (source, who), {}, False
            if kind == _COMES:
                there[key] = born
            elif kind == _LEAVES:
                there.pop(key, None)
            elif there and not settled:
                out.append((source, who, seq, min(there, key=lambda k: (there[k], k))))
            else:
                settled = True  # the default identity exists from here on, and is the exact match
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64() if i == 2 else pa.string()) for i in range(4)], names=_NAMES)


def resolved_keys(log: DataFrame, default: str = "default_key") -> DataFrame:
    """The log with old default keys kept for their records. log has dedup_key, default_key, source, source_job_id, canonical_url
    and seq.

    A record whose key is its default one goes to an older identity of its source, if there is one and no identity with the default
    key yet: for a record with an id, one that has this id (its first known) and whose key is source:ID or source:http...; for one
    without, one that has no id so far, whose URL (its last known) is the record's, and whose key is source:http.... Of several, the
    one that came first. Other keys stay as they are.

    An identity's URL and id change as its records come, so each change is an event in the order of arrival beside the records
    that look for it, under the id or URL that they look for. Only values that an older identity ever had are folded, and a task
    holds no more than the identities that one value leads to. Records of one place count as if the record came first."""
    own = F.col("dedup_key") == F.col(default)
    prefix = F.concat("source", F.lit(":"))
    modern = F.startswith("dedup_key", F.concat(prefix, F.lit("id:"))) | F.startswith("dedup_key", F.concat(prefix, F.lit("url:")))
    older = log.where(~own & ~modern & F.startswith("dedup_key", prefix)).select("source", "dedup_key", "seq", "source_job_id", "canonical_url")
    key, in_order = W.partitionBy("source", "dedup_key"), W.partitionBy("source", "dedup_key").orderBy("seq")
    of_id = F.min(F.when(F.col("source_job_id").isNotNull(), F.struct("seq", "source_job_id"))).over(key)
    older = older.withColumns({"born": F.min("seq").over(key), "id": of_id, "by_url": F.coalesce(F.col("dedup_key").rlike("^[^:]*:https?://"), F.lit(False))})
    older = saved(older, "older-identities")
    with_id = older.where(F.col("id").isNotNull() & (F.col("by_url") | (F.col("dedup_key") == F.concat(prefix, F.col("id.source_job_id")))))
    event = lambda who, seq, kind: [F.col("source"), who.alias("who"), seq.alias("seq"), F.lit(kind).alias("kind"), F.col("dedup_key"), F.col("born")]
    ids = with_id.where(F.col("seq") == F.col("id.seq")).select(*event(F.concat(F.lit("i"), "id.source_job_id"), F.col("seq"), _COMES))
    before = older.where(F.col("by_url") & F.col("canonical_url").isNotNull() & (F.col("id").isNull() | (F.col("seq") < F.col("id.seq"))))
    changes = before.withColumn("was", F.lag("canonical_url").over(in_order)).where(F.col("was").isNull() | (F.col("was") != F.col("canonical_url")))
    changes = changes.withColumn("until", F.least(F.lead("seq").over(in_order), F.col("id.seq")))
    url = F.concat(F.lit("u"), "canonical_url")
    comes, leaves = changes.select(*event(url, F.col("seq"), _COMES)), changes.where("until is not null").select(*event(url, F.col("until"), _LEAVES))
    events = saved(ids.unionByName(comes).unionByName(leaves), "identity-events")
    who = F.coalesce(F.concat(F.lit("i"), "source_job_id"), F.concat(F.lit("u"), "canonical_url"))
    asked = log.where(own).select("source", who.alias("who"), F.col("seq").cast("long").alias("seq"), F.lit(_RECORD).alias("kind"), F.lit(None).cast("string").alias("dedup_key"), F.lit(None).cast("long").alias("born"))
    asked = asked.join(small(events.select("source", "who").distinct()), ["source", "who"], "left_semi")
    rows = events.withColumns({"seq": F.col("seq").cast("long"), "born": F.col("born").cast("long")}).unionByName(asked).select("source", "who", "seq", "kind", "dedup_key", "born")
    dealt = rows.repartition("source", "who").sortWithinPartitions("source", "who", "seq", "kind", "born", "dedup_key")
    found = saved(dealt.mapInArrow(_resolved, "source string, who string, seq long, dedup_key string"), "identity-resolved")
    found = found.select(F.col("source").alias("_source"), F.col("who").alias("_who"), F.col("seq").alias("_seq"), F.col("dedup_key").alias("_older"))
    same = own & (F.col("source") == F.col("_source")) & (who == F.col("_who")) & (F.col("seq") == F.col("_seq"))
    return log.join(small(found.distinct()), same, "left").withColumn("dedup_key", F.coalesce("_older", "dedup_key")).select(*log.columns)
