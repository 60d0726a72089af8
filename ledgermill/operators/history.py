"""Change tracking over an append-only log of observations.

Nothing is updated in place: identities, content versions, discovery hits and run figures are aggregates of the log in
arrival order (`seq`), each one shuffle by its key with map-side partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.text import instant
from ..shared import running_total


def first(c: str | Column, seq: str = "seq", where: Column | None = None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.min_by(c, F.when(where, F.col(seq)) if where is not None else F.col(seq))


def last(c: str | Column, seq: str = "seq", where: Column | None = None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.max_by(c, F.when(where, F.col(seq)) if where is not None else F.col(seq))


def first_known(c: str) -> Column:
    return first(c, where=F.col(c).isNotNull())


def last_known(c: str) -> Column:
    return last(c, where=F.col(c).isNotNull())


def is_complete() -> Column:
    return F.coalesce(F.col("capture_status") == "complete", F.lit(False))


def identities(log: DataFrame) -> DataFrame:
    """A row per key. first_seen_at is the first arrival's time, last_seen_at the greatest; the pointers follow arrival,
    and a partial observation never clears the complete one. updated_at: when the last arrival was written, if the log says
    so (written_at). job_id: rank by first arrival is left to numbered()."""
    written = [last("written_at").alias("updated_at")] if "written_at" in log.columns else []
    return log.groupBy("dedup_key").agg(
        F.min("seq").alias("first_seq"),
        first_known("source").alias("source"),
        first_known("source_job_id").alias("source_job_id"),
        last_known("canonical_url").alias("canonical_url"),
        first("captured_at").alias("first_seen_at"),
        F.max("captured_at").alias("last_seen_at"),
        first("run_id").alias("first_seen_run_id"),
        last_known("run_id").alias("last_seen_run_id"),
        last("content_hash").alias("latest_hash"),
        last("content_hash", where=is_complete()).alias("latest_complete_hash"),
        *written,
    )


def snapshots(log: DataFrame, *fields: str) -> DataFrame:
    """A row per key and content: the first observation of it, with its fields."""
    rest = [c for c in (fields or log.columns) if c not in ("dedup_key", "content_hash")]
    return log.groupBy("dedup_key", "content_hash").agg(first(F.struct(*rest)).alias("s")).select("dedup_key", "content_hash", "s.*")


def change_flags(log: DataFrame) -> DataFrame:
    """The log with new_job, new_snapshot and new_hit: whether the observation is the first of its key, content or hit."""
    def new(*keys: str) -> Column:
        return F.row_number().over(W.partitionBy(*keys).orderBy("seq")) == 1

    return log.withColumns({"new_job": new("dedup_key"), "new_snapshot": new("dedup_key", "content_hash"), "new_hit": new("run_id", "dedup_key", "profile", "query", "location")})


def hits(log: DataFrame) -> DataFrame:
    """A row per run, key, profile, query and location (missing ones are empty): content last seen, URLs last known, the
    smallest position, the page first known, metadata last not empty, when first discovered."""
    return log.groupBy("run_id", "dedup_key", *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("profile", "query", "location"))).agg(
        last("content_hash").alias("content_hash"),
        last_known("search_url").alias("search_url"),
        last_known("hit_url").alias("hit_url"),
        F.min("position").alias("position"),
        first_known("page_number").alias("page_number"),
        F.coalesce(last("metadata", where=F.col("metadata") != "{}"), first("metadata")).alias("metadata"),
        first("discovered_at").alias("discovered_at"),
    )


def run_counters(flagged: DataFrame) -> DataFrame:
    """From change_flags(): what each run discovered and stored."""
    n = lambda c: F.sum(c.cast("int")).cast("long")
    new_hit = n(F.col("new_hit"))
    return flagged.groupBy("run_id").agg(new_hit.alias("discovered"), new_hit.alias("hits"), n(F.col("new_job")).alias("new_jobs"), n(F.col("new_snapshot")).alias("new_snapshots"), n(~F.col("new_snapshot")).alias("duplicate_snapshots"))


def run_status(errors: Column, reason: Column) -> Column:
    return F.when(errors > 0, "failed").when(reason == "finished", "finished").otherwise("stopped")


def run_errors(events: DataFrame) -> DataFrame:
    """events: (run_id, errors), negatives count 0."""
    return events.groupBy("run_id").agg(F.sum(F.greatest(F.col("errors"), F.lit(0))).cast("long").alias("errors"))


def newest(versions: DataFrame, key: str = "dedup_key", complete_only: bool = False) -> DataFrame:
    """The version of each key with the greatest captured_at, then seq; another order than the pointers' arrival."""
    rows = versions.where(is_complete()) if complete_only else versions
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.struct("captured_at", "seq")).alias("v")).select(key, "v.*")


def latest(log: DataFrame) -> DataFrame:
    """Each key's version to show: the content that arrived last complete, else the one that arrived last, as it was first
    observed (a content seen again keeps its first capture); with first_seq, first_seen_at and last_seen_at. Contents are
    folded first, then keys: two aggregations that combine map-side."""
    rest = [c for c in log.columns if c not in ("dedup_key", "content_hash")]
    contents = log.groupBy("dedup_key", "content_hash").agg(
        first(F.struct(*rest)).alias("v"), F.min("seq").alias("first_seq"), F.max("seq").alias("at"), F.max(F.when(is_complete(), F.col("seq"))).alias("complete_at"), F.max("captured_at").alias("seen")
    )
    return shown(contents)


def shown(contents: DataFrame) -> DataFrame:
    """The version of each key that latest() shows, from its contents: a row per key and content with v, its first observation,
    and when it came first, last and last complete."""
    row = F.struct("content_hash", "v")
    shown = F.coalesce(last(row, "complete_at", F.col("complete_at").isNotNull()), last(row, "at"))
    found = contents.groupBy("dedup_key").agg(F.min("first_seq").alias("first_seq"), first("v.captured_at", "first_seq").alias("first_seen_at"), F.max("seen").alias("last_seen_at"), shown.alias("r"))
    return found.select("dedup_key", "first_seq", "first_seen_at", "last_seen_at", "r.content_hash", "r.v.*")


def latest_by_pointer(jobs: DataFrame, versions: DataFrame) -> DataFrame:
    """The same from derived tables: an inner join on the pointer, the latest complete one if there is any."""
    pointed = jobs.withColumn("content_hash", F.coalesce("latest_complete_hash", "latest_hash"))
    return pointed.drop("source", "source_job_id", "canonical_url").join(versions, ["dedup_key", "content_hash"])


def full(strict_url: bool = False) -> Column:
    """Complete, with company, title, description and a URL. strict_url: a blank source_url hides canonical_url."""
    said = lambda c: F.length(F.trim(F.coalesce(c, F.lit("")))) > 0
    url = F.coalesce(F.trim("source_url"), F.trim("canonical_url"), F.lit("")) != "" if strict_url else said(F.coalesce("source_url", "canonical_url"))
    return is_complete() & said(F.col("company")) & said(F.col("title")) & said(F.col("description")) & url


def since(c: Column, value: str) -> Column:
    """Whether the instant of an ISO text is at or after value's; unreadable ones aren't."""
    return F.coalesce(instant(c) >= F.lit(value).cast("timestamp"), F.lit(False))


def numbers(places: DataFrame, order: str, name: str) -> DataFrame:
    """(order, name): the distinct values of a narrow table with their ranks from 1. No task sees all rows."""
    return running_total(places.select(order).where(F.col(order).isNotNull()).distinct().withColumn("_one", F.lit(1)), order, "_one", name).drop("_one")


def numbered(df: DataFrame, order: str = "first_seq", name: str = "job_id") -> DataFrame:
    """df with a dense number by first arrival; rows of one place have one number, those without a place none."""
    return df.join(numbers(df, order, name), order, "left").select(*df.columns, name)


def table_counts(**tables: DataFrame) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def growth(observed: DataFrame, key: str, round_col: str) -> DataFrame:
    """Per round: keys first seen in it, and all seen so far."""
    new = observed.groupBy(key).agg(F.min(round_col).alias(round_col)).groupBy(round_col).agg(F.count("*").alias("new_keys"))
    rounds = observed.select(round_col).distinct().join(new, round_col, "left").withColumn("new_keys", F.coalesce("new_keys", F.lit(0)).cast("long"))
    return running_total(rounds, round_col, "new_keys", "seen")


def stagnation(rounds: DataFrame, session: str, round_col: str, new: str = "new_keys") -> DataFrame:
    """Rounds of each session with `stagnant`: how many rounds without growth in a row end there (a diagnostic: it stops nothing)."""
    so_far = W.partitionBy(session).orderBy(round_col).rowsBetween(W.unboundedPreceding, W.currentRow)
    islands = rounds.withColumn("_island", F.sum((F.col(new) > 0).cast("int")).over(so_far))
    inside = W.partitionBy(session, "_island").orderBy(round_col).rowsBetween(W.unboundedPreceding, W.currentRow)
    return islands.withColumn("stagnant", F.sum((F.col(new) <= 0).cast("long")).over(inside)).drop("_island")
