"""JSON Lines in: one object per line, an explicit schema, whole prefix semantics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as S

from ..functions.text import text
from ..operators import normalize
from ..shared import saved, small

FIELDS = sorted({a for names in normalize.ALIASES.values() for a in names} | {"capture_status", "dedup_key", "raw_json", "raw", "source", "search_url", "page_number"})
SCHEMA = S.StructType([S.StructField(f, S.StringType()) for f in FIELDS])


@dataclass
class Scan:
    """records: the valid lines up to the first bad one; bad_line: its number, or None."""

    records: DataFrame
    bad_line: int | None

    @property
    def close_reason(self) -> str:
        return "finished" if self.bad_line is None else "invalid_input"

    def check(self) -> None:
        """Raises on a bad line, without its values."""
        if self.bad_line is not None:
            raise ValueError(f"Invalid JSONL record on line {self.bad_line}")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """_numbered() without blank lines."""
    return _numbered(spark, path).where(text(F.col("value")).isNotNull())


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """(line, value): physical line numbers from 1. A file's lines are numbered in its own order, and
    files in the order of their paths. The files are read once, and written with each line's place in its block; the blocks
    (a row each) are then numbered apart. How files are cut depends on the task slots of the moment, so a second scan could
    cut them otherwise."""
    read = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    rows = saved(read, "jsonl-lines")
    blocks = saved(rows.groupBy("file", "start").agg(F.count("*").alias("n"), F.min("at").alias("first")), "jsonl-blocks")
    before = blocks.withColumn("before", F.sum("n").over(W.orderBy("file", "start")) - F.col("n")).drop("n")
    return rows.join(small(before), ["file", "start"]).select((F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), "value")


def _valid(raw: DataFrame, source: str, max_results: int | None) -> tuple[DataFrame, DataFrame, int | None]:
    """The lines parsed; the valid ones up to the first bad one or the limit (all: the same table); the bad one's number."""
    parsed = raw.withColumn("r", F.from_json("value", SCHEMA)).withColumn("is_object", F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False)))
    rows = parsed.select("line", "value", "is_object", *(F.col(f"r.{f}").alias(f) for f in FIELDS if f not in ("dedup_key", "source")))
    rows = rows.withColumns({"source": F.lit(source), "capture_status": F.coalesce("capture_status", F.lit("complete"))})
    rows = rows.withColumn("bad", F.when(~F.col("is_object"), F.lit("not an object")).otherwise(normalize.problem(rows)))
    rows = saved(rows, "jsonl-rows")  # read twice: for the first bad line, and as records
    first_bad = rows.where("bad is not null").agg(F.min("line")).first()[0]
    good = rows if first_bad is None else rows.where(F.col("line") < first_bad)
    if max_results is not None:  # a limit is the driver's own small number of rows
        last = good.orderBy("line").limit(max_results).agg(F.max("line"), F.count("*")).first()
        if last[1] == max_results:
            return rows, rows.where(F.col("line") <= last[0]), None
    return rows, good, first_bad


#: Lines that a scan parses first: where it stops among them, the others aren't parsed.
HEAD_LINES = 10_000


def scan(spark: SparkSession, path: str, source: str = "jsonl", profile: str = "local_import", run_id: str = "run", now: Column | None = None, max_results: int | None = None) -> Scan:
    """Records of a file as the source's own: identities and hashes in them don't count, run and rank are set. Lines after
    the first bad one, or after max_results valid ones, aren't looked at."""
    if max_results is not None and max_results < 1:
        raise ValueError("max_results must be positive")
    numbered = _numbered(spark, path)
    raw = numbered.where(text(F.col("value")).isNotNull())
    head = numbered.where(F.when(F.col("line") <= HEAD_LINES, text(F.col("value"))).isNotNull())  # one condition: only these are looked into
    rows, good, first_bad = _valid(head, source, max_results)
    if first_bad is None and good is rows:  # neither a bad line nor the limit: on to the rest
        rows, good, first_bad = _valid(raw, source, max_results)
    ranked = good.withColumn("seq", F.col("line")).withColumn("search_rank", F.row_number().over(W.partitionBy(F.lit(1)).orderBy("line"))) if max_results is not None else good.withColumn("seq", F.col("line")).withColumn("search_rank", F.col("line"))
    out = ranked.drop("bad", "is_object", "line").withColumns({"raw": F.col("value"), "run_id": F.lit(run_id), "search_profile_id": F.lit(profile), "captured_at": F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss'Z'")}).drop("value")
    return Scan(normalize.downgraded(out), first_bad)
