"""A store of observations on shared files: batches that appear whole or not at all, and a log of runs.

Its tables are listed by versions (see versions.py), each of which appears in one step:

log         normalized records
rejects     records that weren't taken, with the reason and without their values
runs        events of runs: started, errors, finished
contents, identities, hits   the folds of the log (see folds.py), which grow with each batch

A batch's records, rejects, figures and folds are one version, so a reader sees all of a batch or none, and an export
reads the folds and not the log. A batch is stored once: when it is run again nothing changes. One writer at a time
holds the store, under a lease that runs out if the writer dies."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import lru_cache
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as S

from ..functions import text as T, urls as U
from ..operators import folds, history, normalize
from ..shared import BROADCAST_ROWS, dropped, file_system, same_place, saved
from ..sources import config, registry
from . import export
from .versions import Versions

#: stream and place: where a record of a stream stands in it.
KEEP = ("seq", "run_id", "profile", "query", "location_searched", "position", "page_number", "search_url", "stream", "place")
RUN_EVENTS = "run_id string, at string, kind string, errors long, status string, reason string, source string, search_profile_id string, query string, location string, search_url string, requested_limit long, config string, processed long, rejected long"


def log_schema() -> S.StructType:
    texts = [*dict.fromkeys([*normalize.SNAPSHOT_FIELDS, "captured_at", "raw_json", "dedup_key", "content_hash", "written_at"])]
    longs = ("seq", "position", "page_number", "applicants_count", "place")
    return S.StructType([S.StructField(c, S.LongType() if c in longs else S.StringType()) for c in [*KEEP, *(t for t in texts if t not in KEEP)]])


def now_text() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


REJECTS = "seq long, run_id string, reason string, stream string, place long"
#: How many times smaller a fold's part is than the one before it; larger ones are merged into that.
TIER = 4


@dataclass(frozen=True)
class Counts:
    """What a batch brought: records stored and refused, and identities and contents that weren't there before."""

    processed: int
    rejected: int
    new_listings: int = 0
    new_contents: int = 0


@lru_cache(maxsize=1)
def log_columns() -> tuple[str, ...]:
    return tuple(f.name for f in log_schema())


def fold_rows(log: DataFrame) -> dict[str, tuple[folds.Fold, DataFrame]]:
    """The folds that a store keeps, and what each of them is over."""
    return {"contents": (folds.contents([*log_columns()]), log), "identities": (folds.IDENTITIES, log), "hits": (folds.HITS, hit_rows(log))}


class Store(Versions):
    """version: reads that version, whatever is written meanwhile; else the latest one at each call."""

    def __init__(self, spark: SparkSession, path: str, version: int | None = None):
        super().__init__(spark, path)
        self.version = version

    def exists(self) -> bool:
        return bool(self.state(self.version)["tables"]) or self._earlier_format()

    def _earlier_format(self) -> list[str]:
        """Folders of a store of the first format, which had no versions."""
        if self.state()["tables"]:
            return []
        fs, p = file_system(self.spark, f"{self.path}/log")
        return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith("batch=")) if fs.exists(p) else []

    def table(self, name: str, schema) -> DataFrame:
        """A table of the version; older parts with fewer columns have nulls."""
        parts = [p["folder"] if ":" in p["folder"] else f"{self.path}/{p['folder']}" for p in self.state(self.version)["tables"].get(name, [])]
        return self.spark.read.schema(schema).parquet(*parts) if parts else self.spark.createDataFrame([], schema)

    def log(self) -> DataFrame:
        """All observations of committed batches; none where nothing was stored yet."""
        found = self._earlier_format() if self.version is None else []
        return self.spark.read.schema(log_schema()).parquet(*found) if found else self.table("log", log_schema())

    def rejects(self) -> DataFrame:
        return self.table("rejects", REJECTS)

    def batches(self) -> DataFrame:
        """A row per batch: what it brought, and the version that it came with."""
        rows = [(name, b["version"], b["at"], b["processed"], b["rejected"], b["new_listings"], b["new_contents"]) for name, b in self.state(self.version)["batches"].items()]
        return self.spark.createDataFrame(rows, "batch string, version long, at string, processed long, rejected long, new_listings long, new_contents long")

    def fold(self, name: str) -> DataFrame:
        """The state of a fold: a row per key, from its parts and not from the log."""
        fold, rows = fold_rows(self.spark.createDataFrame([], log_schema()))[name]
        found = self._earlier_format() if self.version is None else []
        if found:
            fold, rows = fold_rows(self.log())[name]
            return fold.of(rows)
        return fold.merged(self.table(name, fold.of(rows).schema))

    def _written(self, df: DataFrame, table: str, *figures: Column) -> tuple[dict, dict]:
        """Writes a folder that no version names yet: how it is to be named, and figures of its rows, from the write itself."""
        folder, seen = self.new_folder(table), Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *figures).write.parquet(folder)
        return {"folder": folder.removeprefix(f"{self.path}/"), "rows": seen.get["rows"]}, seen.get

    def _folded(self, state: dict, log: DataFrame) -> tuple[dict, dict, dict]:
        """The parts that a batch adds to the folds, those that they replace, and how many of its keys are new. A part that isn't
        TIER times smaller than the one before it is merged with that, so there are few, and a row is rewritten few times."""
        add, remove, new = {}, {}, {}
        for name, (fold, rows) in fold_rows(log).items():
            schema, parts = fold.of(rows).schema, list(state["tables"].get(name, []))
            read = lambda found, schema=schema: self.spark.read.schema(schema).parquet(*(p["folder"] if ":" in p["folder"] else f"{self.path}/{p['folder']}" for p in found))
            part, _ = self._written(fold.of(rows), name)
            if not part["rows"]:
                continue
            if name != "hits":
                keys = [*fold.keys]
                fresh = read([part]).select(*keys)
                there = read(parts).select(*keys).join(F.broadcast(fresh) if part["rows"] <= BROADCAST_ROWS else fresh, keys, "left_semi").distinct().count() if parts else 0
                new[name] = part["rows"] - there
            merged, size = [], part["rows"]
            while parts and parts[-1]["rows"] < TIER * size:
                merged.append(parts.pop())
                size += merged[-1]["rows"]
            add[name] = [self._written(fold.merged(read([part, *merged])), name)[0] if merged else part]
            remove[name] = [p["folder"] for p in merged]
        return add, remove, new

    def adopted(self) -> None:
        """Brings a store of the first format under versions, as its first one: its folders stay where they are."""
        found = self._earlier_format()
        with self._held():
            if found and not self.state()["tables"]:
                log = self.spark.read.schema(log_schema()).parquet(*found)
                add, remove, _ = self._folded(self.state(), log)
                rows = {r["folder"]: (r["rows"], r["last"]) for r in log.groupBy(F.regexp_extract(F.input_file_name(), "(batch=[^/]*)/[^/]*$", 1).alias("folder")).agg(F.count("*").alias("rows"), F.max("seq").alias("last")).collect()}
                size = lambda f: rows.get(f.rsplit("/", 1)[-1], (0, None))[0]
                fs, p = file_system(self.spark, self.path)
                rest = {}
                for name in ("rejects", "runs"):
                    at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
                    if fs.exists(at):
                        rest[name] = [{"folder": s.getPath().toString(), "rows": 0} for s in fs.listStatus(at) if s.isDirectory()] if name == "rejects" else [{"folder": fs.makeQualified(at).toString(), "rows": 0}]
                last = max((v[1] for v in rows.values() if v[1] is not None), default=-1)
                self._commit({"add": add | rest | {"log": [{"folder": f, "rows": size(f)} for f in found]}, "remove": remove, "next_seq": last + 1})

    def append(self, records: DataFrame, batch: str, source: str | None = None, mark: dict | None = None) -> Counts:
        """Normalizes a batch of records (with seq and run_id) and commits it as one version, with `mark`, if any, noted in it.
        Records of another source than `source`, and those without a valid identity, are counted and listed as rejects; one bad
        record costs no other. What the records were written at is the batch's time. Their order is seq; where it doesn't go on from
        earlier batches it is moved behind them. Records without seq are taken in the order of their partitions. Markup isn't
        repeated in raw_json."""
        with self._held():
            self.adopted()
            state = self.state()
            done = state["batches"].get(batch)
            if done is not None:
                return Counts(done["processed"], done["rejected"], done["new_listings"], done["new_contents"])
            have = set(records.columns)
            other = F.coalesce(F.lower(T.text(F.col("source"))) != source, F.lit(True)) if source and "source" in have else F.lit(False)
            extra = {c: F.lit(None).cast("string") for c in KEEP if c not in have} | ({} if "seq" in have else {"seq": F.monotonically_increasing_id()})
            # Dealt anew: a few large blocks of input would leave most tasks without work, and a record costs far more than its way.
            dealt = records.withColumns(extra | {"_other": other}).hint("rebalance")
            rows = normalize.normalized(dealt, keep=(*KEEP, "_other"), include_raw=False)
            rows = rows.withColumn("reason", F.when(F.col("_other"), "another source").when(F.col("dedup_key").isNull(), "no valid identity"))
            rows = rows.withColumns({"written_at": F.lit(now_text()), "seq": F.col("seq").cast("long")})
            seen = Observation()
            of = [F.count("reason").alias("rejected"), F.count(F.lit(1)).alias("rows"), F.min("seq").alias("first"), F.max("seq").alias("last")]
            rows = saved(rows.observe(seen, *of), "batch")  # normalized once, then parted
            figures = seen.get
            shift = max(0, state["next_seq"] - (figures["first"] or 0))
            rows_moved = rows.withColumn("seq", F.col("seq") + F.lit(shift))
            add, remove, new, processed = {}, {}, {}, figures["rows"] - figures["rejected"]
            if figures["rejected"]:
                gone = rows_moved.where("reason is not null").select("seq", F.col("run_id").cast("string").alias("run_id"), "reason", F.col("stream").cast("string").alias("stream"), F.col("place").cast("long").alias("place"))
                add["rejects"] = [self._written(gone, "rejects")[0]]
            if processed:
                kept = rows_moved.where("reason is null").select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in log_schema()))
                part, _ = self._written(kept, "log")
                more, remove, new = self._folded(state, self.spark.read.schema(log_schema()).parquet(f"{self.path}/{part['folder']}"))
                add |= {"log": [part]} | more
            counts = Counts(processed, figures["rejected"], new.get("identities", 0), new.get("contents", 0))
            note = {"version": state["version"] + 1, "at": now_text(), "processed": counts.processed, "rejected": counts.rejected, "new_listings": counts.new_listings, "new_contents": counts.new_contents}
            self._commit({"add": add, "remove": remove, "batches": {batch: note}, "marks": mark or {}, "next_seq": (figures["last"] or 0) + shift + 1 if figures["rows"] else 0})
            dropped(rows)
            return counts

    def _event(self, run_id: str, kind: str, **values) -> None:
        row = {"run_id": run_id, "at": now_text(), "kind": kind} | values
        schema = self.spark.createDataFrame([], RUN_EVENTS).schema
        event = self.spark.createDataFrame([tuple(row.get(f.name) for f in schema)], schema).coalesce(1)
        with self._held():
            self._commit({"add": {"runs": [self._written(event, "runs")[0]]}})

    def start_run(self, options: dict) -> str:
        """Options under any of their names (config.run_options); returns the run's id."""
        o = config.run_options(options)
        run_id = o.pop("run_uuid") or str(uuid.uuid4())
        limit = o["requested_limit"]
        self._event(run_id, "started", **o | {"config": json.dumps(o["config"] or {}, sort_keys=True, ensure_ascii=False, default=str), "requested_limit": None if limit is None else int(limit)})
        return run_id

    def record_error(self, run_id: str, count: int = 1) -> None:
        self._event(run_id, "errors", errors=max(int(count), 0))

    def finish_run(self, run_id: str, reason: str, counts: Counts) -> None:
        self._event(run_id, "finished", reason=reason, processed=counts.processed, rejected=counts.rejected, errors=counts.rejected)

    def runs(self) -> DataFrame:
        """A row per run: what it was asked, when it began and ended, its errors and status (running until it has ended)."""
        return run_table(self.table("runs", RUN_EVENTS))

    def latest(self) -> DataFrame:
        """Each key's version to show, as history.latest() of the log, from the folds."""
        return folds.latest(self.fold("contents"), [*log_columns()])

    def listings(self, **filters) -> DataFrame:
        """The export query, from the folds."""
        contents = self.fold("contents").select(F.col("first_seq").alias("seq"))
        return export.listings(self.latest(), contents, **filters)

    def identities(self) -> DataFrame:
        return folds.IDENTITIES.values(self.fold("identities"))

    def hits(self) -> DataFrame:
        return folds.hit_values(self.fold("hits")).where("run_id is not null")

    def stats(self) -> DataFrame:
        """Rows of identities, contents, runs and hits."""
        return history.table_counts(unique_jobs=self.fold("identities"), snapshots=self.fold("contents"), search_runs=self.runs(), search_hits=self.hits())


def run_table(events: DataFrame) -> DataFrame:
    of = lambda kind: F.col("kind") == kind
    asked = [F.max(F.when(of("started"), F.col(c))).alias(c) for c in ("source", "search_profile_id", "query", "location", "search_url", "requested_limit", "config")]
    rows = events.groupBy("run_id").agg(
        *asked, F.min(F.when(of("started"), F.col("at"))).alias("started_at"), F.max(F.when(of("finished"), F.col("at"))).alias("finished_at"), F.max(F.when(of("finished"), F.col("reason"))).alias("close_reason"),
        F.coalesce(F.sum(F.greatest(F.col("errors"), F.lit(0))), F.lit(0)).cast("long").alias("error_count"), F.max("processed").alias("processed"),
    )
    status = F.when(F.col("finished_at").isNull(), "running").otherwise(history.run_status(F.col("error_count"), F.col("close_reason")))
    return rows.withColumns({"status": status, "search_url": U.canonicalize_url(F.col("search_url"))})


def hit_rows(log: DataFrame) -> DataFrame:
    return log.withColumns({"location": F.col("location_searched"), "hit_url": F.col("source_url"), "metadata": F.lit("{}"), "discovered_at": F.col("captured_at")})


@dataclass(frozen=True)
class RunResult:
    run_id: str
    processed: int
    rejected: int


def run_import(spark: SparkSession, source: str, store_path: str, path: str | None = None, max_results: int | None = None, **options) -> RunResult:
    """Brings a source's records into a store as one run. What stands before a bad record stays stored; the run then counts
    as failed, and an error without the record's values is raised."""
    found = registry.get(source)
    if found.requires_input:
        if not path:
            raise ValueError(f"source {source!r} needs an input")
        fs, p = file_system(spark, path)
        if not fs.exists(p):
            raise ValueError("the input must be an existing file")
    if max_results is not None and max_results < 1:
        raise ValueError("max_results must be positive")
    store = Store(spark, store_path)
    with store.writing(float(config.setting("writer_timeout"))):
        run_id = store.start_run(options | {"source": source, "max_results": max_results})
        failure, reason, counts = None, "finished", Counts(0, 0)
        try:
            if source == "jsonl":
                from ..sources import jsonl

                scanned = jsonl.scan(spark, path, run_id=run_id, max_results=max_results)
                records, reason = scanned.records, scanned.close_reason
                if scanned.bad_line is not None:
                    failure = ValueError(f"Invalid JSONL record on line {scanned.bad_line}")
                    store.record_error(run_id)
            else:
                records = registry.load(spark, source, run_id=run_id, **({"path": path} if path else {}))
                if max_results is not None:
                    records = records.orderBy("seq").limit(max_results)
            counts = store.append(records.withColumn("run_id", F.lit(run_id)), run_id, source)
        except Exception as error:
            failure, reason = error, "failed"
            store.record_error(run_id)
        store.finish_run(run_id, reason, counts)
    if failure is None and counts.rejected:
        failure = RuntimeError(f"source {source!r} had {counts.rejected} records that weren't taken")
    if failure is not None:
        raise failure
    return RunResult(run_id, counts.processed, counts.rejected)


def export_store(spark: SparkSession, store_path: str, output: str, format: str | None = None, **filters) -> int:
    """Writes the newest complete version of each identity of a store; returns the rows."""
    store = Store(spark, store_path)
    if not store.exists():
        raise FileNotFoundError(f"no store at {store_path}")
    return export.write(store.listings(**filters), output, format, (store_path,))


@dataclass(frozen=True)
class DemoResult:
    processed: int
    exported: int


def run_demo(spark: SparkSession, store_path: str, output: str) -> DemoResult:
    """The made-up records through a store into a JSON export."""
    if same_place(spark, output, store_path):
        raise ValueError("the demo's store and export need different paths")
    done = run_import(spark, "demo", store_path)
    return DemoResult(done.processed, export_store(spark, store_path, output, "json"))
