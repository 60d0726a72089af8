"""The export query and its sinks."""

from __future__ import annotations

import csv
import io
import uuid
from datetime import date, datetime, timezone
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions import classify, text as T
from ..operators import history
from ..shared import file_system, renamed, same_place, saved, small

#: Columns of an export, in order: fixed values.
EXPORT_FIELDS = (
    "job_id", "snapshot_id", "dedup_key", "content_hash", "source", "source_job_id", "source_url", "canonical_url", "apply_url", "company", "company_url",
    "company_logo_url", "title", "location", "workplace_type", "employment_type", "seniority_level", "job_function", "industries", "posted_at", "valid_through",
    "salary_min", "salary_max", "salary_currency", "salary_interval", "salary_text", "description", "description_html", "applicants", "applicants_count",
    "capture_status", "captured_at", "first_seen_at", "last_seen_at",
)
#: Tracker columns in English and Russian: fixed values.
TRACKER = {
    "ID": "ID", "Company": "Компания", "Role": "Вакансия", "URL": "Ссылка", "Location": "Локация", "Workplace": "Формат", "Employment type": "Тип занятости",
    "Salary / currency": "Вилка / валюта", "Target USD / month": "Запрос USD/мес", "Fit": "Fit", "Priority": "Приоритет", "Status": "Статус", "Added": "Добавлена",
    "Applied": "Отклик", "Next step": "Следующий шаг", "Follow-up": "Follow-up", "Review date": "Контроль", "CV / materials": "CV / материалы",
    "Key requirements": "Ключевые требования", "Strong matches": "Сильные совпадения", "Gaps / risks": "Пробелы / риски", "CV changes": "Изменения CV",
    "Notes": "Заметки", "Outreach / contact": "Outreach / контакт", "Last updated": "Последнее обновление", "Outcome / reason": "Результат / причина",
}
FORMATS = ("jsonl", "json", "csv", "tracker-csv", "tracker-csv-ru")


def since_text(value: str | date | datetime) -> str:
    """A since filter in UTC; a date or time without offset is UTC."""
    if isinstance(value, str):
        if not value.strip():
            raise ValueError("since cannot be empty")
        try:
            value = datetime.fromisoformat(value.strip().replace("Z", "+00:00"))
        except ValueError:
            raise ValueError("since must be an ISO date or datetime, for example 2026-08-01") from None
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    value = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def format_of(name: str | None, path: str) -> str:
    """By name (any case, '_' as '-'; tracker and sheet are tracker-csv) or else by suffix, else jsonl."""
    found = name.strip().lower().replace("_", "-") if name else PurePosixPath(path).suffix.lower().lstrip(".")
    found = {"tracker": "tracker-csv", "sheet": "tracker-csv"}.get(found, found)
    if found not in FORMATS:
        if name:
            raise ValueError(f"unsupported export format: {name!r}")
        return "jsonl"
    return found


def latest_listings(log: DataFrame, **filters) -> DataFrame:
    """The query over a log: each key's version to show, see listings()."""
    contents = log.groupBy("dedup_key", "content_hash").agg(F.min("seq").alias("seq"))
    return listings(history.latest(log), contents, **filters)


def listings(shown: DataFrame, contents: DataFrame, since: str | date | datetime | None = None, complete_only: bool = False, limit: int | None = None, include_raw: bool = False) -> DataFrame:
    """Each key's version to show (history.shown()), newest first by text order, with EXPORT_FIELDS. Numbers are ranks of first
    arrival: job_id of keys, snapshot_id of contents (their first places as seq)."""
    if limit is not None and limit < 0:
        raise ValueError("limit must not be negative")
    rows = history.numbered(shown)
    rows = rows.join(history.numbers(contents, "seq", "snapshot_id"), "seq")
    if since is not None:
        rows = rows.where(history.since(F.col("last_seen_at"), since_text(since)))
    if complete_only:
        rows = rows.where(history.full(strict_url=True))
    rows = rows.withColumns({"source_url": F.coalesce("source_url", "canonical_url"), "industries": T.decode_json(F.col("industries_json")), "job_function": T.decode_json(F.col("job_function"))})
    rows = rows.orderBy(F.desc("last_seen_at"), F.desc("captured_at"), F.desc("job_id"))
    if limit is not None:
        rows = rows.limit(limit)
    return rows.select(*EXPORT_FIELDS, *(["raw_json"] if include_raw else []))


def json_lines(rows: DataFrame) -> Column:
    """A row as compact JSON with nulls; amounts as numbers where they are, industries as their JSON."""
    def token(c: str) -> Column:
        if c in ("salary_min", "salary_max"):
            return F.coalesce(T.json_number(F.col(c)), F.lit("null"))
        if c in ("industries", "job_function", "raw_json"):
            return F.coalesce(F.when(F.try_parse_json(c).isNotNull(), F.col(c)), T.quoted(F.col(c)), F.lit("null"))
        if dict(rows.dtypes)[c] != "string":
            return F.coalesce(F.col(c).cast("string"), F.lit("null"))
        return F.when(F.col(c).isNull(), "null").otherwise(T.quoted(F.col(c)))

    return F.concat(F.lit("{"), F.concat_ws(",", *(F.concat(F.lit(f'"{c}":'), token(c)) for c in rows.columns)), F.lit("}"))


def tracker(rows: DataFrame, language: str = "en") -> DataFrame:
    """26 columns of an application tracker, under English or Russian headers; amounts and dates as people read them."""
    values = {
        "ID": F.coalesce("source_job_id", "dedup_key"), "Company": F.col("company"), "Role": F.col("title"), "URL": F.coalesce("source_url", "canonical_url"), "Location": F.col("location"),
        "Workplace": classify.display(F.col("workplace_type"), classify.WORKPLACE_NAMES[language]), "Employment type": classify.display(F.col("employment_type"), classify.EMPLOYMENT_NAMES[language]),
        "Salary / currency": T.salary_label(F.col("salary_min"), F.col("salary_max"), F.col("salary_currency"), F.col("salary_interval"), F.col("salary_text"), language),
        "Status": F.lit("Новая" if language == "ru" else "New"), "Added": T.date_part(T.first_value(F.col("first_seen_at"), F.col("captured_at"))), "Last updated": T.date_part(T.first_value(F.col("last_seen_at"), F.col("captured_at"))),
    }
    return rows.select(*(T.csv_safe_cell(values.get(en, F.lit(""))).alias(ru if language == "ru" else en) for en, ru in TRACKER.items()))


def _csv(rows: DataFrame, path: str) -> str:
    """Writes the cells of rows as part files; the header line."""
    cells = rows.select(*(T.csv_safe_cell(F.col(c)).alias(c) for c in rows.columns))
    cells.write.options(header=False, escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, lineSep="\n").csv(path)
    header = io.StringIO()
    csv.writer(header, lineterminator="\n").writerow(rows.columns)
    return header.getvalue()


def joined(spark: SparkSession, head: str, folder: str, output: str) -> None:
    """One file of a first text and the part files of a folder in their order, put in the place of output at once. The parts are
    joined by the file system where it can (no byte is moved), else they are copied one behind the other, in blocks."""
    jvm = spark._jvm
    fs, stage = file_system(spark, f"{folder}/joined")
    parts = sorted((s.getPath() for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*"))), key=lambda p: p.getName())
    out = fs.create(stage, True)
    try:
        out.write(bytearray(head.encode()))
        if fs.getUri().getScheme() != "hdfs":
            for part in parts:
                source = fs.open(part)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
                finally:
                    source.close()
    finally:
        out.close()
    if fs.getUri().getScheme() == "hdfs" and parts:
        full = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
        for i, part in enumerate(parts):
            full[i] = part
        fs.concat(stage, full)
    renamed(spark, stage.toString(), output)


def write(rows: DataFrame, output: str, format: str | None = None, inputs: tuple[str, ...] = ()) -> int:
    """Writes an export as one file and returns its rows. Every task writes its part of the rows, in their order; the parts are then
    joined beside the output and put in its place, so a failure leaves an earlier one as it was."""
    kind, spark = format_of(format, output), rows.sparkSession
    if any(same_place(spark, output, i) for i in inputs):
        raise ValueError("the output would overwrite an input")
    rows = rows.persist()
    stage = f"{output.rpartition('/')[0] or '.'}/.staged-{uuid.uuid4().hex}"
    fs, staged = file_system(spark, stage)
    try:
        place = F.monotonically_increasing_id()
        n, last = rows.select(place.alias("i")).agg(F.count("*"), F.max("i")).first()
        if kind in ("jsonl", "json"):
            lines = rows.select(json_lines(rows).alias("value"))
            if kind == "json":
                end = F.when(F.col("i") == last, "\n]").otherwise(",") if n else F.lit("")
                lines = lines.withColumn("i", place).select(F.concat("value", end).alias("value"))
            lines.write.text(stage)
            head = "" if kind == "jsonl" else "[\n" if n else "[\n\n]\n"
        elif kind == "csv":
            head = _csv(rows, stage)
        else:
            head = _csv(tracker(rows, "ru" if kind.endswith("ru") else "en"), stage)
        joined(spark, head, stage, output)
        return n
    finally:
        fs.delete(staged, True)
        rows.unpersist()


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a JSON export. It has an object a line, so all tasks read it, where a multi-line reader is one task; a line that is
    neither a row nor a bracket is an error."""
    lines = spark.read.option("lineSep", "\n").text(path).where("value NOT IN ('[', ']', '')")
    row = F.when(F.endswith("value", F.lit(",")), F.substring("value", F.lit(1), F.length("value") - 1)).otherwise(F.col("value"))
    return lines.select(F.from_json(row, schema, {"mode": "FAILFAST"}).alias("row")).select("row.*")


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The rows of a CSV export as text, by its columns. A multi-line reader is one task for a file; here each task puts the records of
    its block of the file together, whose cells may hold line ends: a line goes on with a record if the quotes before it are odd in
    number. Quotes are counted by block first. Only records that go over the edge of a block are joined across tasks."""
    read = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    odd = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    rows = saved(read.withColumn("quotes", odd), "csv-lines")  # read once: a second scan could cut the file otherwise
    blocks = saved(rows.groupBy("start").agg(F.sum("quotes").alias("all")), "csv-blocks")  # a row per block
    before = blocks.select("start", (F.sum("all").over(W.orderBy("start")) - F.col("all")).alias("before"))
    block = W.partitionBy("start").orderBy("at")
    lines = rows.join(small(before), "start").withColumn("inside", (F.col("before") + F.sum("quotes").over(block.rowsBetween(W.unboundedPreceding, 0)) - F.col("quotes")) % 2)
    lines = lines.withColumn("record", F.sum(1 - F.col("inside")).over(block.rowsBetween(W.unboundedPreceding, 0)))  # 0: begun before
    texts = F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda line: line["value"])
    pieces = lines.groupBy("start", "record").agg(F.array_join(texts, "\n").alias("text"))
    pieces = saved(pieces.withColumn("edge", F.col("record").isin(0, 1) | (F.col("record") == F.max("record").over(W.partitionBy("start")))), "csv-pieces")
    edges = pieces.where("edge").withColumn("n", F.sum(F.when(F.col("record") > 0, 1).otherwise(0)).over(W.orderBy("start", "record")))  # three a block at most
    joined_up = edges.groupBy("n").agg(F.array_sort(F.collect_list(F.struct("start", "record", "text"))).alias("of")).where("n > 1")  # 1: the header
    joined_up = joined_up.select(F.array_join(F.transform("of", lambda piece: piece["text"]), "\n").alias("text"))
    options = {"mode": "FAILFAST", "multiLine": "true", "escape": '"', "lineSep": "\n", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    found = pieces.where("NOT edge").select("text").unionByName(joined_up)
    return found.select(F.from_csv("text", ", ".join(f"`{c}` string" for c in columns), options).alias("row")).select("row.*")
