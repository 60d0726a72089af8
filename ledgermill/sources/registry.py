"""Sources by name: callables that return records. A source can't be replaced silently, and must yield its own records."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, is_dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F, types as S

from ..functions import text as T

_SLUG = re.compile(r"^[a-z0-9][a-z0-9_-]*$")


@dataclass(frozen=True)
class Source:
    slug: str
    description: str
    load: Callable[..., DataFrame]
    requires_input: bool = False


_sources: dict[str, Source] = {}


def register(source: Source) -> None:
    if not _SLUG.match(source.slug):
        raise ValueError(f"not a source name: {source.slug!r}")
    if source.slug in _sources:
        raise ValueError(f"source {source.slug!r} is registered already")
    if not callable(source.load):
        raise TypeError("a source needs a callable")
    _sources[source.slug] = source


def get(slug: str) -> Source:
    if slug not in _sources:
        raise KeyError(f"unknown source {slug!r}; there are: {', '.join(sorted(_sources))}")
    return _sources[slug]


def listed() -> list[Source]:
    return [_sources[s] for s in sorted(_sources)]


def load(spark: SparkSession, slug: str, **options) -> DataFrame:
    source = get(slug)
    if source.requires_input and not options.get("path"):
        raise ValueError(f"source {slug!r} needs a path")
    records = source.load(spark, **options)
    if not isinstance(records, DataFrame) or "source" not in records.columns:
        raise TypeError(f"source {slug!r} must yield a table of records with their source")
    claimed = F.coalesce(F.lower(T.text(F.col("source"))), F.lit(""))
    if not records.where(claimed != slug).isEmpty():
        raise ValueError(f"source {slug!r} yields records of another source")
    return records


def records_of(spark: SparkSession, items) -> DataFrame:
    """Items of any kind (mappings, dataclasses, objects with model_dump() or dict(), pairs) as a table of texts; what isn't
    a text, a number or a boolean becomes JSON."""

    def mapping(item) -> dict:
        if isinstance(item, Mapping):
            return dict(item)
        if is_dataclass(item) and not isinstance(item, type):
            return asdict(item)
        for method in ("model_dump", "dict"):
            if callable(getattr(item, method, None)):
                return dict(getattr(item, method)())
        try:
            return dict(item)
        except (TypeError, ValueError):
            raise TypeError(f"not a record: {type(item).__name__}") from None

    def said(value):
        if value is None or isinstance(value, str):
            return value
        return str(value) if isinstance(value, (int, float, Decimal, date)) and not isinstance(value, bool) else json.dumps(value, sort_keys=True, ensure_ascii=False, default=str)

    rows = [mapping(i) for i in items]
    names = sorted({k for r in rows for k in r} - {"seq"} | {"source"})  # seq is the item's place
    return spark.createDataFrame([(k + 1, *(said(r.get(n)) for n in names)) for k, r in enumerate(rows)], S.StructType([S.StructField("seq", S.LongType()), *(S.StructField(n, S.StringType()) for n in names)]))


def _jsonl(spark: SparkSession, path: str, **options) -> DataFrame:
    from .jsonl import scan

    found = scan(spark, path, **options)
    found.check()
    return found.records


DEMO = [
    {"source_job_id": "sample-1", "source_url": "https://example.com/listings/1", "company": "Sample Systems", "title": "Data Engineer", "description": "Builds pipelines.", "workplace_type": "remote", "salary_min": "90000", "salary_max": "120000", "salary_currency": "USD", "salary_interval": "year"},
    {"source_job_id": "sample-2", "source_url": "https://example.com/listings/2", "company": "Sample Studio", "title": "Analyst", "description": "Reads tables.", "workplace_type": "hybrid"},
    {"source_job_id": "sample-3", "source_url": "https://example.com/listings/3", "company": "Sample Labs", "title": "Tester", "description": "Breaks things.", "workplace_type": "on-site"},
    {"source_job_id": "sample-1", "source_url": "https://example.com/listings/1", "company": "Sample Systems", "title": "Data Engineer", "description": "Builds pipelines.", "workplace_type": "remote", "salary_min": "90000", "salary_max": "120000", "salary_currency": "USD", "salary_interval": "year"},
]


def _demo(spark: SparkSession, run_id: str = "demo", **_) -> DataFrame:
    names = sorted({k for r in DEMO for k in r})
    rows = [(i + 1, run_id, "demo", *(r.get(n) for n in names)) for i, r in enumerate(DEMO)]
    return spark.createDataFrame(rows, "seq long, run_id string, source string, " + ", ".join(f"{n} string" for n in names))


register(Source("jsonl", "records from JSON Lines", _jsonl, requires_input=True))
register(Source("demo", "four made-up records, one of them twice", _demo))
