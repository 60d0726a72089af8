"""Helpers shared by the operators: tables, and what Arrow batches and Python workers hold."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..shared import BROADCAST_ROWS, alone, dropped, modest_batches, released, saved, shared_dir, small  # noqa: F401  (the operators take them from here)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def null_key(c: Column) -> Column:
    """A string that equals another's exactly when both are null or both are the same value."""
    return F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), c.cast("string")))


def rows_of(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most `size` rows."""
    for b in batches:
        for i in range(0, b.num_rows, size):
            yield b.slice(i, size)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
