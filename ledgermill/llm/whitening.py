"""Whitening of embeddings by Spark MLlib's singular values of the centred rows.

Entries become whole numbers x = floor(256 * c). The fit list is each distinct vector once. Its sums are exact, its centred
rows are a distributed RowMatrix, and the eigenvectors of the covariance are that matrix's right singular vectors; an
eigenvalue is the square of a singular value over the number of vectors. The total variance doesn't come from the singular
values but from the exact deviations of the vectors from their mean."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, functions as F

from .common import modest_batches, saved

SCALE, COMPONENTS = 256, 4
#: Singular values below this part of the largest are taken for 0: their components don't exist.
LEAST_SINGULAR = 1e-7
_LONGEST = (1 << 63) - 1


def whole_numbers(c: Column) -> Column:
    """An array as longs floor(256 * entry), or null if it is null or empty or holds an entry that is null or not finite."""
    finite = F.forall(c, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    return F.when(finite & (F.size(c) > 0), F.transform(c, lambda v: F.floor(v.cast("double") * SCALE) + F.lit(0)))


@dataclass
class Whitening:
    """What a fit found: n vectors, their sums by dimension, components as columns with falling eigenvalues, the trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.eigenvalues]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.vectors / np.sqrt(self.eigenvalues)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n with one rounding of the mean's whole part and rest: large means cost no digits."""
    whole, rest = np.array([s // n for s in sums]), np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """The exact sum of (n * x - S)^2 of each row: in 64 bits where nothing can pass them, else in Python's integers."""
    if not len(x):
        return []
    most = max(n * max(abs(int(x.min())), abs(int(x.max()))), 1) + max(abs(s) for s in sums)
    d = n * x.astype(np.int64 if most * most * x.shape[1] <= _LONGEST else object) - np.array(sums, dtype=np.int64 if most <= _LONGEST and most * most * x.shape[1] <= _LONGEST else object)
    return [int(v) for v in (d * d).sum(axis=1)]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype=np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums by dimension as text (they may pass 64 bits); dimension -1 is the number of vectors."""
    n, total = 0, None
    for b in batches:
        x = _matrix(b.column(0))
        if len(x):
            low, high = (x & 0xFFFFFFFF).sum(axis=0).tolist(), (x >> 32).sum(axis=0).tolist()
            both = [(h << 32) + v for h, v in zip(high, low, strict=True)]
            n, total = n + len(x), both if total is None else [a + c for a, c in zip(total, both, strict=True)]
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total)), pa.int32()), pa.array([str(v) for v in [n, *total]], pa.string())], names=["dim", "total"])


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sum of whole numbers in text, which may have any number of digits."""
    total = sum(int(v) for b in batches for v in b.column(0).to_pylist())
    yield pa.RecordBatch.from_arrays([pa.array([str(total)], pa.string())], names=["total"])


def usable(table: DataFrame, vector_col: str) -> DataFrame:
    """(row, x): the rows whose vectors can be used, of the commonest length (of equally common ones the longest)."""
    rows = modest_batches(table).select(F.struct("*").alias("row"), whole_numbers(F.col(vector_col)).alias("x")).where("x is not null")
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    longest = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return rows.where(F.size("x") == (longest["size"] if longest else 0))


def fit(vectors: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct vectors (x, of one length) by their first k components; None without any variance. Each task
    holds a matrix of length^2 / 2, and so does the driver: for some thousands of dimensions at most."""
    parts = vectors.select("x").mapInArrow(_sums, "dim int, total string").withColumn("total", F.col("total").cast("decimal(38,0)"))
    found = {r["dim"]: int(r["total"]) for r in parts.groupBy("dim").agg(F.sum("total").alias("total")).collect()}  # a row a dimension
    n = found.pop(-1, 0)
    sums = [found[d] for d in range(len(found))]
    if n < 2:
        return None

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(0))
            rows = centred(x, n, sums)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1]), pa.int32()), pa.array(rows.ravel())) if len(rows) else pa.array([], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([lists, pa.array([str(v) for v in deviations(x, n, sums)], pa.string())], names=["centred", "deviation"])

    rows = saved(vectors.select("x").mapInArrow(spread, "centred array<double>, deviation string"), "whitening-centred")
    whole = sum(int(r["total"]) for r in rows.select("deviation").mapInArrow(_total, "total string").collect())  # a row a task
    if not whole:
        return None
    matrix = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector("centred").alias("v")), "v")
    found = RowMatrix(matrix, n, len(sums)).computeSVD(len(sums), computeU=False, rCond=LEAST_SINGULAR)
    singular = np.array(found.s.toArray())[:k]
    out = Whitening(n, sums, found.V.toArray()[:, : len(singular)], singular * singular / n, whole / n**3)
    out.identity_error = identity_error(rows, out)
    return out


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity, from the rows themselves."""
    k = len(fitted.eigenvalues)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in batches:
            w = _matrix(b.column(0))
            if len(w):
                w = w @ fitted.vectors / np.sqrt(fitted.eigenvalues)
                total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int32()), pa.array(total.ravel())], names=["at", "v"])

    sums = rows.select("centred").mapInArrow(products, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()  # k * k rows
    covariance = np.zeros(k * k)
    for r in sums:
        covariance[r["at"]] = r["v"] / fitted.n
    return float(np.abs(covariance.reshape(k, k) - np.eye(k)).max())


def whiten(table: DataFrame, vector_col: str = "embedding", k: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """(row, deviation, whitened) for each row of table whose vector can be used, and the fit: row holds all columns of table,
    whitened the row's place on the components, of which there are k or as many as have variance.

    Vectors that are null or empty, or hold entries that are null or not finite, are left out, and so are those of another length
    than the commonest. Repeated vectors count once in the fit and stay as rows. Entries beyond 64 bits are taken as the
    largest long. A deviation that passes 64 bits is null. No rows, one vector, or all alike: no component, so no rows."""
    rows = saved(usable(table, vector_col), "whitening-rows")
    fitted = fit(rows.select("x").distinct(), k)
    if fitted is None:
        return rows.select("row", F.lit(None).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")).where("false"), None

    @F.arrow_udf("struct<deviation: long, whitened: array<double>>")
    def place(x: pa.Array) -> pa.Array:
        m = _matrix(x)
        exact = [v if v <= _LONGEST else None for v in deviations(m, fitted.n, fitted.sums)]
        return pa.StructArray.from_arrays([pa.array(exact, pa.int64()), pa.array(fitted.whitened(m).tolist() if len(m) else [], pa.list_(pa.float64()))], names=["deviation", "whitened"])

    return rows.select("row", place("x").alias("found")).select("row", "found.deviation", "found.whitened"), fitted


def components(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """A row for each usable row of table and component, numbered from 1: its id, component, n, deviation, whitened,
    explained (the component's part of the total variance) and identity_error."""
    found, fitted = whiten(table.select(F.col(id_col), F.col(vector_col)), vector_col, k)
    n, explained, error = (fitted.n, fitted.explained, fitted.identity_error) if fitted else (0, [], 0.0)
    each = found.select(F.col("row")[id_col].alias(id_col), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    part = F.get(F.array(*map(F.lit, explained)).cast("array<double>"), F.col("at"))
    return each.select(id_col, (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", part.alias("explained"), F.lit(error).alias("identity_error"))
