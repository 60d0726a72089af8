"""A batch's records are normalized by all tasks, however few blocks the input has, and hashed as one by one."""

import pyarrow as pa
from pyspark.sql import functions as F

from ledgermill.functions import canonical
from ledgermill.plans import store as stores


def test_one_block_is_normalized_by_several_tasks(spark, tmp_path):
    lines = str(tmp_path / "one")
    spark.range(40_000).select(F.col("id").alias("seq"), F.sha2(F.col("id").cast("string"), 512).alias("source_job_id"), F.lit("r").alias("run_id"), F.lit("x").alias("source"), F.sha2(F.col("id").cast("string"), 256).alias("title")).coalesce(1).write.parquet(lines)
    store = stores.Store(spark, str(tmp_path / "store"))
    assert store.append(spark.read.parquet(lines), "1", "x").processed == 40_000
    log = store.log()
    assert log.select(F.input_file_name()).distinct().count() > 1
    assert log.agg(F.count_distinct("seq"), F.min("seq"), F.max("seq")).first()[:] == (40_000, 0, 39_999)


def test_tokens_are_those_of_each_value():
    values = ["A  b", None, "[1, 2.50]", "a B", "A  b", "", None]
    assert canonical._tokens(pa.array(values, pa.string())) == [canonical.token(v) for v in values]
    assert canonical._tokens(pa.nulls(3, pa.string())) == ["null"] * 3
    assert canonical._tokens(pa.array([], pa.string())) == []
