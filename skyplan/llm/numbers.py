"""Numbers for rows that repeat, without a task that takes all of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written


def copy_numbers(rows: DataFrame, keys: list[str], name: str, order: list[Column] | None = None) -> DataFrame:
    """Narrow rows, written, with the number (from 0) of each among those of
    equal keys; nulls are equal. Rows are numbered within the partitions that
    they were written in; a key's numbers there follow those of the partitions
    before, of which a table has a row per key and partition. Keys are held by
    a 64-bit hash: two that meet would share numbers, each of them once."""
    spread = written(rows.withColumns({"__key": F.xxhash64(*keys, *[F.col(k).isNull() for k in keys]), "__part": F.spark_partition_id()}), "copies")
    local = F.row_number().over(Window.partitionBy("__key", "__part").orderBy(*(order or [F.lit(0)]))) - 1
    sizes = spread.groupBy("__key", "__part").agg(F.count("*").alias("__n"))
    ahead = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("__key", "__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__before")).where("__before > 0")
    met = spread.withColumn(name, local).join(before, ["__key", "__part"], "left")
    return met.withColumn(name, (F.col(name) + F.coalesce("__before", F.lit(0))).cast("long")).drop("__key", "__part", "__before")
