"""Running numbers over a whole table, without a task that takes all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut_lineage

#: Fixed value: bits of monotonically_increasing_id below the partition's number.
_ROW_BITS = 33


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with the row's place in the order, from 1, as a long. The sorted
    ranges are written, so that the sizes and the places are of the same
    ranges; one window runs over the sizes, a row per range."""
    rows = cut_lineage(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", _ROW_BITS).alias("__part")
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(part).agg(F.count("*").alias("__n"))
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__off"))
    place = F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + F.col("__off") + 1
    met = rows.withColumn("__part", part).join(offsets, "__part")
    return met.withColumn(name, place.cast("long")).drop("__at", "__part", "__off")
