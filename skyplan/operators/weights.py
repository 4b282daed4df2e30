"""Planning weights of targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import combined_weight
from .keyed import with_aggregates
from .lineage import cut_lineage
from .numbering import numbered


def local_density(target: DataFrame) -> DataFrame:
    """Targets in the cell of one degree; cells truncate towards zero, and
    those south of -41 degrees are one with the first."""
    placed = target.withColumn("__d", F.greatest((F.col("dec") + 40).cast("int"), F.lit(0))).withColumn("__r", F.col("ra").cast("int"))
    return with_aggregates(placed, ["__d", "__r"], local_count=F.count("*")).drop("__d", "__r")


def rank_weight(target: DataFrame) -> DataFrame:
    """rank_fin = exp(0.55 r + 0.45 p + (9 - priority) * 0.05 (r - p)), with p
    the next lower rank. The distinct ranks, which may be as many as targets,
    are numbered by ranges, and each meets the one before it."""
    target = cut_lineage(target)  # read for the ranks and for the rows
    places = numbered(target.select("rank").distinct(), [F.col("rank")], "__n")
    ranks = places.select(F.col("rank").alias("__r"), "__n")
    before = places.select(F.col("rank").alias("__p"), (F.col("__n") + 1).alias("__n"))
    ranks = ranks.join(before, "__n", "left").select("__r", F.coalesce("__p", F.lit(0.0)).alias("__p"))
    met = target.join(ranks, F.col("rank").eqNullSafe(F.col("__r")))
    r, p = F.col("rank"), F.col("__p")
    return met.withColumn("rank_fin", F.exp(0.55 * r + 0.45 * p + (9 - F.col("priority")) * 0.05 * (r - p))).drop("__r", "__p")


def weighted(target: DataFrame, single: float = 900.0, a: float = 2.0, b: float = 0.0, c: float = 0.0) -> DataFrame:
    """Combined weight; targets begun before outrank all others. The maxima
    are one row, computed apart, so no window gathers all targets."""
    out = target.withColumn("weight", combined_weight(F.col("rank_fin"), F.col("exptime_PPP"), single, F.col("local_count"), a, b, c))
    top = out.agg(F.max("weight").alias("__w"), F.max("rank_fin").alias("__f"))
    begun = (F.col("exptime_done") > 0) | (F.col("exptime_PPP") < F.col("exptime"))
    out = out.crossJoin(top)
    return out.withColumn("weight", F.when(begun, F.col("weight") + F.col("__w")).otherwise(F.col("weight"))).withColumn(
        "rank_fin", F.when(begun, F.col("rank_fin") + F.col("__f")).otherwise(F.col("rank_fin"))
    ).drop("__w", "__f")
