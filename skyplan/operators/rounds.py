"""Planning of many pointings a round.

The serial planner makes one pointing a round: it seeds it at the peak of the
density of what is left, and takes what a pointing there can. Fields that can
share no target don't wait for each other, though: a peak that is higher than
all others within the reach of two fields is where the serial planner would
come to anyway. So the sky is cut in blocks as wide as that reach, each block
offers its highest cell, and in the graph of neighbouring blocks those offers
are taken that outrank all their neighbours': an independent set, of which no
two fields overlap. All of them are tried, scored and filled in one round; the
number of rounds follows how often fields lie over each other, not how many
fields there are. What changes is kept apart from what doesn't: a round
rewrites (id, seconds left), never the targets.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut_lineage
from .numbering import numbered
from .pointing import FIELD_RADIUS, candidate_centres
from .scoring import FIBERS, finished, pointing_scores, progress
from .spatial import cone_pairs, density_peak

#: How far trial centres lie from a seed.
REACH = 0.6
_TRIALS = 1000


def independent_peaks(cells: DataFrame, wide: float) -> DataFrame:
    """cells (ra, dec, density) -> those that are the highest of their block
    and outrank the highest of the eight blocks around it; ties go to the
    smaller ra, then dec. Blocks are `wide` degrees of declination, and of
    right ascension wide enough at the block's edge nearer to a pole."""
    bands = math.ceil(180 / wide)
    band = F.greatest(F.lit(0), F.least(F.floor((F.col("dec") + 90) / wide), F.lit(bands - 1))).cast("long")
    # one count of blocks for three bands that touch would differ; the narrowest serves all: blocks of a band near a pole are wider
    edge = F.least(F.lit(89.0), F.greatest(F.abs(F.col("__b") * wide - 90), F.abs((F.col("__b") + 1) * wide - 90)))
    n = F.greatest(F.lit(1), F.floor(360 * F.cos(F.radians(edge)) / wide)).cast("long")
    placed = cells.withColumn("__b", band).withColumn("__n", n)
    placed = placed.withColumn("__c", F.least(F.floor(F.pmod("ra", F.lit(360.0)) / 360 * F.col("__n")), F.col("__n") - 1).cast("long"))
    offer = F.struct("density", (-F.pmod("ra", F.lit(360.0))).alias("a"), (-F.col("dec")).alias("d"))
    # written, so that a block's offer is the same where it is compared
    tops = cut_lineage(placed.groupBy("__b", "__c", "__n").agg(F.max(offer).alias("top"), F.max_by(F.struct("ra", "dec"), offer).alias("at")))
    # the blocks of another band that a block with its two neighbours reaches
    near = tops.withColumn("__b2", F.explode(F.array(F.col("__b") - 1, F.col("__b"), F.col("__b") + 1)))
    edge2 = F.least(F.lit(89.0), F.greatest(F.abs(F.col("__b2") * wide - 90), F.abs((F.col("__b2") + 1) * wide - 90)))
    n2 = F.greatest(F.lit(1), F.floor(360 * F.cos(F.radians(edge2)) / wide)).cast("long")
    first, last = F.floor((F.col("__c") - 1) / F.col("__n") * F.col("__n2")) - 1, F.floor((F.col("__c") + 2) / F.col("__n") * F.col("__n2")) + 1
    near = near.where((F.col("__b2") >= 0) & (F.col("__b2") < bands)).withColumn("__n2", n2)
    span = F.when(last - first + 1 >= F.col("__n2"), F.sequence(F.lit(0).cast("long"), F.col("__n2") - 1)).otherwise(F.sequence(first.cast("long"), last.cast("long")))
    met = near.select(F.col("__b2").alias("__b"), F.explode(F.array_distinct(F.transform(span, lambda x: F.pmod(x, F.col("__n2"))))).alias("__c"), F.col("top").alias("other"))
    highest = met.groupBy("__b", "__c").agg(F.max("other").alias("highest"))
    best = tops.join(highest, ["__b", "__c"]).where(F.col("top") == F.col("highest"))
    return best.select("at.ra", "at.dec", F.col("top.density").alias("density"))


def plan_in_rounds(target: DataFrame, n_ppc: int, single: float = 900.0, fibers: int = FIBERS, radius: float = FIELD_RADIUS, step: float = 0.5) -> DataFrame:
    """As plan_pointings, with the round of each pointing: pointings until
    every proposal has its goal, no target is left, or there are n_ppc. If a
    round has more fields than are still wanted, the denser ones are taken."""
    spark = target.sparkSession
    fixed = cut_lineage(target.drop("exptime_PPP"))
    left = cut_lineage(target.select("identify_code", "exptime_PPP"))
    offsets = candidate_centres((0.0, 0.0), REACH)
    shifts = F.array(*[F.struct(F.lit(k).alias("k"), F.lit((ra + 180) % 360 - 180).alias("ra"), F.lit(dec).alias("dec")) for k, ra, dec in offsets])
    wide = 2 * (radius + REACH * math.sqrt(2)) + step
    plans, lists, made, turn = [], [], 0, 0
    while made < n_ppc:
        now = fixed.join(left, "identify_code")
        open_ = now.where("exptime_PPP > 0")
        if open_.isEmpty() or finished(progress(now)):
            break
        peaks = independent_peaks(density_peak(open_, radius, step), wide)
        seeds = numbered(peaks, [F.col("density").desc(), F.col("ra"), F.col("dec")], "seed").where(F.col("seed") <= n_ppc - made)
        trial = seeds.select("seed", F.explode(shifts).alias("s"), "ra", "dec").select(
            (F.col("seed") * _TRIALS + F.col("s.k")).alias("pointing"), F.pmod(F.col("ra") + F.col("s.ra"), F.lit(360.0)).alias("ra"), F.greatest(F.lit(-90.0), F.least(F.lit(90.0), F.col("dec") + F.col("s.dec"))).alias("dec")
        )
        trial = cut_lineage(trial)
        near = cone_pairs(open_.select(F.col("identify_code").alias("l_id"), "ra", "dec", "weight"), trial.withColumnRenamed("pointing", "r_id"), radius)
        heaviest = Window.partitionBy("r_id").orderBy(F.col("weight").desc(), "separation", "l_id")
        assigned = cut_lineage(near.withColumn("__n", F.row_number().over(heaviest)).where(F.col("__n") <= fibers).select(F.col("r_id").alias("pointing"), F.col("l_id").alias("identify_code")))
        scores = pointing_scores(now, assigned, single).select("pointing", "score")
        best = scores.groupBy(F.floor(F.col("pointing") / _TRIALS).alias("seed")).agg(F.max(F.struct("score", (-F.col("pointing")).alias("neg"))).alias("m"))
        best = cut_lineage(best.select((-F.col("m.neg")).alias("pointing"), "m.score").join(trial, "pointing"))
        n = best.count()
        if not n:
            break
        taken = cut_lineage(assigned.join(best.select("pointing"), "pointing"))
        plans.append(best.select(F.lit(turn).alias("round"), "pointing", "ra", "dec", "score"))
        lists.append(taken.select(F.lit(turn).alias("round"), "pointing", "identify_code"))
        hit = taken.groupBy("identify_code").agg(F.lit(single).alias("__s"))  # fields of a round share no target
        left = cut_lineage(left.join(hit, "identify_code", "left").select("identify_code", (F.col("exptime_PPP") - F.coalesce("__s", F.lit(0.0))).alias("exptime_PPP")))
        made, turn = made + n, turn + 1
    if not plans:
        return spark.createDataFrame([], "round int, pointing long, ra double, dec double, score double, ppc_allocated_targets array<string>")
    plan, took = plans[0], lists[0]
    for a, b in zip(plans[1:], lists[1:]):
        plan, took = plan.unionByName(a), took.unionByName(b)
    by = took.groupBy("round", "pointing").agg(F.sort_array(F.collect_list("identify_code")).alias("ppc_allocated_targets"))  # at most `fibers` each
    rows = plan.join(by, ["round", "pointing"], "left")
    return numbered(rows, [F.col("round"), F.col("pointing")], "__p").withColumn("pointing", F.col("__p") - 1).drop("__p")
