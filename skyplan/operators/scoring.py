"""Progress of proposals and the score of a pointing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_divide

FIBERS = 2394
#: Factors of the score's terms, and the worth of priorities.
FACTORS = {"fh": 5.0, "finish": 2.5, "cont": 0.1, "prio": 1.5, "fill": 0.5}
PENALTIES = {"new": 0.1, "over": 0.05}
PRIORITY_VALUES = {0: 100.0, 1: 5.0, 2: 1.0, 3: 1.0, 4: 0.5, 5: 0.5, 6: 0.4, 9: 0.1}
#: Costs by priority in the queue (999: fillers), of partly
#: observed and of calibration targets, and how many of these are asked for.
QUEUE_COSTS = {999: 200, 0: 100, 1: 90, 2: 80, 3: 70, 4: 60, 5: 50, 6: 40, 7: 30, 8: 20, 9: 10}
PARTIAL_COST, CALIBRATION_COST, N_STANDARDS, N_SKY = 200, 200, 200, 400
CLASSIC_CALIBRATION_COST = 2000


def priority_value(priority: Column | str = "priority") -> Column:
    p = F.col(priority) if isinstance(priority, str) else priority
    out = F.when(F.lit(False), 0.0)
    for k, v in PRIORITY_VALUES.items():
        out = out.when(p == k, v)
    return out.otherwise(0.0)


def class_costs(spark: SparkSession, classic: list[float] | None = None) -> DataFrame:
    """(class, n_required, cost, partial_cost, calibration) of the queue, or
    of classical runs by the costs of P0 to P10: partial ones cost the most of
    these, and calibration targets aren't asked for."""
    costs = QUEUE_COSTS if classic is None else dict(enumerate(classic))
    partial = PARTIAL_COST if classic is None else max(classic)
    rows = [(f"sci_P{p}", 0, float(c), float(partial), False) for p, c in costs.items()]
    for name, n in (("cal", N_STANDARDS), ("sky", N_SKY)):
        rows.append((name, n if classic is None else 0, float(CALIBRATION_COST if classic is None else CLASSIC_CALIBRATION_COST), 0.0, True))
    return spark.createDataFrame(rows, "class string, n_required int, cost double, partial_cost double, calibration boolean")


def progress(target: DataFrame) -> DataFrame:
    """Goal, hours and counts by proposal."""
    return target.groupBy("proposal_id").agg(
        F.max("allocated_time").alias("FH_goal"),
        (F.sum(F.least("exptime_done", "exptime")) / 3600).alias("FH_done"),
        F.count_if(F.col("exptime_PPP") <= 0).alias("N_done"),
        F.count_if(F.col("exptime_PPP") < F.col("exptime")).alias("N_obs"),
        F.count("*").alias("N_psl"),
    )


def finished(progress_rows: DataFrame) -> bool:
    """Every proposal has its goal and a finished target; one row is read."""
    short = progress_rows.where("not (FH_done >= FH_goal and N_done > 0)")
    return short.isEmpty()


def proposal_budget(target: DataFrame) -> DataFrame:
    """Weight and remaining hours of each proposal."""
    spent = F.sum(F.least("exptime_done", "exptime")) / 3600
    return target.groupBy("proposal_id").agg((F.max("rank") / 10).alias("w"), F.greatest(F.lit(0.0), F.max("allocated_time") - spent).alias("left"))


def pointing_scores(target: DataFrame, assigned: DataFrame, single: float = 900.0) -> DataFrame:
    """assigned (pointing, identify_code) -> one row per pointing with the
    terms and the score. Sums run per pointing and proposal first."""
    step = F.greatest(F.least(F.col("exptime_PPP"), F.lit(single)), F.lit(0.0))
    met = assigned.join(target, "identify_code").withColumn("__step", step)
    long = F.col("exptime_PPP") > single
    begun = F.col("exptime_done") > 0
    counts = met.groupBy("pointing").agg(
        F.count("*").alias("n_assigned"), F.count_if(F.col("priority") == 0).alias("n_p0"), F.count_if(F.col("priority") == 1).alias("n_p1"),
        F.count_if(~long).alias("n_finish"), F.count_if(long).alias("n_partial"), F.count_if(begun).alias("n_continue"),
        F.count_if(~begun & long).alias("n_new_partial"), F.sum(priority_value()).alias("__prio"),
    )
    budget = proposal_budget(target)
    whole = budget.agg(F.sum(F.col("w") * F.col("left")).alias("__sum"), F.max("w").alias("__top"))
    whole = whole.crossJoin(target.where("exptime_PPP > 0").agg(F.sum(priority_value()).alias("__worth")))
    gain = met.groupBy("pointing", "proposal_id").agg((F.sum("__step") / 3600).alias("d")).join(budget, "proposal_id")
    gain = gain.groupBy("pointing").agg(F.sum(F.col("w") * F.least("d", "left")).alias("__use"), F.sum(F.col("w") * F.greatest(F.lit(0.0), F.col("d") - F.col("left"))).alias("__more"))
    rows = counts.join(gain, "pointing").crossJoin(whole)
    most = F.least(F.col("__sum"), F.lit(FIBERS * single / 3600) * F.col("__top"))
    terms = {
        "fh": safe_divide(F.col("__use"), most), "finish": safe_divide("n_finish", "n_assigned"), "cont": safe_divide("n_continue", "n_assigned"),
        "prio": safe_divide("__prio", "__worth"), "fill": F.col("n_assigned") / FIBERS, "new": safe_divide("n_new_partial", "n_assigned"),
        "over": safe_divide(F.col("__more"), most),
    }
    rows = rows.withColumns(terms)
    score = sum((F.lit(f) * F.col(t) for t, f in FACTORS.items()), F.lit(0.0)) - sum((F.lit(f) * F.col(t) for t, f in PENALTIES.items()), F.lit(0.0))
    return rows.withColumn("score", score).drop("__prio", "__sum", "__top", "__worth", "__use", "__more")


def tracked_by_priority(target: DataFrame, assigned: DataFrame) -> DataFrame:
    """Assigned and all targets of each priority."""
    flag = assigned.select("identify_code").distinct().withColumn("__a", F.lit(1))
    met = target.join(flag, "identify_code", "left")
    return met.groupBy("priority").agg(F.count("__a").alias("n_assigned"), F.count("*").alias("n_total"))


def cost_pattern_scores(assigned: DataFrame) -> DataFrame:
    """assigned (pattern, priority, n_got, n_available) -> score per pattern."""
    def of(column: str, p: int | None) -> Column:
        return F.sum(F.col(column) if p is None else F.when(F.col("priority") == p, F.col(column)).otherwise(0))

    return assigned.groupBy("pattern").agg(
        (safe_divide(of("n_got", None), of("n_available", None)) + 3 * safe_divide(of("n_got", 0), of("n_available", 0)) + 2 * safe_divide(of("n_got", 1), of("n_available", 1))).alias("score")
    )


def first_best(scores: DataFrame, score: str, ordinal: str) -> DataFrame:
    """The row with the highest score, the first of equals."""
    return scores.orderBy(F.col(score).desc_nulls_last(), ordinal).limit(1)


def pointing_priority(ppc: DataFrame, target: DataFrame) -> DataFrame:
    """Priority (sum of the targets' rank_fin; null if none) and usage of each
    pointing, as fraction and percent."""
    each = ppc.select("ppc_code", F.explode_outer("ppc_allocated_targets").alias("identify_code"))
    met = each.join(target.select("identify_code", "rank_fin"), "identify_code", "left")
    out = met.groupBy("ppc_code").agg(F.sum("rank_fin").alias("ppc_priority"), F.count("identify_code").alias("n_targets"))
    return out.withColumn("usage_fraction", F.col("n_targets") / FIBERS).withColumn("usage_percent", F.col("n_targets") / FIBERS * 100)


def shared_angle_score(candidates: DataFrame) -> DataFrame:
    """candidates (pa, priority, usage, allocated) -> by pa: sums without the
    missing ones, and the distinct targets."""
    sums = candidates.groupBy("pa").agg(F.sum(F.nanvl("priority", F.lit(0.0))).alias("priority"), F.sum(F.nanvl("usage", F.lit(0.0))).alias("usage"))
    ids = candidates.select("pa", F.explode_outer("allocated").alias("t")).groupBy("pa").agg(F.count_distinct("t").alias("n_targets"))
    return sums.join(ids, "pa")


def best_time(candidates: DataFrame, low: float = 30.0, high: float = 75.0) -> DataFrame:
    """candidates (time, elevation): the time with most pointings in range,
    of equals the greatest sum of their elevations, without any the greatest
    mean elevation, then the earliest."""
    ok = F.col("elevation").between(low, high)
    by = candidates.groupBy("time").agg(F.count_if(ok).alias("n"), F.coalesce(F.sum(F.when(ok, F.col("elevation"))), F.lit(0.0)).alias("total"), F.avg("elevation").alias("mean"))
    return by.orderBy(F.col("n").desc(), F.col("total").desc(), F.col("mean").desc(), "time").limit(1)


def top_pointings(ppc: DataFrame, n: int, order: str, prefix: str) -> DataFrame:
    """The n best with codes prefix_1, prefix_2 ...; the limit comes before the
    window, which so runs over n rows."""
    best = ppc.orderBy(F.col(order).desc_nulls_last(), "ppc_id").limit(n)
    rank = F.row_number().over(Window.orderBy(F.col(order).desc_nulls_last(), "ppc_id"))
    return best.withColumn("ppc_code", F.concat(F.lit(f"{prefix}_"), rank.cast("string"))).withColumn("ppc_rank", rank)
