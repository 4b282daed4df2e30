"""Completion of proposals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import filled, safe_divide


def completion_rate(proposals: DataFrame, target: DataFrame, log: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """proposals (proposal_id) stay, also without targets. target (proposal_id,
    ob_code, exptime_usr, allocated_time_tac), log (psl_id, ob_code,
    eff_exptime_done_real, exptime_done_real): hours in all, allocated, of
    finished targets, achieved, executed, expected, and the rate in percent."""
    done = log.groupBy(F.col("psl_id").alias("proposal_id"), "ob_code").agg(F.max("eff_exptime_done_real").alias("eff"), F.max("exptime_done_real").alias("real"))
    met = target.join(done, ["proposal_id", "ob_code"], "left")
    if expected is not None:
        met = met.join(expected, "ob_code", "left")
    else:
        met = met.withColumn("exptime_expected", F.lit(0.0))
    met = met.withColumn("rec", F.least(filled("exptime_usr"), filled("eff")))
    by = met.groupBy("proposal_id").agg(
        F.sum("exptime_usr").alias("tot"), F.min("allocated_time_tac").alias("alloc"),
        F.sum(F.when(F.col("rec") >= F.col("exptime_usr"), F.col("rec"))).alias("com"),
        F.sum("rec").alias("achieve"), F.sum(filled("real")).alias("exe"), F.sum(filled("exptime_expected")).alias("exp"),
    )
    out = proposals.select("proposal_id").distinct().join(by, "proposal_id", "left")
    hours = {n: filled(c) / 3600 for n, c in (("fh_tot", "tot"), ("fh_com", "com"), ("fh_achieve", "achieve"), ("fh_exe", "exe"))}
    out = out.withColumns(hours | {"fh_alloc": filled("alloc")}).withColumn("fh_exp", filled("exp") / 3600 + F.col("fh_achieve"))
    out = out.withColumn("completion", safe_divide("fh_achieve", "fh_alloc") * 100)
    return out.select("proposal_id", "fh_tot", "fh_alloc", "fh_com", "fh_achieve", "fh_exe", "fh_exp", "completion")


def grade(proposal_id: Column | str, is_backup: Column | str) -> Column:
    """B of the main list; of the backup list C or F by the ending."""
    p = F.col(proposal_id) if isinstance(proposal_id, str) else proposal_id
    b = F.col(is_backup) if isinstance(is_backup, str) else is_backup
    return F.when(~b, "B").when(p.endswith("QN"), "C").when(p.endswith("QF"), "F")


def by_proposal_and_resolution(target: DataFrame) -> DataFrame:
    """Hours done, allocated hours and the rate by proposal and resolution."""
    by = target.groupBy("proposal_id", "resolution").agg((F.sum("exptime_done") / 3600).alias("fh_done"), F.max("allocated_time_tac").alias("allocated"))
    return by.withColumn("completion", safe_divide("fh_done", "allocated") * 100)


def under_requested(target: DataFrame) -> DataFrame:
    """Proposals that ask for less than their allocation."""
    by = target.groupBy("proposal_id").agg((F.sum("exptime_usr") / 3600).alias("requested"), F.max("allocated_time_tac").alias("allocated"))
    return by.where("requested < allocated")
