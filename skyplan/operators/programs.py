"""Programmes of one proposal: what its policy asks for, further targets,
codes and priorities of its pointings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import ab_magnitude, ceil_to, identify_code
from .targets import BANDS, keep_first, union_all

#: Column types on which targets from files and from a database agree.
SHARED_TYPES = {"ob_code": "string"} | {f"filter_{b}": "string" for b in BANDS} | {f"psf_flux_{e}{b}": "double" for e in ("", "error_") for b in BANDS}


def fixed_angle(policy: Mapping[str, Any], default: float | None = None) -> float | None:
    """The policy's position angle, by its own key or the older one."""
    return policy["fixed_ppc_pa"] if "fixed_ppc_pa" in policy else policy.get("ppc_pa", default)


def pointing_source(policies: DataFrame, has_local: Column) -> DataFrame:
    """policies (proposal_id, import_user_ppc_from_db): where the pointings of
    each proposal come from: a local file before the database, which a policy
    may rule out, before the planner."""
    from_db = F.coalesce("import_user_ppc_from_db", F.lit(True))
    return policies.withColumn("source", F.when(has_local, "local").when(from_db, "database").otherwise("planner"))


def with_shared_types(target: DataFrame) -> DataFrame:
    have = dict(target.dtypes)
    return target.withColumns({c: F.col(c).cast(t) for c, t in SHARED_TYPES.items() if c in have and have[c] != t})


def with_extra_targets(target: DataFrame, extra: Iterable[DataFrame], single: float, split: tuple[float, float, float] | None = None, forced: float | None = None) -> DataFrame:
    """Targets with those of further files behind them, exposures in whole
    steps, nothing done or assigned yet. split: magnitude in i, and the
    exposures of brighter and of other targets; forced: one for all."""
    out = union_all(with_shared_types(target), *[with_shared_types(t) for t in extra])
    out = out.withColumns({"exptime_PPP": ceil_to("exptime", single), "identify_code": identify_code("proposal_id", "ob_code") if "proposal_id" in out.columns else F.col("ob_code"), "exptime_assign": F.lit(0.0), "exptime_done": F.lit(0.0)})
    if split is not None:
        limit, bright, faint = split
        mag = ab_magnitude("psf_flux_i")
        out = out.withColumn("i2_mag", mag).withColumn("exptime_PPP", F.when(mag < limit, bright).when(mag >= limit, faint).otherwise(F.col("exptime_PPP")))
    return out if forced is None else out.withColumn("exptime_PPP", F.lit(float(forced)))


def classic_codes(ppc: DataFrame, order: str, prefix: str | None = None) -> DataFrame:
    """ppc (proposal_id, resolution): codes numbered within each proposal, from
    the second part of its id unless the policy has a prefix."""
    n = F.row_number().over(Window.partitionBy("proposal_id", "resolution").orderBy(order)).cast("string")
    token = F.split_part("proposal_id", F.lit("-"), F.lit(2))
    own = F.concat_ws("_", F.lit("cla"), "resolution", token, n)
    return ppc.withColumn("ppc_code", own if prefix is None else F.concat_ws("_", F.lit(prefix), n))


def with_user_priority(assigned: DataFrame, user: DataFrame) -> DataFrame:
    """The priority that a user gave to a pointing of the same centre and
    angle; pointings of which there is none drop out. Of several the least."""
    keys = ["ppc_ra", "ppc_dec", "ppc_pa"]
    once = keep_first(user.select(*keys, "ppc_priority_usr"), keys, ["ppc_priority_usr"])
    return assigned.drop("ppc_priority", "ppc_priority_usr").join(once, keys).withColumn("ppc_priority", F.col("ppc_priority_usr"))


def assignment_summary(target: DataFrame, assigned: DataFrame) -> DataFrame:
    """assigned (identify_code): by proposal the targets, their weight and the
    fibre hours credited."""
    met = target.join(assigned.select("identify_code").distinct(), "identify_code", "left_semi")
    return met.groupBy("proposal_id").agg(F.count("*").alias("n_assigned"), F.sum("rank_fin").alias("weight"), (F.sum(F.least("exptime_done", "exptime")) / 3600).alias("fh_credited"))


def visibility_counts(target: DataFrame) -> DataFrame:
    """One row: targets, visible ones, and those begun before."""
    return target.agg(F.count("*").alias("n"), F.count_if("is_visible").alias("n_visible"), F.count_if(F.col("exptime_done") > 0).alias("n_partial"))


def request_flag(arm: Column | str) -> Column:
    """0 for targets of the n arm, else 1."""
    a = F.col(arm) if isinstance(arm, str) else arm
    return F.when(a == "n", 0).otherwise(1)


def move_cost(distance: Column | str) -> Column:
    """Cost of moving a fibre so far, in mm."""
    return 0.1 * (F.col(distance) if isinstance(distance, str) else distance)


def by_resolution(target: DataFrame) -> tuple[DataFrame, DataFrame]:
    return target.where("resolution = 'L'"), target.where("resolution = 'M'")
