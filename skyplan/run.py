"""A night's plan from its tables, step by step, as plain functions:

    targets -> pointings -> schedule -> exposures and reports

Each step takes DataFrames and returns them; run() writes them under a folder
and reads them again, so every step can be repeated alone, and steps whose
result is there already can be skipped. `python -m skyplan.run` does it for
Parquet tables in a folder.
"""

from __future__ import annotations

import argparse
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import completion, output, pointing, schedule, targets, validate, weights
from .sources import config as C
from .sources import tables

STEPS = ("targets", "pointings", "allocations", "schedule", "plan", "frames", "completion", "violations")


@dataclass(frozen=True)
class Settings:
    """What a configuration says; every part has a default."""

    n_pointings: int = 10
    slots_per_night: int = 24
    single: float = 900.0
    radius: float = pointing.FIELD_RADIUS
    fibers: int = pointing.FIBERS
    proposals: tuple[str, ...] = ()
    resolution: str = "L"
    date: str = "240101"
    weights: tuple[float, float, float] = (2.0, 0.0, 0.0)
    skip: frozenset[str] = field(default_factory=frozenset)

    @classmethod
    def of(cls, config: Mapping[str, Mapping[str, object]], skip: Collection[str] = ()) -> Settings:
        ppp, queue = config.get("ppp", {}), config.get("queue", {})
        given = {k: ppp[k] for k in ("n_pointings", "slots_per_night", "single", "radius", "fibers", "resolution", "date") if k in ppp}
        return cls(**given, proposals=tuple(ppp.get("proposalIds", ())), weights=tuple(queue.get("weights", (2.0, 0.0, 0.0))), skip=frozenset(skip))


def plan_targets(target: DataFrame, proposal: DataFrame, catalog: DataFrame, log: DataFrame, s: Settings) -> DataFrame:
    """Targets with time left, and their weights."""
    found = targets.from_database(targets.active_targets(target, proposal, catalog, list(s.proposals) or None))
    once = targets.keep_first(found, ["proposal_id", "ob_code"], ["exptime_usr", "resolution"])
    left = targets.remaining(targets.with_allocation(targets.with_progress(once, log)), s.single)
    ranked = weights.local_density(weights.rank_weight(left))
    return weights.weighted(ranked, s.single, *s.weights)


def plan_pointings(target: DataFrame, s: Settings) -> DataFrame:
    ppc = pointing.plan_pointings(target, s.n_pointings, s.single, s.fibers, s.radius)
    named = output.pointing_codes(ppc.withColumnsRenamed({"ra": "ppc_ra", "dec": "ppc_dec"}), s.resolution, s.date, "pointing")
    priority = F.col("score").alias("ppc_priority")
    return named.select("ppc_code", "ppc_ra", "ppc_dec", F.lit(0.0).alias("ppc_pa"), F.lit(s.resolution).alias("ppc_resolution"), priority, "ppc_allocated_targets")


def plan_schedule(ppc: DataFrame, windows: DataFrame, s: Settings) -> DataFrame:
    """windows (night, start, stop): slots one behind the other, the best
    pointings first."""
    offered = ppc.select(F.col("ppc_code").alias("ppc"), F.col("ppc_priority").alias("score")).crossJoin(windows.select("night", "start", "stop"))  # pointings of a run x its nights
    long_enough = F.unix_timestamp("stop") - F.unix_timestamp("start") >= schedule.SLOT_SECONDS
    chosen = schedule.greedy_schedule(offered.where(long_enough), s.slots_per_night)
    at = F.col("start") + F.make_interval(secs=((F.col("slot") - 1) * schedule.SLOT_SECONDS).cast("double"))
    placed = chosen.withColumn("obstime", at)
    inside = F.unix_timestamp("obstime") + schedule.SLOT_SECONDS <= F.unix_timestamp("stop")
    return placed.where(inside).select("night", F.col("ppc").alias("ppc_code"), "slot", "obstime")


def run(spark: SparkSession, tables_of: Mapping[str, DataFrame], folder: str, s: Settings) -> dict[str, DataFrame]:
    """tables_of: target, proposal, catalog, log, windows. Writes each step's
    result as Parquet under folder, and returns them all."""
    done: dict[str, DataFrame] = {}

    def step(name: str, made) -> None:
        if name not in s.skip:
            made().write.mode("overwrite").parquet(f"{folder}/{name}")
        done[name] = spark.read.parquet(f"{folder}/{name}")

    step("targets", lambda: plan_targets(*[tables_of[k] for k in ("target", "proposal", "catalog", "log")], s))
    step("pointings", lambda: plan_pointings(done["targets"], s))
    step("allocations", lambda: output.allocated_counts(done["pointings"], done["targets"].select("identify_code", "proposal_id", "ob_code", "rank_fin"), s.single))
    step("schedule", lambda: plan_schedule(done["pointings"], tables_of["windows"], s))
    step("plan", lambda: output.plan_output(done["pointings"], done["schedule"], done["targets"].select("identify_code", "proposal_id", "ob_code")))
    timed = lambda: done["pointings"].join(done["schedule"], "ppc_code").withColumns({"total_exptime": F.lit(s.single), "n_split": F.lit(2)})
    step("frames", lambda: output.exposure_frames(timed()).drop("ppc_allocated_targets"))
    all_targets = lambda: targets.from_database(targets.active_targets(tables_of["target"], tables_of["proposal"], tables_of["catalog"]))
    log = lambda: tables_of["log"].withColumn("exptime_done_real", F.col("eff_exptime_done_real"))
    step("completion", lambda: completion.completion_rate(tables_of["proposal"].select("proposal_id"), all_targets().select("proposal_id", "ob_code", "exptime_usr", "allocated_time_tac"), log()))
    step("violations", lambda: validate.all_rules(validate.code_with_places(done["pointings"]), validate.duplicates(done["pointings"], "ppc_code", "ppc_ra", "duplicate_ppc_code")))
    tables.write_csv(output.export_pointings(done["pointings"]), f"{folder}/ppcList", as_text=False)
    tables.write_csv(done["plan"], f"{folder}/result", as_text=True)
    return done


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Plan pointings, their schedule and exposures from Parquet tables.")
    parser.add_argument("--tables", required=True, help="folder of target, proposal, catalog, log and windows, as <name>.parquet")
    parser.add_argument("--work-dir", required=True)
    parser.add_argument("--config", help="TOML file")
    parser.add_argument("--secondary-config", help="TOML file under the first one")
    parser.add_argument("--n-pointings", type=int)
    parser.add_argument("--skip", nargs="*", default=[], choices=STEPS, help="steps of which the result is there")
    given = parser.parse_args(arguments)
    config = C.load(given.config, given.secondary_config) if given.config else {}
    if given.n_pointings is not None:
        config.setdefault("ppp", {})["n_pointings"] = given.n_pointings
    spark = SparkSession.builder.appName("skyplan").getOrCreate()
    found = {n: spark.read.parquet(f"{given.tables}/{n}.parquet") for n in ("target", "proposal", "catalog", "log", "windows")}
    for name, table in run(spark, found, given.work_dir, Settings.of(config, given.skip)).items():
        print(f"{name}: {table.count()} rows")


if __name__ == "__main__":
    main()
