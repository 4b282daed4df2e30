"""Checks and counts of fibre designs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import beyond_patrol, flat_distance, separation
from ..functions.scalar import count_pair, known, magnitude
from .keyed import with_aggregates
from .scoring import FIBERS
from .spatial import with_cell, with_cells_around

SCIENCE, SKY, FLUXSTD, UNASSIGNED = 1, 2, 3, 4
CAMERAS = 6


def fiber_counts(fiber: DataFrame, filler_proposals: list[str]) -> DataFrame:
    """Fibres by use in each design, blank ones ascending."""
    t, filler = F.col("target_type"), F.col("proposal_id").isin(filler_proposals)
    by = fiber.groupBy("design_id").agg(
        F.count_if((t == SCIENCE) & ~filler).alias("n_sci"), F.count_if((t == SCIENCE) & filler).alias("n_filler"),
        F.count_if(t == SKY).alias("n_sky"), F.count_if(t == FLUXSTD).alias("n_fstar"),
        F.count_if((t == UNASSIGNED) & (F.col("fiber_status") == 1)).alias("n_blank"),
    )
    return by.withColumn("usage", F.col("n_sci") / FIBERS * 100).orderBy("n_blank", "design_id")


def type_counts(fiber: DataFrame) -> DataFrame:
    """One column per type of fibre."""
    return fiber.groupBy("design_id").pivot("target_type", [SCIENCE, SKY, FLUXSTD, UNASSIGNED]).count().na.fill(0)


def expected_seconds(fiber: DataFrame, seconds: float = 900.0) -> DataFrame:
    """An exposure for each design in which a code appears."""
    return fiber.select("design_id", "ob_code").distinct().groupBy("ob_code").agg((F.count("*") * seconds).alias("exptime_expected"))


def camera_counts(stars: DataFrame, faintest: float = 19.0) -> DataFrame:
    """By design and camera 0..5 and in all (camera null): stars, and those
    not fainter than a limit; cameras without a star have 0."""
    cams = stars.select("design_id").distinct().select("design_id", F.explode(F.sequence(F.lit(0), F.lit(CAMERAS - 1))).alias("cam"))
    met = cams.join(stars, ["design_id", "cam"], "left")
    n = met.groupBy("design_id", "cam").agg(F.count("magnitude").alias("n"), F.count_if(F.col("magnitude") <= faintest).alias("n_bright"))
    total = n.groupBy("design_id").agg(F.lit(None).cast("int").alias("cam"), F.sum("n").alias("n"), F.sum("n_bright").alias("n_bright"))
    return n.unionByName(total.select(*n.columns))


def cameras_without_star(stars: DataFrame, ppc: DataFrame) -> DataFrame:
    """By pointing: empty cameras, and whether all are."""
    n = stars.where(F.col("cam").between(0, CAMERAS - 1)).groupBy("ppc_code").agg(F.count_distinct("cam").alias("__n"))
    out = ppc.select("ppc_code").join(n, "ppc_code", "left").withColumn("n_empty", F.lit(CAMERAS) - F.coalesce("__n", F.lit(0)))
    return out.withColumn("no_star", F.col("n_empty") == CAMERAS).drop("__n")


def magnitude_groups(targets: DataFrame, flux: str, group: list[str], brightest: float = 13.0) -> DataFrame:
    m = targets.withColumn("mag", magnitude(flux)).where("mag is not null")
    return m.groupBy(*group).agg(F.count("*").alias("n"), F.count_if(F.col("mag") < brightest).alias("n_bright"))


def magnitude_histogram(targets: DataFrame, flux: str, low: float = 13.0, high: float = 25.0, bins: int = 24) -> DataFrame:
    """Counts by bin 0..bins-1; the last bin holds its upper border."""
    m = targets.select(magnitude(flux).alias("mag")).where(F.col("mag").between(low, high))
    return m.groupBy(F.least(F.floor((F.col("mag") - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def proposal_counts(fiber: DataFrame, target_type: int = FLUXSTD) -> DataFrame:
    p = F.trim("proposal_id")
    return fiber.where((F.col("target_type") == target_type) & (p != "N/A")).groupBy(p.alias("proposal_id")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "proposal_id")


def duplicate_fibers(fiber: DataFrame) -> DataFrame:
    return with_aggregates(fiber, ["design_id", "fiber_id"], n=F.count("*")).where("n > 1")


def patrol_violations(fiber: DataFrame, cobra: DataFrame) -> DataFrame:
    """Fibres outside the reach of their arms (1) or in their blind spot (-1)."""
    met = fiber.join(cobra.select("cobra_id", F.col("x").alias("cx"), F.col("y").alias("cy"), "l1", "l2"), "cobra_id")
    side = beyond_patrol(F.col("x"), F.col("y"), F.col("cx"), F.col("cy"), F.col("l1"), F.col("l2"))
    return met.withColumn("side", side).where("side <> 0")


def bright_fibers(fiber: DataFrame, limit: float = 13.0) -> DataFrame:
    return fiber.where((known("psf_mag") < limit) | (known("total_mag") < limit))


def bright_guide_stars(stars: DataFrame, brightest: float = 0.0, limit: float = 12.0) -> DataFrame:
    return stars.where(F.col("magnitude").between(brightest, limit))


def bright_near_fibers(fiber: DataFrame, star: DataFrame, radius: float) -> DataFrame:
    """Unassigned working fibres within the radius (degrees, on the plane at
    the fibre) of a bright star, with the true separation in arc seconds."""
    s = with_cells_around(star.select("source_id", F.col("ra").alias("s_ra"), F.col("dec").alias("s_dec"), "g_mag"), radius, "s_ra", "s_dec")
    met = with_cell(fiber, radius).join(s, ["__b", "__c"]).where(flat_distance("ra", "dec", "s_ra", "s_dec") < radius)
    return met.withColumn("separation", separation("ra", "dec", "s_ra", "s_dec") * 3600).drop("__b", "__c")


def on_module(fiber: DataFrame, fibers_of_module: DataFrame, targets_n: DataFrame) -> DataFrame:
    """Fibres of a module that hold targets of the n arm: two semi joins. A
    module has some hundred fibres; these are sent to all tasks, since rows
    dealt by so few numbers would lie in a few tasks."""
    return fiber.join(F.broadcast(fibers_of_module.distinct()), "fiber_id", "left_semi").join(targets_n, "ob_code", "left_semi").distinct()


def report_flags(report: DataFrame) -> DataFrame:
    """Columns that say which figure of a design's report is out of range."""
    def pair(c: str) -> tuple[Column, Column]:
        p = count_pair(c)
        return F.get(p, F.lit(0)), F.get(p, F.lit(1))

    flags = {"flag_sky_sum": F.col("sky_sum") < 400, "flag_std_sum": F.col("std_sum") < 40, "flag_sky_min": F.col("sky_min") < 12, "flag_std_min": F.col("std_min") < 3, "flag_unfib": F.col("unfib_bright") > 0}
    n, bad = pair("ag_sum")
    flags["flag_ag_sum"] = (n < 10) | (bad > 0)
    for k in range(1, CAMERAS + 1):
        if f"ag{k}" in report.columns:
            n, bad = pair(f"ag{k}")
            flags[f"flag_ag{k}"] = (n < 2) | (bad > 0)
    for k in (1, 2):
        if f"inr{k}" in report.columns:
            flags[f"flag_inr{k}"] = F.abs(f"inr{k}") > 174
            flags[f"flag_el{k}"] = (F.col(f"el{k}") < 32) | (F.col(f"el{k}") > 75)
    return report.withColumns(flags)


def count_text(n: Column, bad: Column) -> Column:
    return F.when(bad > 0, F.concat(n.cast("string"), F.lit(" ("), bad.cast("string"), F.lit(")"))).otherwise(n.cast("string"))


