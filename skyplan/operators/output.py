"""Flat outputs, exports and exposure frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import design_hex
from .numbering import numbered

#: The export's columns.
PPC_COLUMNS = (
    "ppc_code", "ppc_ra", "ppc_dec", "ppc_pa", "ppc_equinox", "ppc_priority", "ppc_priority_usr", "ppc_exptime", "ppc_totaltime",
    "ppc_resolution", "ppc_fiber_usage_frac", "ppc_allocated_targets", "ppc_comment",
)


def allocations(ppc: DataFrame) -> DataFrame:
    return ppc.select("ppc_code", F.explode("ppc_allocated_targets").alias("identify_code"))


def allocated_counts(ppc: DataFrame, target: DataFrame, single: float) -> DataFrame:
    """Seconds that the pointings give to each target, 0 for the others."""
    n = allocations(ppc).groupBy("identify_code").agg(F.count("*").alias("__n"))
    return target.join(n, "identify_code", "left").withColumn("exptime_assign", F.coalesce("__n", F.lit(0)) * single).drop("__n")


def plan_output(ppc: DataFrame, schedule: DataFrame, target: DataFrame) -> DataFrame:
    """A row per scheduled pointing and target; pointings without a slot and
    ids without a target drop out."""
    slots = ppc.join(schedule.select("ppc_code", "obstime"), "ppc_code")
    each = slots.withColumn("identify_code", F.explode("ppc_allocated_targets")).drop("ppc_allocated_targets")
    return each.join(target, "identify_code").withColumn("obsdate_in_hst", F.date_sub(F.to_date("obstime"), 1))


def export_pointings(ppc: DataFrame, classic: bool = False, single: float = 900.0) -> DataFrame:
    """The export's columns in order, gaps filled."""
    have = set(ppc.columns)
    ranked = ppc if "ppc_priority" in have else numbered(ppc, [F.col("ppc_code")], "__rank")

    def given(c: str, default: Column) -> Column:
        return F.coalesce(F.col(c), default) if c in have else default

    rank = F.col("ppc_priority") if "ppc_priority" in have else F.col("__rank").cast("double")
    usr = given("ppc_priority_usr", rank)
    absent = {} if "ppc_priority" in have else {"ppc_priority": rank}
    values = absent | {
        "ppc_equinox": given("ppc_equinox", F.lit("J2000")), "ppc_priority_usr": usr, "ppc_exptime": given("ppc_exptime", F.lit(single if classic else 900.0)),
        "ppc_totaltime": given("ppc_totaltime", F.lit(single + 300 if classic else 1200.0)), "ppc_comment": given("ppc_comment", F.lit("")),
        "ppc_fiber_usage_frac": given("ppc_fiber_usage_frac", F.lit(None).cast("double")), "ppc_allocated_targets": given("ppc_allocated_targets", F.array().cast("array<string>")),
    }
    return ranked.withColumns(values).select(*[c for c in PPC_COLUMNS if c in have or c in values])


def export_targets(target: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Renamed columns with the constant equinox."""
    same = {c: f"ob_{c}" for c in target.columns if c not in ("proposal_id", "allocated_time_tac", "qa_reference_arm", "rank", "rank_fin", "obj_id", "input_catalog_id", "ob_code")}
    special = {"rank": "proposal_rank", "rank_fin": "ob_weight_best", "obj_id": "ob_obj_id", "input_catalog_id": "ob_cat_id"}
    renamed = target.withColumnsRenamed(same | special | (names or {}))
    return renamed.withColumn("ob_equinox", F.lit("J2000"))


def exposure_frames(pointings: DataFrame, long_seconds: float = 1800.0) -> DataFrame:
    """pointings (ppc_code, total_exptime, n_split) -> a row per block with
    its number of frames: at least two frames, blocks of as many as fill
    long_seconds (at least two), the last one shorter."""
    n = F.greatest(F.lit(2), F.col("n_split"))
    rows = pointings.withColumn("n_frames", n).withColumn("single_exptime", F.col("total_exptime") / F.col("n_frames"))
    rows = rows.withColumn("per_block", F.greatest(F.lit(2), F.ceil(long_seconds / F.col("single_exptime"))).cast("int"))
    blocks = F.sequence(F.lit(0), F.ceil(F.col("n_frames") / F.col("per_block")).cast("int") - 1)
    rows = rows.withColumn("block", F.explode(blocks))
    return rows.withColumn("nframe", F.least(F.col("per_block"), F.col("n_frames") - F.col("block") * F.col("per_block")))


def exposure_lines(frames: DataFrame, template: str) -> DataFrame:
    """The template's literal marks filled for each block."""
    text = F.lit(template)
    for mark, value in (('DESIGN_ID="designId"', F.concat(F.lit('DESIGN_ID="'), design_hex("design_id"), F.lit('"'))), ('"objectname"', F.concat(F.lit('"'), F.col("ppc_code"), F.lit('"'))),
                        ('"exptime"', F.concat(F.col("single_exptime").cast("string"), F.lit(" NFRAME="), F.col("nframe").cast("string")))):
        text = F.replace(text, F.lit(mark), value)
    return frames.withColumn("text", text)


def template_sections(lines: DataFrame, key: str) -> DataFrame:
    """lines (key, n, line) -> section 0, 1 or 2: before, between and after the
    marks of the science block of each template."""
    begin, end = F.col("line").startswith("### SCIENCE:START"), F.col("line").startswith("### SCIENCE:END")
    w = Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("section", F.sum(begin.cast("int")).over(w) + F.coalesce(F.sum(end.cast("int")).over(before), F.lit(0)))


def merge_index(science: DataFrame, standard: DataFrame, sky: DataFrame) -> DataFrame:
    """One list of the three, in this order, with a running index; offsets are
    the sizes of the lists before, so each is numbered apart."""
    out, offset = None, 0
    for kind, df in enumerate((science, standard, sky)):
        rows = numbered(df.select("obj_id", "cobra_id", F.lit(kind).alias("kind")), [F.col("cobra_id"), F.col("obj_id")], "idx")
        rows = rows.withColumn("idx", F.col("idx") - 1 + offset)
        offset += df.count()
        out = rows if out is None else out.unionByName(rows)
    return out


def pointing_codes(ppc: DataFrame, resolution: str, date: str, order: str, backup: bool = False) -> DataFrame:
    parts = [F.lit("que"), F.lit(resolution), F.lit(date), F.col("__n").cast("string")] + ([F.lit("backup")] if backup else [])
    return numbered(ppc, [F.col(order)], "__n").withColumn("ppc_code", F.concat_ws("_", *parts)).drop("__n")


def target_class(priority: Column | str) -> Column:
    p = F.col(priority) if isinstance(priority, str) else priority
    return F.concat(F.lit("sci_P"), p.cast("int").cast("string"))


def later_wins(*tables: DataFrame, key: str) -> DataFrame:
    """Rows of all tables by key; of equal keys that of the last table."""
    marked = [t.withColumn("__s", F.lit(i)) for i, t in enumerate(tables)]
    out = marked[0]
    for t in marked[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(F.col("__s").desc())
    return out.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__s", "__n")


#: The summary's columns.
SUMMARY_COLUMNS = ("ppc_code", "ppc_ra", "ppc_dec", "ppc_pa", "design_filename", "pfsDesignId", "ppc_exptime", "ppc_nframes", "ppc_obstime_utc", "ppc_obstime")


def reconfigure_summary(ppc: DataFrame) -> DataFrame:
    """Pointings with the file of their design."""
    return ppc.withColumn("design_filename", F.concat(F.lit("pfsDesign-"), design_hex("pfsDesignId"), F.lit(".fits"))).select(*SUMMARY_COLUMNS)


def with_rotator(report: DataFrame, design: DataFrame) -> DataFrame:
    """The rotator's angles and elevations of each design's report, by its id."""
    return report.join(design.select("design_id", "inr1", "inr2", "el1", "el2"), "design_id", "left")


def with_fiber_place(fiber: DataFrame, places: DataFrame) -> DataFrame:
    """The place of each fibre on the focal plane, null where none is known."""
    return fiber.join(places.select("fiber_id", "x", "y"), "fiber_id", "left")


def status_color(status: Column | str) -> Column:
    s = F.col(status) if isinstance(status, str) else status
    return F.when(s == "done", "green").when(s == "running", "orange").when(s == "pending", "gray")
