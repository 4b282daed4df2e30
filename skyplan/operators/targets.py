"""Targets: derived columns, filters, joins, deduplication and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import ceil_to, filled, identify_code, known, text_or_null
from .keyed import with_aggregates
from .lineage import cut_lineage
from .numbering import numbered

BANDS = ("g", "r", "i", "z", "y")
FLUX_COLUMNS = tuple(f"{kind}_flux_{part}{b}" for kind in ("psf", "total") for part in ("", "error_") for b in BANDS)


def order_of(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by a total order (nulls are equal keys)."""
    w = Window.partitionBy(*keys).orderBy(*order_of(order))
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def all_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key occurs more than once."""
    return with_aggregates(df, keys, __n=F.count("*")).where("__n > 1").select(*df.columns)


def union_all(*tables: DataFrame | None) -> DataFrame:
    """Rows of all tables, with the columns of any."""
    given = [t for t in tables if t is not None]
    if not given:
        raise ValueError("no table to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), given)


def combine_resolutions(low: DataFrame | None, medium: DataFrame | None) -> DataFrame:
    return union_all(low, medium)


def active_targets(target: DataFrame, proposal: DataFrame, catalog: DataFrame, proposal_ids: list[str] | None = None) -> DataFrame:
    """Targets of active catalogues with their proposal; the planner chooses
    the joins by the sizes of the small sides."""
    t = target if proposal_ids is None else target.where(F.col("proposal_id").isin(proposal_ids))
    active = catalog.where("active").select("input_catalog_id")
    return t.join(active, "input_catalog_id").join(proposal, "proposal_id")


def from_database(rows: DataFrame) -> DataFrame:
    """Names, resolution, allocated time and proper motion of database rows."""
    medium = F.coalesce(F.col("is_medium_resolution"), F.lit(False))
    out = rows.withColumnsRenamed({"epoch": "equinox", "effective_exptime": "exptime_usr"})
    out = out.withColumns({
        "resolution": F.when(medium, "M").otherwise("L"),
        "allocated_time_tac": F.when(medium, F.col("allocated_time_mr")).otherwise(F.col("allocated_time_lr")),
        "pmra": filled("pmra"), "pmdec": filled("pmdec"),
        "parallax": F.when(filled("parallax") == 0, F.lit(1e-7)).otherwise(known("parallax")),
    }).drop("is_medium_resolution", "allocated_time_lr", "allocated_time_mr")
    return out.withColumns({c: known(F.col(c).try_cast("double")) for c in FLUX_COLUMNS if c in out.columns})


def user_pointings(pointing: DataFrame, catalog: DataFrame) -> DataFrame:
    """Pointings that users gave for active classical catalogues, once each."""
    right = catalog.where("active and is_classical and is_user_pointing").select("input_catalog_id")
    found = pointing.join(right, "input_catalog_id").withColumn("ppc_priority", filled("ppc_priority"))
    return keep_first(found, ["ppc_ra", "ppc_dec", "ppc_pa", "ppc_resolution"], ["user_pointing_id"])


def with_progress(target: DataFrame, log: DataFrame) -> DataFrame:
    """Time done and left of each target, from the log of executed ones."""
    done = log.groupBy(F.col("psl_id").alias("__p"), F.col("ob_code").alias("__o")).agg(F.max("eff_exptime_done_real").alias("eff_exptime_done_real"))
    met = target.join(done, (F.col("proposal_id") == F.col("__p")) & (F.col("ob_code") == F.col("__o")), "left").drop("__p", "__o")
    spent = F.least(filled("exptime_usr"), filled("eff_exptime_done_real"))
    return met.withColumn("exptime_done", spent).withColumn("exptime", F.col("exptime_usr") - F.col("exptime_done"))


def with_allocation(target: DataFrame, keys: tuple[str, ...] = ("proposal_id", "resolution")) -> DataFrame:
    """Hours done by proposal and resolution, and those left to allocate."""
    target = cut_lineage(target)  # read for the sums and for the rows
    met = with_aggregates(target, list(keys), allocated_time_done=F.sum("exptime_done") / 3600)
    return met.withColumn("allocated_time", F.greatest(F.lit(0.0), F.col("allocated_time_tac") - F.col("allocated_time_done")))


def remaining(target: DataFrame, step: float = 900.0) -> DataFrame:
    """Targets that still have time, with it in whole exposures."""
    left = target.where("allocated_time > 0 and exptime > 0")
    return left.withColumn("exptime_PPP", ceil_to("exptime", step)).withColumn("identify_code", identify_code("proposal_id", "ob_code"))


def classic_defaults(target: DataFrame) -> DataFrame:
    """Exposure and allocation of classical targets: if any allocation is
    below 0, all are the sum of the exposures."""
    out = target.withColumn("exptime", F.coalesce("exptime", "exptime_usr")).withColumn("allocated_time", F.coalesce("allocated_time", "allocated_time_tac"))
    total = out.agg((F.sum("exptime") / 3600).alias("__total"), F.max((F.col("allocated_time") < 0).cast("int")).alias("__any"))
    out = out.crossJoin(total)  # one row
    return out.withColumn("allocated_time", F.when(F.col("__any") == 1, F.col("__total")).otherwise(F.col("allocated_time"))).drop("__total", "__any")


def apply_policies(target: DataFrame, policy: DataFrame) -> DataFrame:
    """Rewrites by proposal, in a fixed order. policy: proposal_id and, each
    nullable, single_exptime, priority_exptime map<int,double>,
    catalog_offset map<long,int>, exptime_from array<double>, exptime_to,
    ra_below, ra_exptime."""
    p = target.join(policy, "proposal_id", "left")
    p = p.withColumn("single_exptime", F.coalesce("policy_single_exptime", "single_exptime"))
    p = p.withColumn("exptime", F.coalesce(F.col("priority_exptime")[F.col("priority")], "exptime"))
    p = p.withColumn("priority", F.col("priority") + F.coalesce(F.col("catalog_offset")[F.col("input_catalog_id")], F.lit(0)))
    p = p.withColumn("exptime", F.when(F.array_contains("exptime_from", F.col("exptime")), F.col("exptime_to")).otherwise(F.col("exptime")))
    p = p.withColumn("exptime", F.when(F.col("ra") < F.col("ra_below"), F.col("ra_exptime")).otherwise(F.col("exptime")))
    return p.select(*target.columns)


def clean_filters(df: DataFrame, bands: tuple[str, ...] = BANDS) -> DataFrame:
    """Sentinels of missing filters become `none`; 9e-05 stands for no value."""
    names = {f"filter_{b}": F.coalesce(text_or_null(f"filter_{b}"), F.lit("none")) for b in bands if f"filter_{b}" in df.columns}
    values = {c: F.when(F.col(c) != 9e-05, F.col(c)) for c, t in df.dtypes if t == "double"}
    return df.withColumns(names | values)


def pointing_metadata(ppc: DataFrame, resolution: str | None = None) -> DataFrame:
    """Position angle and priority with gaps filled; the index counts all
    pointings, before the filter on resolution."""
    out = numbered(ppc, [F.col("ppc_code")], "idx").withColumn("idx", F.col("idx") - 1)
    finite = known("ppc_pa")
    out = out.withColumn("ppc_pa", F.when(F.abs(finite) < float("inf"), finite)).withColumn("ppc_priority", filled("ppc_priority"))
    return out if resolution is None else out.where(F.col("ppc_resolution") == resolution)


def same_single_exposure(target: DataFrame, column: str = "single_exptime") -> DataFrame:
    """The rows if they have one exposure time, else none."""
    one = target.agg(F.count_distinct(column).alias("__n"))
    return target.crossJoin(one).where("__n = 1").drop("__n")


def single_proposal(target: DataFrame) -> str | None:
    """The one proposal of the targets, if it is one."""
    found = target.select("proposal_id").distinct().limit(2).collect()
    return found[0][0] if len(found) == 1 else None


def unexpected(values: DataFrame, allowed: DataFrame) -> DataFrame:
    """Distinct rows that aren't allowed."""
    return values.subtract(allowed)


def undo_priority_offset(target: DataFrame, offsets: DataFrame) -> DataFrame:
    """offsets: proposal_id, input_catalog_id, offset."""
    met = target.join(offsets, ["proposal_id", "input_catalog_id"], "left")
    return met.withColumn("priority", F.col("priority") - F.coalesce("offset", F.lit(0))).drop("offset")


def near_equal_chunks(df: DataFrame, k: int, order: list[str]) -> DataFrame:
    """A chunk number in 1..k, the first chunks one longer if need be."""
    size, longer = divmod(df.count(), k)
    at = F.col("__p") - 1
    in_longer = F.floor(at / (size + 1)) + 1
    in_others = F.floor((at - longer * (size + 1)) / max(size, 1)) + longer + 1
    chunk = F.when(at < longer * (size + 1), in_longer).otherwise(in_others)
    return numbered(df, order_of(order), "__p").withColumn("chunk", chunk.cast("int")).drop("__p")


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows in the order of a hash of the key: the same rows every time."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)
