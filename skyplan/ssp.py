"""Pointings that come with their own target lists, from the files to
exposures: the lists are read, every rule is applied to all of them at once,
and pointings that can't be observed go.

    <root>/<wg>/ppcList.ecsv, <root>/<wg>/<science, sky, fluxstd>/<ppc_code>.ecsv

run() writes each step's result under a folder and reads it again."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import output, triples
from .operators.design import CAMERAS, cameras_without_star
from .sources import datasource, tables

STEPS = ("lists", "columns", "pointings", "targets", "violations", "frames")
LIST_SCHEMA = "ppc_code string, ppc_ra double, ppc_dec double, ppc_pa double, ppc_resolution string, ppc_obstime string, ppc_exptime double, ppc_nframes int"


def list_rules(ppc: DataFrame, stars: DataFrame) -> DataFrame:
    """Violations of the lists of pointings themselves, of the form that
    triples.check() gives: codes that a group has twice, one frame or none,
    times in no known form, and cameras without a guide star."""
    kind, code = F.lit("ppc").alias("kind"), ("wg", "ppc_code")

    def of(df: DataFrame, rule: str, item: str, n: str = "1") -> DataFrame:
        return df.select(*code, kind, F.lit(rule).alias("rule"), F.expr(item).cast("string").alias("item"), F.expr(n).cast("long").alias("n"))

    twice = of(ppc.groupBy(*code).agg(F.count("*").alias("__n")).where("__n > 1"), "duplicate", "concat('ppc_code=', ppc_code)", "__n")
    frames = of(ppc.where("coalesce(ppc_nframes, 0) <= 1"), "nframes", "ppc_nframes")
    times = of(ppc.where("ppc_obstime_utc is null"), "obstime", "ppc_obstime")
    empty = cameras_without_star(stars, ppc.select("ppc_code").distinct()).where("n_empty > 0")
    blind = of(ppc.select(*code).distinct().join(empty, "ppc_code"), "cameras_without_star", f"concat(n_empty, ' of {CAMERAS}')", "n_empty")
    return twice.unionByName(frames).unionByName(times).unionByName(blind)


def run(spark: SparkSession, root: str, stars: DataFrame, folder: str, proposals: Iterable[str], catalogs: Mapping[str, Iterable[int]], groups: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """stars (ppc_code, cam): guide stars by camera 0..5; catalogs: allowed ids
    by kind; groups: those to plan, else all. Pointings whose time is the text
    nan aren't planned; of the others those stay that have three lists, a guide
    star and a time."""
    only = None if groups is None else {"wg": list(groups)}
    done: dict[str, DataFrame] = {}

    def step(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        done[name] = spark.read.parquet(f"{folder}/{name}")
        return done[name]

    given = datasource.pointing_lists(spark, root, LIST_SCHEMA)
    given = given if only is None else given.where(F.col("wg").isin(only["wg"]))
    ppc = step("lists", tables.with_obstime(given))
    columns = step("columns", datasource.pointing_columns(spark, root, only))
    kept = step("pointings", triples.usable(ppc, columns, stars).where("ppc_obstime_utc is not null"))
    # lists of pointings that aren't planned are none of this run's
    planned = ppc.select("wg", "ppc_code").distinct()
    mine = columns.join(planned, ["wg", "ppc_code"], "left_semi")
    rows = triples.with_fallbacks(datasource.pointing_tables(spark, root, triples.SCHEMA, only), columns)
    rows = step("targets", rows.join(planned, ["wg", "ppc_code"], "left_semi"))
    step("violations", list_rules(ppc, stars).unionByName(triples.check(rows, mine, planned, proposals, catalogs)))
    timed = kept.withColumns({"total_exptime": F.col("ppc_exptime"), "n_split": F.col("ppc_nframes")})
    step("frames", output.exposure_frames(timed))
    return done
