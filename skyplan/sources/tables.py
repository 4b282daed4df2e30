"""Readers and writers of the domain's tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalar import is_date, parse_hst
from ..operators.targets import union_all

SECONDS_PER_EXPOSURE = 450.0


def conform(df: DataFrame, schema: str | StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """The schema's columns in order: cast, absent ones null, nulls defaulted."""
    want = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    have, defaults = {c.lower(): c for c in df.columns}, defaults or {}

    def column(f):
        c = F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)
        c = c.cast(f.dataType)
        return (F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType)) if f.name in defaults else c).alias(f.name)

    return df.select(*[column(f) for f in want.fields])


def read_any(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV, ECSV (CSV behind # lines, blank-separated) or Parquet by ending."""
    if path.rstrip("/").endswith(".ecsv"):
        reader = spark.read.option("header", True).option("comment", "#").option("sep", " ").option("nullValue", '""')
        return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    if path.rstrip("/").endswith(".csv"):
        reader = spark.read.option("header", True).option("comment", "#")
        return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    return spark.read.parquet(path)


def optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, or an empty one if there is none."""
    try:
        return conform(read_any(spark, path), schema)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def with_backup(spark: SparkSession, main: str, backup: str, schema: str) -> DataFrame:
    """Main and optional backup table, marked."""
    return optional(spark, main, schema).withColumn("is_backup", F.lit(False)).unionByName(optional(spark, backup, schema).withColumn("is_backup", F.lit(True)))


def read_through(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at path if it can be read, else what make() gives, written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        make().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


def from_jdbc(spark: SparkSession, url: str, table: str, proposal_ids: list[str] | None = None, **options: str) -> DataFrame:
    """A database table; the proposals' filter is pushed to the database."""
    df = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return df if proposal_ids is None else df.where(F.col("proposal_id").isin(proposal_ids))


def user_pointing_files(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """One file as it is; of several, codes get the file's number, in order."""
    files = sorted(paths)
    tables = [read_any(spark, p) for p in files]
    if len(tables) == 1:
        return tables[0]
    return union_all(*[t.withColumn("ppc_code", F.concat(F.col("ppc_code"), F.lit(f"_{i}"))) for i, t in enumerate(tables, 1)])


def executed_log(observed: DataFrame, stats: DataFrame) -> DataFrame:
    """Executed targets with their effective time, which isn't below 0, and
    450 s for each exposure."""
    met = observed.join(stats, ["psl_id", "ob_code"]).where("eff_exptime_done_real >= 0")
    return met.withColumn("exptime_done_real", F.col("n_exposures") * SECONDS_PER_EXPOSURE)


def complete_triples(files: DataFrame) -> DataFrame:
    """files (wg, ppc_code, kind, ...): the rows of pointings that have all of
    science, sky and fluxstd."""
    whole = files.groupBy("wg", "ppc_code").agg(F.count_distinct("kind").alias("n")).where("n = 3").select("wg", "ppc_code")
    return files.join(whole, ["wg", "ppc_code"], "left_semi")


def with_obstime(ppc: DataFrame, column: str = "ppc_obstime") -> DataFrame:
    """Rows with a time, and it in UTC."""
    ok = F.lower(F.trim(column)) != "nan"
    return ppc.where(ok).withColumn("ppc_obstime_utc", parse_hst(column)).withColumn("has_date", is_date(column))


def design_summary(rows: DataFrame, ssp: bool, slot_seconds: float = 1260.0) -> DataFrame:
    """Start and stop of each design: a fixed slot, or each one's exposure."""
    start = F.to_timestamp("ppc_obstime_utc" if ssp else "observation_time")
    seconds = F.col("ppc_exptime") if ssp else F.lit(slot_seconds)
    return rows.withColumn("start", start).withColumn("stop", start + F.make_interval(secs=seconds))


def result_times(rows: DataFrame) -> DataFrame:
    return rows.withColumn("obstime", F.to_timestamp(F.substring("obstime", 1, 19)))


def n_arm_targets(rows: DataFrame) -> DataFrame:
    return rows.where(F.lower(F.trim("qa_reference_arm")) == "n")


def proposal_list(proposal: DataFrame) -> DataFrame:
    """Ids with the investigator's name, null if a part is."""
    return proposal.select("proposal_id", F.concat("pi_first_name", "pi_middle_name", "pi_last_name").alias("PI"))


def write_csv(df: DataFrame, path: str, as_text: bool = False) -> None:
    """CSV with a header; with as_text each value as its string."""
    out = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]) if as_text else df
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(f"`{c}`") for c, t in out.dtypes]
    out.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def write_lines(df: DataFrame, path: str, order: list[str]) -> None:
    """A column `text` as lines, ordered across files."""
    df.orderBy(*order).select("text").write.mode("overwrite").text(path)


def desired_first(columns: list[str], desired: list[str]) -> list[str]:
    return [c for c in desired if c in columns] + [c for c in columns if c not in desired]
