"""The domain's tables, made from the star schema: columns and the same as
SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workers import let_workers_import

RA, DEC = 137.508, 61.8034


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def sky(key: Column | str) -> tuple[Column, Column]:
    """A place on the sky for a key: RA in [0, 360), Dec in [-30, 90)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(k * RA, F.lit(360.0)), F.pmod(k * DEC, F.lit(120.0)) - 30


def sky_sql(key: str) -> str:
    return f"(({key}) * CAST({RA} AS DOUBLE)) % 360.0 AS ra, (({key}) * CAST({DEC} AS DOUBLE)) % 120.0 - 30 AS dec"


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target per line item, its proposal the customer of the order."""
    line, order, customer = (read(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    line = line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_linestatus")
    order = order.select("o_orderkey", "o_custkey", "o_orderpriority")
    order = order.join(customer.select("c_custkey", "c_acctbal", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    met = line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))  # the most rows last, so that they stay where orders are
    ra, dec = sky("l_partkey")
    medium = F.col("l_linestatus") == "O"
    return met.select(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("proposal_id"),
        F.concat_ws("_", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("ob_code"),
        F.col("l_orderkey").alias("obj_id"), F.col("l_partkey").alias("input_catalog_id"), F.when(medium, "M").otherwise("L").alias("resolution"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), (F.col("c_acctbal") / 1000).alias("rank"), F.col("c_mktsegment").alias("grade"),
        (F.col("l_quantity") * 900).alias("exptime_usr"), (F.round(F.col("l_discount") * 100) * F.col("l_quantity") * 90).alias("eff_done"),
        (F.col("o_custkey") % 40 + F.when(medium, 10).otherwise(0)).cast("double").alias("allocated_time_tac"), ra.alias("ra"), dec.alias("dec"),
    )


TARGETS = f"""tgt AS (
  SELECT 'P' || CAST(o_custkey AS VARCHAR) AS proposal_id,
         CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) || '_' || CAST(l_partkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR) AS ob_code,
         l_orderkey AS obj_id, l_partkey AS input_catalog_id, CASE WHEN l_linestatus = 'O' THEN 'M' ELSE 'L' END AS resolution,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority, c_acctbal / 1000 AS rank, c_mktsegment AS grade,
         l_quantity * 900 AS exptime_usr, round(l_discount * 100) * l_quantity * 90 AS eff_done,
         CAST(o_custkey % 40 + CASE WHEN l_linestatus = 'O' THEN 10 ELSE 0 END AS DOUBLE) AS allocated_time_tac, {sky_sql("l_partkey")}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def unique_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per code, with the time done and left. A code begins with its
    order, so the rows of a code lie where the order has met its line items:
    with it among the keys they needn't move again."""
    from ..operators.targets import keep_first

    once = keep_first(targets(spark, sf_dir), ["obj_id", "proposal_id", "ob_code"], ["exptime_usr", "eff_done", "resolution"])
    done = F.least(F.col("exptime_usr"), F.col("eff_done"))
    return once.withColumn("exptime_done", done).withColumn("exptime", F.col("exptime_usr") - done)


UNIQUE = (
    TARGETS
    + """,
once AS (
  SELECT *, least(exptime_usr, eff_done) AS exptime_done, exptime_usr - least(exptime_usr, eff_done) AS exptime
  FROM (SELECT *, row_number() OVER (PARTITION BY proposal_id, ob_code ORDER BY exptime_usr, eff_done, resolution) AS rn FROM tgt) WHERE rn = 1)"""
)

#: Remaining targets, with hours done by proposal and resolution.
REMAINING = (
    UNIQUE
    + """,
alloc AS (
  SELECT *, sum(exptime_done) OVER (PARTITION BY proposal_id, resolution) / 3600 AS allocated_time_done FROM once),
remain AS (
  SELECT *, greatest(0.0, allocated_time_tac - allocated_time_done) AS allocated_time, ceil(exptime / 900) * 900 AS "exptime_PPP",
         proposal_id || '_' || ob_code AS identify_code
  FROM alloc WHERE greatest(0.0, allocated_time_tac - allocated_time_done) > 0 AND exptime > 0)"""
)


#: What remaining time is computed from.
_TIMES = ("proposal_id", "ob_code", "resolution", "allocated_time_tac", "exptime_done", "exptime")


def remaining_targets(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """columns: those that are wanted beside codes and times, so that no others
    are moved and written; all if None."""
    from ..operators.targets import remaining, with_allocation

    once = unique_targets(spark, sf_dir)
    return remaining(with_allocation(once if columns is None else once.select(*_TIMES, *columns)))


def places(spark: SparkSession, sf_dir: str, table: str, key: str, prefix: str) -> DataFrame:
    """(prefix_id, ra, dec) for the rows of a table."""
    ra, dec = sky(key)
    return read(spark, sf_dir, table).select(F.col(key).alias(f"{prefix}_id"), ra.alias("ra"), dec.alias("dec"))


SEPARATION = """degrees(atan2(sqrt(
    pow(cos(radians({d2})) * sin(radians({r2} - {r1})), 2)
  + pow(cos(radians({d1})) * sin(radians({d2})) - sin(radians({d1})) * cos(radians({d2})) * cos(radians({r2} - {r1})), 2)),
    sin(radians({d1})) * sin(radians({d2})) + cos(radians({d1})) * cos(radians({d2})) * cos(radians({r2} - {r1}))))"""


def separation_sql(a: str, b: str) -> str:
    return SEPARATION.format(r1=f"{a}.ra", d1=f"{a}.dec", r2=f"{b}.ra", d2=f"{b}.dec")
