"""Queries on fibre designs, magnitudes, reports and input rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators import design, targets, validate
from ..sources import config as C
from ..sources import tables as S
from . import query
from .binding import read

_FIBER = """fib AS (
  SELECT l_orderkey AS design_id, l_linenumber AS fiber_id, CAST(l_partkey % 4 + 1 AS INTEGER) AS target_type, CAST(l_suppkey % 3 AS INTEGER) AS fiber_status,
         'P' || CAST(l_partkey % 10 AS VARCHAR) AS proposal_id, CAST(l_partkey AS VARCHAR) AS ob_code FROM lineitem)"""


def _fiber(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("l_partkey")
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("design_id"), F.col("l_linenumber").alias("fiber_id"), (p % 4 + 1).cast("int").alias("target_type"), (F.col("l_suppkey") % 3).cast("int").alias("fiber_status"),
        F.concat(F.lit("P"), (p % 10).cast("string")).alias("proposal_id"), p.cast("string").alias("ob_code"),
    )


@query(f"""
WITH {_FIBER}
SELECT design_id, count(*) FILTER (WHERE target_type = 1 AND proposal_id NOT IN ('P0', 'P4')) AS n_sci, count(*) FILTER (WHERE target_type = 1 AND proposal_id IN ('P0', 'P4')) AS n_filler,
       count(*) FILTER (WHERE target_type = 2) AS n_sky, count(*) FILTER (WHERE target_type = 3) AS n_fstar, count(*) FILTER (WHERE target_type = 4 AND fiber_status = 1) AS n_blank,
       round(count(*) FILTER (WHERE target_type = 1 AND proposal_id NOT IN ('P0', 'P4')) / 2394 * 100, 6) AS usage FROM fib GROUP BY design_id
""")
def design_fibre_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return design.fiber_counts(_fiber(spark, sf_dir), ["P0", "P4"]).withColumn("usage", F.round("usage", 6))


@query(f"""
WITH {_FIBER}
SELECT design_id, count(*) FILTER (WHERE target_type = 1) AS "1", count(*) FILTER (WHERE target_type = 2) AS "2", count(*) FILTER (WHERE target_type = 3) AS "3", count(*) FILTER (WHERE target_type = 4) AS "4" FROM fib GROUP BY design_id
""")
def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return design.type_counts(_fiber(spark, sf_dir))


@query(f"WITH {_FIBER} SELECT ob_code, count(DISTINCT design_id) * 900.0 AS exptime_expected FROM fib GROUP BY ob_code")
def expected_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return design.expected_seconds(_fiber(spark, sf_dir))


@query(f"WITH {_FIBER} SELECT proposal_id, count(*) AS n FROM fib WHERE target_type = 3 AND proposal_id <> 'N/A' GROUP BY proposal_id")
def standards_by_proposal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return design.proposal_counts(_fiber(spark, sf_dir))


@query(f"""
WITH {_FIBER} SELECT DISTINCT * FROM fib WHERE fiber_id IN (SELECT l_linenumber FROM lineitem WHERE l_linenumber % 2 = 0) AND ob_code IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size < 10)
""")
def module_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = read(spark, sf_dir, "lineitem").where("l_linenumber % 2 = 0").select(F.col("l_linenumber").alias("fiber_id")).distinct()
    small = read(spark, sf_dir, "part").where("p_size < 10").select(F.col("p_partkey").cast("string").alias("ob_code"))
    return design.on_module(_fiber(spark, sf_dir), even, small)


@query(f"WITH {_FIBER} SELECT design_id, fiber_id, ob_code, n FROM (SELECT *, count(*) OVER (PARTITION BY design_id, fiber_id) AS n FROM fib) WHERE n > 1")
def duplicate_fibres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return design.duplicate_fibers(_fiber(spark, sf_dir)).select("design_id", "fiber_id", "ob_code", "n")


_MAG = "m AS (SELECT p_brand, p_size, CASE WHEN f > 0 THEN 23.9 - 2.5 * log10(f / 1e3) END AS mag FROM (SELECT *, pow(1.2, p_size) * (p_retailprice - 950) AS f FROM part))"


def _flux(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_brand", "p_size", (F.pow(F.lit(1.2), F.col("p_size")) * (F.col("p_retailprice") - 950)).alias("f"))


@query(f"WITH {_MAG} SELECT CAST(least(floor((mag - 13) / 0.5), 23) AS INTEGER) AS bin, count(*) AS n FROM m WHERE mag BETWEEN 13 AND 25 GROUP BY 1")
def magnitude_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return design.magnitude_histogram(_flux(spark, sf_dir), "f")


@query(f"WITH {_MAG} SELECT p_brand, count(*) AS n, count(*) FILTER (WHERE mag < 18) AS n_bright FROM m WHERE mag IS NOT NULL GROUP BY p_brand")
def magnitude_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return design.magnitude_groups(_flux(spark, sf_dir), "f", ["p_brand"], 18.0)


@query("""
WITH r AS (SELECT o_orderkey AS k, o_custkey % 800 AS sky, o_custkey % 80 AS std, o_custkey % 24 AS smin, o_custkey % 6 AS tmin, o_custkey % 20 AS a, o_custkey % 3 AS b, o_custkey % 360 - 180 AS inr, o_custkey % 90 AS el FROM orders)
SELECT k, sky < 400 AS flag_sky_sum, std < 40 AS flag_std_sum, smin < 12 AS flag_sky_min, tmin < 3 AS flag_std_min, a < 10 OR b > 0 AS flag_ag_sum, abs(inr) > 174 AS flag_inr1, el < 32 OR el > 75 AS flag_el1, b > 0 AS flag_unfib,
       CASE WHEN b > 0 THEN CAST(a AS VARCHAR) || ' (' || CAST(b AS VARCHAR) || ')' ELSE CAST(a AS VARCHAR) END AS ag_sum FROM r
""")
def report_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("o_custkey")
    r = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), (c % 800).alias("sky_sum"), (c % 80).alias("std_sum"), (c % 24).alias("sky_min"), (c % 6).alias("std_min"), design.count_text(c % 20, c % 3).alias("ag_sum"),
        (c % 360 - 180).alias("inr1"), (c % 90).alias("el1"), (c % 3).alias("unfib_bright"),
    )
    names = ("sky_sum", "std_sum", "sky_min", "std_min", "ag_sum", "inr1", "el1", "unfib")
    return design.report_flags(r).select("k", *[f"flag_{n}" for n in names], "ag_sum")


@query("""
WITH s AS (SELECT l_orderkey AS obj, CAST(l_linenumber AS VARCHAR) AS code, l_partkey AS cat, l_quantity AS q FROM lineitem)
SELECT 'duplicate_obj' AS rule, CAST(obj AS VARCHAR) AS key, CAST(count(*) AS VARCHAR) || ' ' || min(code) || ' ' || max(code) AS detail FROM s GROUP BY obj HAVING count(*) > 1
UNION ALL SELECT 'catalog', CAST(cat AS VARCHAR), 'input_catalog_id' FROM (SELECT DISTINCT cat FROM s) WHERE cat NOT IN (SELECT p_partkey FROM part WHERE p_size < 40)
UNION ALL SELECT 'target_type', CAST(obj AS VARCHAR), CAST(CAST(q AS BIGINT) % 2 AS VARCHAR) FROM s WHERE CAST(q AS BIGINT) % 2 <> 1
UNION ALL SELECT 'flux', CAST(obj AS VARCHAR), 'total' FROM s WHERE q <= 10
UNION ALL SELECT 'required_column', 'science', k FROM (SELECT unnest(['ra', 'dec', 'proposal_id', 'priority', 'effective_exptime', 'cobraId']) AS k)
""")
def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem")
    flux = {f"total_flux_{b}": F.col("l_quantity") - 10 if b == "g" else F.lit(float("nan")) for b in targets.BANDS}
    t = line.select(F.col("l_orderkey").alias("obj_id"), F.col("l_linenumber").cast("string").alias("ob_code"), F.col("l_partkey").alias("input_catalog_id"), (F.col("l_quantity").cast("long") % 2).alias("target_type_id"), *[c.alias(n) for n, c in flux.items()])
    allowed = read(spark, sf_dir, "part").where("p_size < 40").select("p_partkey")
    return validate.all_rules(
        validate.duplicates(t, "obj_id", "ob_code", "duplicate_obj"), validate.outside_set(t, "input_catalog_id", allowed, "catalog"),
        validate.target_type(t, "science", "obj_id"), validate.fluxes(t, "science", "obj_id"), validate.missing_columns(t, "science"),
    )


@query("""
WITH p AS (SELECT o_custkey AS ppc_code, o_totalprice AS ra, o_orderkey % 3 AS nf FROM orders)
SELECT 'duplicate_ppc_code' AS rule, CAST(ppc_code AS VARCHAR) AS key, CAST(count(*) AS VARCHAR) || ' ' || CAST(CAST(min(nf) AS BIGINT) AS VARCHAR) || ' ' || CAST(CAST(max(nf) AS BIGINT) AS VARCHAR) AS detail FROM p GROUP BY ppc_code HAVING count(*) > 1
UNION ALL SELECT 'nframes', CAST(ppc_code AS VARCHAR), CAST(nf AS VARCHAR) FROM p WHERE nf <= 1
""")
def pointing_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return validate.pointing_rules(o.select(F.col("o_custkey").alias("ppc_code"), (F.col("o_orderkey") % 3).alias("ppc_ra"), (F.col("o_orderkey") % 3).alias("ppc_nframes")))


@query("""
SELECT o_orderkey AS k, '0x' || lpad(lower(to_hex(o_orderkey * 1000003)), 16, '0') AS hex, o_orderkey * 1000003 AS back FROM orders
""")
def design_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("o_orderkey") * 1000003
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), X.design_hex(i).alias("hex"))
    return o.select("k", "hex", X.design_of_name(F.concat(F.lit("design-"), "hex", F.lit(".fits"))).alias("back"))


@query("""
SELECT p_partkey, CASE WHEN lower(trim(p_name)) IN ('', 'nan', 'none', '--', '[]', '0.0') OR p_size % 5 = 0 THEN 'none' ELSE p_name END AS filter_g, CASE WHEN p_size % 7 <> 0 THEN p_retailprice END AS p_retailprice FROM part
""")
def clean_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, s = read(spark, sf_dir, "part"), F.col("p_size")
    rows = p.select("p_partkey", F.when(s % 5 == 0, "--").otherwise(F.col("p_name")).alias("filter_g"), F.when(s % 7 == 0, 9e-05).otherwise(F.col("p_retailprice")).alias("p_retailprice"))
    return targets.clean_filters(rows)


@query("""
SELECT e.event_id, CASE WHEN k = 0 THEN 1.5 WHEN k = 1 THEN 4.5 END AS flux, CASE WHEN k < 3 THEN 'g' END AS first FROM (SELECT event_id, event_id % 4 AS k FROM events) e
""")
def filter_fluxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 4
    names = F.when(k < 3, F.array(F.lit("none"), F.lit("g"))).otherwise(F.array(F.lit("none")))
    total = F.when(k == 0, F.array(F.lit(9.0), F.lit(1.5))).otherwise(F.array(F.lit(9.0), F.lit(float("nan"))))
    psf = F.when(k == 1, F.array(F.lit(9.0), F.lit(4.5))).otherwise(F.array(F.lit(9.0), F.lit(float("nan"))))
    e = read(spark, sf_dir, "events").select("event_id", names.alias("n"), total.alias("t"), psf.alias("p"))
    return e.select("event_id", X.flux_of("n", "t", F.lit("g"), "p").alias("flux"), X.first_filter("n").alias("first"))


@query("""
SELECT n_name AS wg, count(*) AS n FROM (
  SELECT n_name, s_suppkey % 4 AS ppc, s_suppkey % 3 AS kind FROM supplier JOIN nation ON s_nationkey = n_nationkey) x
WHERE (n_name, ppc) IN (SELECT (n_name, s_suppkey % 4) FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name, s_suppkey % 4 HAVING count(DISTINCT s_suppkey % 3) = 3) GROUP BY n_name
""")
def complete_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    f = s.select(F.col("n_name").alias("wg"), (F.col("s_suppkey") % 4).alias("ppc_code"), (F.col("s_suppkey") % 3).alias("kind"))
    return S.complete_triples(f).groupBy("wg").agg(F.count("*").alias("n"))


_CONFIG = """
title = "plan"
[ppp]
n = 10
[ppp.obs]
mode = "queue"
[sfa]
on = true
[ppp]
m = 2.5
"""


@query("""
SELECT * FROM (VALUES ('', 'title', 'plan'), ('ppp', 'n', '10'), ('ppp', 'm', '2.5'), ('ppp.obs', 'mode', 'queue'), ('sfa', 'on', 'True')) AS t(section, parameter, value)
""")
def config_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.flattened(spark, C.parse(_CONFIG))
