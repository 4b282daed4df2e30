"""Queries on sources, exports, policies and windows of nights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import design, output, pointing, schedule, scoring, targets
from ..operators import validate as V
from ..sources import tables as S
from . import query
from .binding import read


@query("""
SELECT s.s_suppkey AS ob, CAST('P' || CAST(s_nationkey AS VARCHAR) AS VARCHAR) AS psl_id, s_suppkey % 7 * 450.0 AS exptime_done_real, s_acctbal AS eff_exptime_done_real
FROM supplier s WHERE s_acctbal >= 0
""")
def executed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    base = s.select(F.concat(F.lit("P"), F.col("s_nationkey").cast("string")).alias("psl_id"), F.col("s_suppkey").alias("ob_code"), (F.col("s_suppkey") % 7).alias("n_exposures"), F.col("s_acctbal").alias("eff_exptime_done_real"))
    log = S.executed_log(base.select("psl_id", "ob_code", "n_exposures"), base.select("psl_id", "ob_code", "eff_exptime_done_real"))
    return log.select(F.col("ob_code").alias("ob"), "psl_id", "exptime_done_real", "eff_exptime_done_real")


@query("""
SELECT c_custkey AS proposal_id, CASE WHEN c_custkey % 3 > 0 THEN c_name || c_mktsegment || CAST(c_nationkey AS VARCHAR) END AS "PI" FROM customer
""")
def proposal_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    return S.proposal_list(c.select(F.col("c_custkey").alias("proposal_id"), F.col("c_name").alias("pi_first_name"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("pi_middle_name"), F.col("c_nationkey").cast("string").alias("pi_last_name")))


@query("""
SELECT o_orderkey AS k, 'N' AS arm FROM orders WHERE o_custkey % 4 = 1
""")
def n_arm_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    arm = F.element_at(F.array(F.lit("b"), F.lit(" n "), F.lit("r"), F.lit(None)), (F.col("o_custkey") % 4 + 1).cast("int"))
    rows = S.n_arm_targets(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), arm.alias("qa_reference_arm")))
    return rows.select("k", F.upper(F.trim("qa_reference_arm")).alias("arm"))


@query("""
WITH t AS (SELECT o_orderkey AS k, o_custkey % 5 AS pol, CAST(o_custkey % 4 AS INTEGER) AS priority, o_orderkey % 3 AS cat, CASE WHEN o_custkey % 2 = 0 THEN 900.0 ELSE 1800.0 END AS e, (o_orderkey * CAST(137.508 AS DOUBLE)) % 360.0 AS ra FROM orders),
a AS (SELECT *, CASE WHEN pol = 1 AND priority = 2 THEN 450.0 ELSE e END AS e1, priority + CASE WHEN pol = 1 AND cat = 1 THEN 10 ELSE 0 END AS p1 FROM t),
b AS (SELECT *, CASE WHEN pol = 1 AND e1 IN (1800.0, 450.0) THEN 1200.0 ELSE e1 END AS e2 FROM a)
SELECT k, CAST(p1 AS INTEGER) AS priority, CASE WHEN pol = 1 AND ra < 90 THEN 300.0 ELSE e2 END AS exptime, CASE WHEN pol = 1 THEN 4500.0 ELSE 900.0 END AS single_exptime FROM b
""")
def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    t = read(spark, sf_dir, "orders").select(
        k.alias("k"), (c % 5).alias("proposal_id"), (c % 4).cast("int").alias("priority"), (k % 3).alias("input_catalog_id"), F.when(c % 2 == 0, 900.0).otherwise(1800.0).alias("exptime"),
        F.lit(900.0).alias("single_exptime"), F.pmod(k * 137.508, F.lit(360.0)).alias("ra"),
    )
    schema = "proposal_id long, policy_single_exptime double, priority_exptime map<int,double>, catalog_offset map<long,int>, exptime_from array<double>, exptime_to double, ra_below double, ra_exptime double"
    policy = spark.createDataFrame([(1, 4500.0, {2: 450.0}, {1: 10}, [1800.0, 450.0], 1200.0, 90.0, 300.0)], schema)
    return targets.apply_policies(t, policy).select("k", "priority", "exptime", "single_exptime")


@query("""
WITH n AS (SELECT DISTINCT CAST(ts AS DATE) AS night FROM events),
d AS (SELECT night, night + INTERVAL 19 HOUR - INTERVAL 5 MINUTE AS d0, night + INTERVAL 29 HOUR + INTERVAL 30 MINUTE AS d1, day(night) AS k FROM n)
SELECT CAST(night AS VARCHAR) AS night, epoch_us(CASE k % 4 WHEN 1 THEN night + INTERVAL 22 HOUR WHEN 2 THEN d0 WHEN 3 THEN night + INTERVAL 25 HOUR ELSE d0 END) AS start, epoch_us(CASE k % 4 WHEN 1 THEN night + INTERVAL 28 HOUR WHEN 2 THEN d1 ELSE d1 END) AS stop FROM d
""")
def night_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overrides of the start within the night, up to an hour before dusk and
    after midnight; of the stop before dawn and up to an hour after it."""
    n = read(spark, sf_dir, "events").select(F.to_date("ts").alias("night")).distinct()
    day, k = F.col("night").cast("timestamp"), F.dayofmonth("night") % 4

    def hours(h: float):
        return day + F.make_dt_interval(mins=F.lit(int(h * 60)))

    nights = n.select("night", hours(19).alias("evening"), hours(29).alias("morning"))
    starts = n.select(F.when(k == 1, hours(22)).when(k == 2, hours(18.5)).when(k == 3, hours(25)).alias("at")).where("at is not null")
    stops = n.select(F.when(k == 1, hours(28)).when(k == 2, hours(30)).alias("at")).where("at is not null")
    w = schedule.night_window(nights, starts, stops)
    return w.select(F.col("night").cast("string").alias("night"), F.unix_micros("start").alias("start"), F.unix_micros("stop").alias("stop"))


@query("""
WITH a AS (SELECT 0 AS kind, s_suppkey AS obj_id, s_suppkey AS cobra_id FROM supplier WHERE s_suppkey % 3 = 0
           UNION ALL SELECT 1, s_suppkey, s_suppkey FROM supplier WHERE s_suppkey % 3 = 1 UNION ALL SELECT 2, s_suppkey, s_suppkey FROM supplier WHERE s_suppkey % 3 = 2)
SELECT kind, obj_id, cobra_id, CAST(row_number() OVER (ORDER BY kind, cobra_id, obj_id) - 1 AS INTEGER) AS idx FROM a
""")
def merge_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("obj_id"), F.col("s_suppkey").alias("cobra_id"))
    return output.merge_index(*[s.where(f"obj_id % 3 = {k}") for k in range(3)])


@query("""
SELECT s_name AS ppc_code, s_acctbal AS ppc_priority, 'J2000' AS ppc_equinox, s_acctbal AS ppc_priority_usr, 900.0 AS ppc_exptime, 1200.0 AS ppc_totaltime, '' AS ppc_comment, CAST(NULL AS DOUBLE) AS ppc_fiber_usage_frac, CAST(0 AS INTEGER) AS n_allocated FROM supplier
""")
def export_pointings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = output.export_pointings(read(spark, sf_dir, "supplier").select(F.col("s_name").alias("ppc_code"), F.col("s_acctbal").alias("ppc_priority")))
    return out.withColumn("n_allocated", F.size("ppc_allocated_targets")).drop("ppc_allocated_targets")


@query("""
SELECT p_partkey AS ob_obj_id, p_name AS ob_code, p_retailprice AS ob_weight_best, p_size AS proposal_rank, 'J2000' AS ob_equinox FROM part
""")
def export_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return output.export_targets(p.select(F.col("p_partkey").alias("obj_id"), F.col("p_name").alias("ob_code"), F.col("p_retailprice").alias("rank_fin"), F.col("p_size").alias("rank")))


@query("""
SELECT p_partkey AS k, CAST(p_size - CASE WHEN p_size % 2 = 0 AND p_partkey % 3 = 1 THEN 10 ELSE 0 END AS INTEGER) AS priority FROM part
""")
def undo_priority_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("priority"), (F.col("p_size") % 2).alias("proposal_id"), (F.col("p_partkey") % 3).alias("input_catalog_id"))
    o = spark.createDataFrame([(0, 1, 10)], "proposal_id int, input_catalog_id long, offset int")
    return targets.undo_priority_offset(p, o).select("k", "priority")


@query("""
SELECT conv_id, turn, CAST(CASE WHEN turn < 3 THEN 0 WHEN turn <= 5 THEN 1 ELSE 2 END AS BIGINT) AS section FROM conversations
""")
def template_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as a template with marks at turns 3 and 5."""
    t = F.col("turn")
    line = F.when(t == 3, "### SCIENCE:START ###").when(t == 5, "### SCIENCE:END  ###").otherwise("GET SPECTRUM")
    return output.template_sections(read(spark, sf_dir, "conversations").select("conv_id", t.alias("n"), line.alias("line")), "conv_id").select("conv_id", F.col("n").alias("turn"), "section")


@query("""
WITH s AS (SELECT s_suppkey AS ppc, s_suppkey * 7 + 1 AS k FROM supplier),
p AS (SELECT ppc, (k * CAST(137.508 AS DOUBLE)) % 360.0 AS ra, (k * CAST(61.8034 AS DOUBLE)) % 120.0 - 30 AS dec, CAST(k % 360 - 90 AS DOUBLE) AS pa FROM s),
t AS (SELECT TIMESTAMP '2024-03-01 06:00:00' + to_minutes(CAST(k * 20 AS INTEGER)) AS t FROM range(31) g(k)),
h AS (SELECT *, radians(((280.46061837 + 360.98564736629 * (epoch_us(t) / 86400e6 + 2440587.5 - 2451545.0) - 155.4761) % 360 + 360) % 360 - ra) AS h FROM p, t),
i AS (SELECT ppc, t, ((degrees(atan2(sin(h), tan(radians(19.8256)) * cos(radians(dec)) - sin(radians(dec)) * cos(h))) - pa + 180) % 360 + 360) % 360 - 180 AS inr FROM h),
l AS (SELECT *, lag(inr) OVER (PARTITION BY ppc ORDER BY t) AS q FROM i)
SELECT ppc, round(max(abs(inr - q)), 4) AS max_jump, count(*) FILTER (WHERE (q >= 170 AND inr <= -170) OR (q <= -170 AND inr >= 170)) AS n_crossings FROM l GROUP BY ppc
""")
def rotator_night(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuity of the rotator over a night, by pointing."""
    k = F.col("s_suppkey") * 7 + 1
    p = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ppc"), F.pmod(k * 137.508, F.lit(360.0)).alias("ra"), (F.pmod(k * 61.8034, F.lit(120.0)) - 30).alias("dec"), (k % 360 - 90).cast("double").alias("pa"))
    night = spark.sql("SELECT TIMESTAMP '2024-03-01 06:00:00' AS start, TIMESTAMP '2024-03-01 16:00:00' AS stop")
    jumps = schedule.rotator_jumps(schedule.rotator_samples(p, night))
    return jumps.select("ppc", F.round("max_jump", 4).alias("max_jump"), "n_crossings")


@query("""
SELECT vec_id, round(245 * cos(radians(-60.0 * (label % 6) - 9)), 6) AS x, round(245 * sin(radians(-60.0 * (label % 6) - 9)), 6) AS y,
       round(sin(radians(vec_id)), 9) + 0.0 AS north_x, round(cos(radians(vec_id)), 9) + 0.0 AS north_y FROM embeddings
""")
def camera_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = G.camera_label(F.col("label") % 6)
    nx, ny, _, _ = G.directions("vec_id")
    return read(spark, sf_dir, "embeddings").select("vec_id", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"), (F.round(nx, 9) + 0.0).alias("north_x"), (F.round(ny, 9) + 0.0).alias("north_y"))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_quantity < 13 AND l_partkey % 3 > 0) OR l_discount * 100 + 5 < 6
""")
def bright_fibres(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.when(F.col("l_partkey") % 3 > 0, F.col("l_quantity")).otherwise(F.lit(float("nan")))
    f = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", q.alias("psf_mag"), F.when(F.col("l_discount") * 100 + 5 < 6, F.lit(12.0)).alias("total_mag"))
    return design.bright_fibers(f).select("l_orderkey", "l_linenumber", "l_quantity")


@query("""
SELECT 'code_with_places' AS rule, CAST(o_custkey AS VARCHAR) AS key, CAST(count(DISTINCT (o_orderkey % 5, o_orderkey % 2)) AS VARCHAR) AS detail FROM orders GROUP BY o_custkey HAVING count(DISTINCT (o_orderkey % 5, o_orderkey % 2)) > 1
UNION ALL SELECT 'one_date', '*', CAST(count(DISTINCT CAST(o_orderdate AS DATE)) AS VARCHAR) FROM orders HAVING count(DISTINCT CAST(o_orderdate AS DATE)) > 1
""")
def output_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("ppc_code"), (F.col("o_orderkey") % 5).alias("ppc_ra"), (F.col("o_orderkey") % 2).alias("ppc_dec"), F.col("o_orderdate").alias("obstime"))
    return V.all_rules(V.code_with_places(o), V.one_date(o))


@query("""
WITH q AS (SELECT CAST(k AS INTEGER) AS k FROM range(10) g(k))
SELECT 'queue' AS mode, 'sci_P' || CAST(k AS VARCHAR) AS class, 0 AS n_required, 100.0 - 10 * k AS cost, 200.0 AS partial_cost FROM q
UNION ALL SELECT * FROM (VALUES ('queue', 'sci_P999', 0, 200.0, 200.0), ('queue', 'cal', 200, 200.0, 0.0), ('queue', 'sky', 400, 200.0, 0.0), ('classic', 'cal', 0, 2000.0, 0.0), ('classic', 'sky', 0, 2000.0, 0.0), ('classic', 'sci_P10', 0, 1.0, 100.0))
UNION ALL SELECT 'classic', 'sci_P' || CAST(k AS VARCHAR), 0, 100.0 - 10 * k, 100.0 FROM q
""")
def class_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    linear = pointing.check_costs([float(c) for c in pointing.COST_PATTERNS["linear_100_to_1"]])
    both = [(m, scoring.class_costs(spark, c)) for m, c in (("queue", None), ("classic", linear))]
    rows = [t.withColumn("mode", F.lit(m)) for m, t in both]
    return rows[0].unionByName(rows[1]).select("mode", "class", "n_required", "cost", "partial_cost")
