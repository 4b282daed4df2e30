"""Queries on programmes of one proposal, files, rules and schedules that the
other modules don't reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators import design, output, pointing, programs, schedule, spatial, targets, validate
from ..sources import tables
from ..sources import text as T
from . import query
from .binding import REMAINING, UNIQUE, read, remaining_targets, sky, sky_sql, unique_targets


@query("""
WITH a AS (SELECT o_orderkey AS ppc, CAST(o_custkey % 12 * 30 AS DOUBLE) AS ra, CAST(o_orderkey % 5 AS DOUBLE) AS dec, CAST(o_custkey % 3 * 90 AS DOUBLE) AS pa FROM orders),
u AS (SELECT CAST(s_suppkey % 12 * 30 AS DOUBLE) AS ra, CAST(s_suppkey % 5 AS DOUBLE) AS dec, CAST(s_suppkey % 2 * 90 AS DOUBLE) AS pa, min(s_acctbal) AS p FROM supplier GROUP BY ALL)
SELECT ppc, p AS ppc_priority FROM a JOIN u USING (ra, dec, pa)
""")
def user_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("o_custkey"), F.col("s_suppkey")
    a = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ppc"), (k % 12 * 30).cast("double").alias("ppc_ra"), (F.col("o_orderkey") % 5).cast("double").alias("ppc_dec"), (k % 3 * 90).cast("double").alias("ppc_pa"))
    u = read(spark, sf_dir, "supplier").select((s % 12 * 30).cast("double").alias("ppc_ra"), (s % 5).cast("double").alias("ppc_dec"), (s % 2 * 90).cast("double").alias("ppc_pa"), F.col("s_acctbal").alias("ppc_priority_usr"))
    return programs.with_user_priority(a, u).select("ppc", "ppc_priority")


@query(f"""
WITH {REMAINING}
SELECT proposal_id, count(*) AS n_assigned, round(sum(rank), 6) AS weight, round(sum(least(exptime_done, exptime)) / 3600, 6) AS fh_credited FROM remain WHERE obj_id % 2 = 0 GROUP BY proposal_id
""")
def assignment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = remaining_targets(spark, sf_dir, ("rank", "obj_id")).withColumnRenamed("rank", "rank_fin")
    out = programs.assignment_summary(t, t.where("obj_id % 2 = 0").select("identify_code"))
    return out.select("proposal_id", "n_assigned", F.round("weight", 6).alias("weight"), F.round("fh_credited", 6).alias("fh_credited"))


@query("""
WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS ob_code, 'S24A-' || CAST(p_size AS VARCHAR) AS proposal_id, p_retailprice AS e, p_retailprice * 10 - 10000 AS f FROM part),
m AS (SELECT *, CASE WHEN f > 0 THEN -2.5 * log10(f * 1e-9 / 3631) END AS mag FROM p)
SELECT proposal_id || '_' || ob_code AS identify_code, round(mag, 6) AS i2_mag, CASE WHEN mag < 24 THEN 900.0 WHEN mag >= 24 THEN 1800.0 ELSE ceil(e / 450) * 450 END AS "exptime_PPP", 0.0 AS exptime_done FROM m
""")
def extra_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part is a target, those of odd keys in a file of their own."""
    p = read(spark, sf_dir, "part")
    t = p.select(F.col("p_partkey").alias("ob_code"), F.concat(F.lit("S24A-"), F.col("p_size").cast("string")).alias("proposal_id"), F.col("p_retailprice").alias("exptime"), (F.col("p_retailprice") * 10 - 10000).alias("psf_flux_i"))
    out = programs.with_extra_targets(t.where("ob_code % 2 = 0"), [t.where("ob_code % 2 = 1").withColumn("psf_flux_i", F.col("psf_flux_i").cast("decimal(18,6)"))], 450.0, (24.0, 900.0, 1800.0))
    return out.select("identify_code", F.round("i2_mag", 6).alias("i2_mag"), "exptime_PPP", "exptime_done")


@query("SELECT CAST(p_partkey AS VARCHAR) AS identify_code, 1200.0 AS \"exptime_PPP\", 0.0 AS exptime_assign FROM part")
def forced_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("ob_code"), F.col("p_retailprice").alias("exptime"))
    return programs.with_extra_targets(t, [], 450.0, forced=1200.0).select("identify_code", "exptime_PPP", "exptime_assign")


@query("""
SELECT c_custkey AS proposal_id, CASE WHEN c_custkey % 5 = 0 THEN 'local' WHEN c_custkey % 3 = 0 THEN 'planner' ELSE 'database' END AS source FROM customer
""")
def pointing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("proposal_id"), F.when(F.col("c_custkey") % 3 == 0, F.lit(False)).alias("import_user_ppc_from_db"))
    return programs.pointing_source(c, F.col("proposal_id") % 5 == 0).select("proposal_id", "source")


@query("""
WITH p AS (SELECT s_suppkey AS k, 'S24A-' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS proposal_id, CASE WHEN s_suppkey % 2 = 0 THEN 'L' ELSE 'M' END AS resolution FROM supplier)
SELECT k, 'cla_' || resolution || '_' || substr(proposal_id, 6) || '_' || CAST(row_number() OVER (PARTITION BY proposal_id, resolution ORDER BY k) AS VARCHAR) AS ppc_code FROM p
""")
def classic_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    p = read(spark, sf_dir, "supplier").select(k.alias("k"), F.concat(F.lit("S24A-"), F.lpad(F.col("s_nationkey").cast("string"), 3, "0")).alias("proposal_id"), F.when(k % 2 == 0, "L").otherwise("M").alias("resolution"))
    return programs.classic_codes(p, "k").select("k", "ppc_code")


@query("SELECT epoch_us(ts) AS datetime, 'ob_' || CAST(user_id AS VARCHAR) AS ob_code FROM events WHERE event_id % 7 <> 0 AND event_id % 5 <> 0")
def observation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh slot is empty, every fifth derived."""
    e = read(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("start_time"), F.when(F.col("event_id") % 7 != 0, F.concat(F.lit("ob_"), F.col("user_id").cast("string"))).alias("ob_code"), (F.col("event_id") % 5 == 0).alias("derived"))
    return schedule.observation_rows(e).select(F.unix_micros("datetime").alias("datetime"), "ob_code")


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS obs_date FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1996-06-01'")
def upcoming_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("obs_date"))
    return schedule.upcoming(d, "1996-06-01").withColumn("obs_date", F.col("obs_date").cast("string"))


@query("""
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 < 9 THEN epoch_us(make_timestamp(2026, o_custkey % 12 + 1, o_orderkey % 28 + 1, o_custkey % 24, o_orderkey % 60, 0.0)) END AS start_at,
       CASE WHEN o_orderkey % 10 < 9 THEN epoch_us(make_timestamp(2026, o_custkey % 12 + 1, o_orderkey % 28 + 1, o_orderkey % 24, 5, 0.0)) END AS stop_at FROM orders
""")
def schedule_datetimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One date in ten isn't one."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    date = F.when(k % 10 < 9, F.concat_ws("/", (c % 12 + 1).cast("string"), (k % 28 + 1).cast("string"))).otherwise("soon")
    e = read(spark, sf_dir, "orders").select(k.alias("k"), date.alias("date"), F.concat_ws(":", (c % 24).cast("string"), F.lpad((k % 60).cast("string"), 2, "0")).alias("start"), F.concat_ws(":", (k % 24).cast("string"), F.lit("05")).alias("stop"))
    return schedule.schedule_datetimes(e, 2026).select("k", F.unix_micros("start_at").alias("start_at"), F.unix_micros("stop_at").alias("stop_at"))


@query("""
SELECT CAST(d AS VARCHAR) AS date, CAST(h AS INTEGER) AS hour, epoch_us(CAST(d AS TIMESTAMP) + to_hours(CAST(h + 10 AS INTEGER))) AS t
FROM (SELECT unnest([DATE '2026-01-15', DATE '2026-03-15', DATE '2026-05-15', DATE '2026-07-15', DATE '2026-09-15', DATE '2026-11-15']) AS d), (SELECT unnest([21, 0, 3]) AS h)
""")
def candidate_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.candidate_times(spark).withColumn("t", F.unix_micros("t"))


@query("""
SELECT 'ppc_' || CAST(o_orderkey AS VARCHAR) AS ppc_code, 'pfsDesign-0x' || lpad(lower(to_hex(CAST(o_orderkey * 1000003 AS BIGINT))), 16, '0') || '.fits' AS design_filename, CAST(o_orderkey * 1000003 AS BIGINT) AS "pfsDesignId", CAST(o_custkey % 4 + 1 AS INTEGER) AS ppc_nframes FROM orders
""")
def reconfigure_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    p = read(spark, sf_dir, "orders").select(
        F.concat(F.lit("ppc_"), k.cast("string")).alias("ppc_code"), F.lit(0.0).alias("ppc_ra"), F.lit(0.0).alias("ppc_dec"), F.lit(0.0).alias("ppc_pa"), (k * 1000003).cast("long").alias("pfsDesignId"),
        F.lit(900.0).alias("ppc_exptime"), (F.col("o_custkey") % 4 + 1).cast("int").alias("ppc_nframes"), F.lit("").alias("ppc_obstime_utc"), F.lit("").alias("ppc_obstime"),
    )
    return output.reconfigure_summary(p).select("ppc_code", "design_filename", "pfsDesignId", "ppc_nframes")


@query("""
WITH f AS (SELECT l_orderkey, l_linenumber, l_suppkey AS fiber_id FROM lineitem), m AS (SELECT s_suppkey AS fiber_id, s_acctbal AS x, CAST(s_nationkey AS DOUBLE) AS y FROM supplier WHERE s_suppkey % 4 <> 0)
SELECT l_orderkey, l_linenumber, x, y FROM f LEFT JOIN m USING (fiber_id)
""")
def fibre_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("fiber_id"))
    m = read(spark, sf_dir, "supplier").where("s_suppkey % 4 <> 0").select(F.col("s_suppkey").alias("fiber_id"), F.col("s_acctbal").alias("x"), F.col("s_nationkey").cast("double").alias("y"))
    return output.with_fiber_place(f, m).select("l_orderkey", "l_linenumber", "x", "y")


@query("""
SELECT o_orderkey AS design_id, c_acctbal AS inr1, c_acctbal + 1 AS inr2 FROM orders LEFT JOIN customer ON o_orderkey = c_custkey
""")
def design_rotator(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("design_id"))
    b = F.col("c_acctbal")
    d = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("design_id"), b.alias("inr1"), (b + 1).alias("inr2"), b.alias("el1"), b.alias("el2"))
    return output.with_rotator(r, d).select("design_id", "inr1", "inr2")


@query(f"WITH {UNIQUE} SELECT count(*) AS n, count(*) FILTER (WHERE dec > 0) AS n_visible, count(*) FILTER (WHERE exptime_done > 0) AS n_partial FROM once")
def visibility_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return programs.visibility_counts(unique_targets(spark, sf_dir).withColumn("is_visible", F.col("dec") > 0))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS flag, round(0.1 * l_quantity, 6) AS cost FROM lineitem")
def request_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", programs.request_flag(F.lower("l_returnflag")).alias("flag"), F.round(programs.move_cost("l_quantity"), 6).alias("cost"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'green' WHEN 'O' THEN 'orange' ELSE 'gray' END AS color FROM orders")
def status_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "running").otherwise("pending")
    return read(spark, sf_dir, "orders").select("o_orderkey", output.status_color(s).alias("color"))


@query(f"WITH {UNIQUE} SELECT resolution, count(*) AS n FROM once GROUP BY resolution")
def resolution_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of each resolution, put together again."""
    low, medium = programs.by_resolution(unique_targets(spark, sf_dir))
    return targets.combine_resolutions(low, medium.drop("rank")).groupBy("resolution").agg(F.count("*").alias("n"))


@query("""
SELECT s_suppkey AS k, 's' AS kind, s_acctbal AS a, NULL::DOUBLE AS b FROM supplier UNION ALL SELECT c_custkey, 'c', NULL, c_acctbal FROM customer
""")
def united_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.lit("s").alias("kind"), F.col("s_acctbal").alias("a"))
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit("c").alias("kind"), F.col("c_acctbal").alias("b"))
    return targets.union_all(s, None, c)


@query(f"""
WITH {UNIQUE}, log AS (SELECT proposal_id, ob_code, max(eff_done) AS eff FROM tgt WHERE input_catalog_id % 3 <> 0 GROUP BY ALL)
SELECT ob_code, least(coalesce(exptime_usr, 0), coalesce(eff, 0)) AS exptime_done, exptime_usr - least(coalesce(exptime_usr, 0), coalesce(eff, 0)) AS exptime FROM once LEFT JOIN log USING (proposal_id, ob_code)
""")
def progress_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .binding import targets as bound

    t = unique_targets(spark, sf_dir).drop("exptime", "exptime_done")
    log = bound(spark, sf_dir).where("input_catalog_id % 3 <> 0").select(F.col("proposal_id").alias("psl_id"), "ob_code", F.col("eff_done").alias("eff_exptime_done_real"))
    return targets.with_progress(t, log).select("ob_code", "exptime_done", "exptime")


@query("""
SELECT s_suppkey AS ppc_code, CAST(row_number() OVER (ORDER BY s_suppkey) - 1 AS INTEGER) AS idx, CASE WHEN s_suppkey % 3 <> 0 AND s_suppkey % 4 <> 0 THEN s_acctbal END AS ppc_pa,
       CASE WHEN s_suppkey % 5 = 0 THEN 0.0 ELSE s_acctbal END AS ppc_priority FROM supplier
""")
def pointing_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, b = F.col("s_suppkey"), F.col("s_acctbal")
    pa = F.when(k % 3 == 0, F.lit(float("nan"))).when(k % 4 == 0, F.lit(float("inf"))).otherwise(b)
    p = read(spark, sf_dir, "supplier").select(k.alias("ppc_code"), pa.alias("ppc_pa"), F.when(k % 5 != 0, b).alias("ppc_priority"), F.lit("L").alias("ppc_resolution"))
    return targets.pointing_metadata(p, "L").select("ppc_code", "idx", "ppc_pa", "ppc_priority")


@query("SELECT p_partkey, try_cast(p_container AS DOUBLE) AS psf_flux_g, CASE WHEN p_partkey % 3 > 0 THEN p_retailprice END AS total_flux_i FROM (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN 'bad' ELSE CAST(p_size AS VARCHAR) END AS p_container FROM part)")
def flux_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are no numbers, and NaN, become null."""
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part").select(
        k, F.when(k % 2 == 0, "bad").otherwise(F.col("p_size").cast("string")).alias("psf_flux_g"), F.when(k % 3 > 0, F.col("p_retailprice")).otherwise(F.lit(float("nan"))).alias("total_flux_i"),
        F.lit(False).alias("is_medium_resolution"), F.lit(0.0).alias("allocated_time_mr"), F.lit(0.0).alias("allocated_time_lr"), F.lit(0.0).alias("pmra"), F.lit(0.0).alias("pmdec"), F.lit(0.0).alias("parallax"),
    )
    return targets.from_database(p).select("p_partkey", "psf_flux_g", "total_flux_i")


@query("""
SELECT * FROM (
  SELECT 'nations' AS rule, CAST(n_nationkey AS VARCHAR) AS key, 'absent' AS detail FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
  UNION ALL SELECT DISTINCT 'nations', CAST(s_nationkey + 100 AS VARCHAR), 'unexpected' FROM supplier WHERE s_acctbal < 0
  UNION ALL SELECT 'type', 's_name', 'string is not integer'
  UNION ALL SELECT 'missing_value', CAST(min(s_suppkey) AS VARCHAR), 'filled' FROM supplier WHERE s_suppkey % 7 = 0
  UNION ALL SELECT 'filter_name', CAST(s_suppkey AS VARCHAR), 'x_old' FROM supplier WHERE s_suppkey % 6 = 5)
""")
def further_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets, types, gaps and names of filters."""
    s, k = read(spark, sf_dir, "supplier"), F.col("s_suppkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey")
    have = s.where("s_acctbal > 5000").select("s_nationkey").unionByName(s.where("s_acctbal < 0").select((F.col("s_nationkey") + 100).alias("s_nationkey")))
    f = s.select(k, F.when(k % 7 != 0, F.col("s_acctbal")).alias("filled"), F.when(k % 6 == 5, "x_old").when(k % 6 == 4, "none").otherwise("g_new").alias("filter_g"))
    return validate.all_rules(
        validate.different_sets(have, "s_nationkey", n, "nations"), validate.wrong_types(s, {"s_name": "integer", "s_acctbal": "floating"}),
        validate.missing_values(f, ["filled", "s_suppkey"], "s_suppkey"), validate.filter_names(f, {"g": ("g_new",)}, "s_suppkey"),
    )


@query("SELECT vec_id, CAST(label AS DOUBLE) AS magnitude FROM embeddings WHERE label <= 3")
def bright_guide_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("double").alias("magnitude"))
    return design.bright_guide_stars(e, 0.0, 3.0)


@query("""
WITH s AS (SELECT vec_id % 40 AS ppc_code, vec_id % 40 % 9 AS top, label FROM embeddings)
SELECT ppc_code, 6 - count(DISTINCT CASE WHEN label < top AND label < 6 THEN label END) AS n_empty, count(DISTINCT CASE WHEN label < top AND label < 6 THEN label END) = 0 AS no_star FROM s GROUP BY ppc_code
""")
def empty_cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings").select((F.col("vec_id") % 40).alias("ppc_code"), F.col("label").alias("cam"))
    out = design.cameras_without_star(e.where(F.col("cam") < F.col("ppc_code") % 9), e.select("ppc_code").distinct())
    return out.select("ppc_code", F.col("n_empty").cast("long").alias("n_empty"), "no_star")


@query("SELECT 'S24A-' || CAST(100 + n_nationkey AS VARCHAR) AS proposal_id FROM nation WHERE n_nationkey % 3 <> 0")
def classic_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of two entries for each nation, some of them of the queue."""
    k = F.col("n_nationkey")
    one = F.concat(F.lit("18:30-23:00 {grey} SPEC (someone; s24a-"), (100 + k).cast("string"), F.when(k % 3 == 0, "QN").otherwise(""), F.lit(") "))
    return T.classic_proposals(T.schedule_entries(read(spark, sf_dir, "nation").select(F.concat(one, one).alias("line")), "spec"))


@query("SELECT n_nationkey, n_name, false AS is_backup FROM nation")
def optional_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A main table, and a backup that isn't there."""
    return tables.with_backup(spark, f"{sf_dir}/nation.parquet", f"{sf_dir}/absent.parquet", "n_nationkey long, n_name string")


@query("""
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 > 0 THEN epoch_us(date_trunc('minute', CAST(o_orderdate AS TIMESTAMP)) + INTERVAL 10 HOUR) END AS utc FROM orders WHERE o_orderkey % 4 > 0
""")
def given_obstimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a time go; a text that is no time stays without one."""
    k = F.col("o_orderkey")
    time = F.when(k % 4 == 0, " NaN ").when(k % 5 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm"))
    return tables.with_obstime(read(spark, sf_dir, "orders").select(k.alias("k"), time.alias("ppc_obstime"))).select("k", F.unix_micros("ppc_obstime_utc").alias("utc"))


@query("""
SELECT event_id, epoch_us(date_trunc('second', ts)) AS start, epoch_us(date_trunc('second', ts) + to_seconds(CASE WHEN event_id % 2 = 0 THEN 1260 ELSE user_id END)) AS stop FROM events
""")
def design_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both layouts of the summary: a fixed slot, and each one's exposure."""
    e = tables.result_times(read(spark, sf_dir, "events").select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("obstime")))
    even = tables.design_summary(e.where("event_id % 2 = 0").withColumn("observation_time", F.col("obstime")), False)
    odd = tables.design_summary(e.where("event_id % 2 = 1").withColumns({"ppc_obstime_utc": F.col("obstime"), "ppc_exptime": F.col("user_id").cast("double")}), True)
    return even.select("event_id", "start", "stop").unionByName(odd.select("event_id", "start", "stop")).select("event_id", F.unix_micros("start").alias("start"), F.unix_micros("stop").alias("stop"))


@query("""
SELECT o_orderkey AS k, o_orderkey % 4 = 1 AS given, CASE WHEN o_orderkey % 3 = 0 THEN 2000.0 WHEN o_orderkey % 3 = 1 THEN 2015.5 END AS epoch, CASE WHEN o_custkey % 2 = 0 THEN 'low' ELSE 'medium' END AS resolution FROM orders
""")
def scalar_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = read(spark, sf_dir, "orders").select(k.alias("k"), F.when(k % 4 == 1, "12.5").when(k % 4 == 2, "nan").when(k % 4 == 3, "inf").otherwise("x").alias("pa"), F.when(k % 3 == 0, "J2000.0").when(k % 3 == 1, "2015.5").otherwise("J").alias("e"), F.when(F.col("o_custkey") % 2 == 0, "L").otherwise("M").alias("r"))
    return o.select("k", X.is_given("pa").alias("given"), X.epoch_number("e").alias("epoch"), X.resolution_word("r").alias("resolution"))


@query("""
SELECT o_orderkey AS k, 'CMD DESIGN_ID="0x' || lpad(lower(to_hex(CAST(o_orderkey AS BIGINT))), 16, '0') || '" OBJECT="ppc_' || CAST(o_custkey AS VARCHAR) || '" EXPTIME=900.0 NFRAME=' || CAST(o_custkey % 4 + 1 AS VARCHAR) AS text FROM orders
""")
def exposure_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("long").alias("design_id"), F.concat(F.lit("ppc_"), F.col("o_custkey").cast("string")).alias("ppc_code"), F.lit(900.0).alias("single_exptime"), (F.col("o_custkey") % 4 + 1).cast("int").alias("nframe"))
    return output.exposure_lines(o, 'CMD DESIGN_ID="designId" OBJECT="objectname" EXPTIME="exptime"').select("k", "text")


@query("""
WITH s AS (SELECT 'c' || CAST(o_custkey % 60 AS VARCHAR) AS ppc_code, o_orderkey AS k FROM orders), t AS (SELECT 'c' || CAST(n_nationkey AS VARCHAR) AS ppc_code, CAST(n_regionkey AS DOUBLE) AS slew_time FROM nation)
SELECT k, ppc_code, slew_time FROM s LEFT JOIN t USING (ppc_code)
""")
def slew_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "orders").select(F.concat(F.lit("c"), (F.col("o_custkey") % 60).cast("string")).alias("ppc_code"), F.col("o_orderkey").alias("k"))
    t = read(spark, sf_dir, "nation").select(F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("ppc_code"), F.col("n_regionkey").cast("double").alias("slew_time"))
    return schedule.schedule_with_slew(s, t).select("k", "ppc_code", "slew_time")


@query("SELECT c_mktsegment AS segment, count(*) AS n FROM customer WHERE c_mktsegment IN (SELECT c_mktsegment FROM customer GROUP BY 1 HAVING count(DISTINCT c_nationkey) > 0) GROUP BY 1 HAVING (SELECT count(DISTINCT c_custkey * 0) FROM customer) = 1")
def one_exposure_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers have the one exposure, so all of them pass; suppliers
    have several, so none of them does."""
    c = read(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment"), F.lit(900.0).alias("single_exptime"))
    s = read(spark, sf_dir, "supplier").select(F.lit("none").alias("segment"), F.col("s_acctbal").alias("single_exptime"))
    return targets.same_single_exposure(c).unionByName(targets.same_single_exposure(s)).groupBy("segment").agg(F.count("*").alias("n"))


@query("SELECT 'one' AS found, 1 AS n UNION ALL SELECT 'several', 0")
def one_proposal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proposal of targets of one, and of several."""
    n = read(spark, sf_dir, "nation")
    one = targets.single_proposal(n.select(F.lit("S24A-001").alias("proposal_id")))
    several = targets.single_proposal(n.select(F.col("n_name").alias("proposal_id")))
    return spark.createDataFrame([("one", int(one == "S24A-001")), ("several", int(several is not None))], "found string, n int")


@query(f"""
WITH s AS (SELECT *, abs(s_acctbal) AS w FROM (SELECT s_suppkey, s_acctbal, {sky_sql("s_suppkey * 7 + 1")} FROM supplier)),
o AS (SELECT i, j FROM range(-6, 7) a(i), range(-6, 7) b(j)),
c AS (SELECT round_even(ra, 0) + i AS gx, round_even(dec, 0) + j AS gy, ra, dec, w FROM s, o),
m AS (SELECT gx, gy, sum(w * (1 - sqrt(pow(gx - ra, 2) + pow(gy - dec, 2)) / 5)) AS density FROM c WHERE sqrt(pow(gx - ra, 2) + pow(gy - dec, 2)) < 5 GROUP BY gx, gy),
z AS (SELECT gx, gy, density, avg(density) OVER () AS mean, stddev_pop(density) OVER () AS std FROM m)
SELECT gx AS ra, gy AS dec, round(density, 6) AS density, round((density - mean) / std, 6) AS z FROM z
""")
def density_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the map whose peak density_peak looks for."""
    ra, dec = sky(F.col("s_suppkey") * 7 + 1)
    p = read(spark, sf_dir, "supplier").select(ra.alias("ra"), dec.alias("dec"), F.abs("s_acctbal").alias("weight"))
    z = spatial.density_peak(p, 5.0, 1.0)
    return z.select("ra", "dec", F.round("density", 6).alias("density"), F.round("z", 6).alias("z"))


@query()
def assignment_with_spill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three fibres to each pointing; targets turned down go to the next one."""
    ra, dec = sky("p_partkey")
    t = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("identify_code"), ra.alias("ra"), dec.alias("dec"), F.col("p_retailprice").alias("weight"))
    ra, dec = sky(F.col("s_suppkey") * 7 + 1)
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pointing"), ra.alias("ra"), dec.alias("dec"))
    return pointing.assignment_with_spill(t, s, 3, 6.0).select("pointing", "identify_code")
