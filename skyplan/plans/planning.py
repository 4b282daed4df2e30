"""Queries on targets, proposals and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators import completion, output, pointing, scoring, targets, weights
from ..operators.lineage import cut_lineage
from . import query
from .binding import REMAINING, TARGETS, UNIQUE, read, remaining_targets, targets as bound_targets, unique_targets


def r6(c: str):
    return F.round(c, 6).alias(c)


@query(f"""
WITH {UNIQUE},
log AS (SELECT proposal_id, ob_code, eff_done AS eff, floor(eff_done / 450) * 450 AS real FROM once WHERE input_catalog_id % 3 <> 0),
m AS (
  SELECT o.*, coalesce(eff, 0) AS e, coalesce(real, 0) AS r, least(exptime_usr, coalesce(eff, 0)) AS rec
  FROM once o LEFT JOIN log USING (proposal_id, ob_code)),
b AS (
  SELECT proposal_id, sum(exptime_usr) / 3600 AS fh_tot, min(allocated_time_tac) AS fh_alloc,
         coalesce(sum(CASE WHEN rec >= exptime_usr THEN rec END), 0) / 3600 AS fh_com, sum(rec) / 3600 AS fh_achieve, sum(r) / 3600 AS fh_exe
  FROM m GROUP BY proposal_id),
p AS (SELECT 'P' || CAST(c_custkey AS VARCHAR) AS proposal_id FROM customer)
SELECT proposal_id, coalesce(fh_tot, 0) AS fh_tot, coalesce(fh_alloc, 0) AS fh_alloc, coalesce(fh_com, 0) AS fh_com,
       coalesce(fh_achieve, 0) AS fh_achieve, coalesce(fh_exe, 0) AS fh_exe, coalesce(fh_achieve, 0) AS fh_exp,
       round(CASE WHEN coalesce(fh_alloc, 0) > 0 THEN fh_achieve / fh_alloc ELSE 0 END * 100, 6) AS completion
FROM p LEFT JOIN b USING (proposal_id)
""")
def completion_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The completion report: proposals without targets stay."""
    t = unique_targets(spark, sf_dir)
    log = t.where("input_catalog_id % 3 <> 0").select(F.col("proposal_id").alias("psl_id"), "ob_code", F.col("eff_done").alias("eff_exptime_done_real"), (F.floor(F.col("eff_done") / 450) * 450).cast("double").alias("exptime_done_real"))
    p = read(spark, sf_dir, "customer").select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("proposal_id"))
    out = completion.completion_rate(p, t.select("proposal_id", "ob_code", "exptime_usr", "allocated_time_tac"), log)
    return out.withColumn("completion", F.round("completion", 6))


@query(f"""
WITH {UNIQUE}
SELECT proposal_id, resolution, sum(exptime_done) / 3600 AS fh_done, max(allocated_time_tac) AS allocated,
       round(CASE WHEN max(allocated_time_tac) > 0 THEN sum(exptime_done) / 3600 / max(allocated_time_tac) ELSE 0 END * 100, 6) AS completion
FROM once GROUP BY proposal_id, resolution
""")
def fh_by_proposal_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completion.by_proposal_and_resolution(unique_targets(spark, sf_dir)).withColumn("completion", F.round("completion", 6))


@query(f"""
WITH {REMAINING}
SELECT identify_code, proposal_id, resolution, exptime, exptime_done, "exptime_PPP", round(allocated_time, 6) AS allocated_time FROM remain
""")
def remaining_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remaining_targets(spark, sf_dir).select("identify_code", "proposal_id", "resolution", "exptime", "exptime_done", "exptime_PPP", r6("allocated_time"))


@query(f"""
WITH {REMAINING}
SELECT proposal_id, round(max(allocated_time), 6) AS "FH_goal", sum(least(exptime_done, exptime)) / 3600 AS "FH_done",
       count(*) FILTER (WHERE "exptime_PPP" <= 0) AS "N_done", count(*) FILTER (WHERE "exptime_PPP" < exptime) AS "N_obs", count(*) AS "N_psl"
FROM (SELECT * REPLACE ("exptime_PPP" - 1800 * (obj_id % 3) AS "exptime_PPP") FROM remain) GROUP BY proposal_id
""")
def progress_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As after some pointings: a third of the targets had one, a third two."""
    t = remaining_targets(spark, sf_dir).withColumn("exptime_PPP", F.col("exptime_PPP") - 1800 * (F.col("obj_id") % 3))
    return scoring.progress(t).withColumn("FH_goal", F.round("FH_goal", 6))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1
""")
def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return targets.keep_first(line, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1
""")
def duplicate_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return targets.all_duplicates(line, ["l_orderkey", "l_linenumber"])


@query(f"""
WITH {TARGETS},
cat AS (SELECT p_partkey AS input_catalog_id FROM part WHERE p_size <= 25),
prop AS (SELECT 'P' || CAST(c_custkey AS VARCHAR) AS proposal_id, c_custkey % 7 AS tac_lr, c_custkey % 5 AS tac_mr FROM customer)
SELECT ob_code, tgt.proposal_id, exptime_usr, resolution, CASE WHEN resolution = 'M' THEN tac_mr ELSE tac_lr END AS allocated_time_tac,
       0.0 AS pmra, CASE WHEN tgt.input_catalog_id % 4 = 0 THEN 1e-7 ELSE CAST(tgt.input_catalog_id % 4 AS DOUBLE) END AS parallax
FROM tgt JOIN cat USING (input_catalog_id) JOIN prop ON tgt.proposal_id = prop.proposal_id
""")
def active_targets_3way_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bound_targets(spark, sf_dir).select(
        "ob_code", "proposal_id", "input_catalog_id", F.col("exptime_usr").alias("effective_exptime"), (F.col("resolution") == "M").alias("is_medium_resolution"),
        F.lit(None).cast("double").alias("pmra"), F.lit(None).cast("double").alias("pmdec"), (F.col("input_catalog_id") % 4).cast("double").alias("parallax"),
    )
    key = F.col("c_custkey")
    p = read(spark, sf_dir, "customer").select(F.concat(F.lit("P"), key.cast("string")).alias("proposal_id"), (key % 7).alias("allocated_time_lr"), (key % 5).alias("allocated_time_mr"))
    c = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("input_catalog_id"), (F.col("p_size") <= 25).alias("active"))
    found = targets.from_database(targets.active_targets(t, p, c))
    return found.select("ob_code", "proposal_id", "exptime_usr", "resolution", "allocated_time_tac", "pmra", "parallax")


@query("""
SELECT user_pointing_id, ppc_ra, ppc_dec, ppc_pa, ppc_resolution, ppc_priority FROM (
  SELECT *, row_number() OVER (PARTITION BY ppc_ra, ppc_dec, ppc_pa, ppc_resolution ORDER BY user_pointing_id) AS rn FROM (
    SELECT s_suppkey AS user_pointing_id, CAST(s_suppkey % 9 * 40 AS DOUBLE) AS ppc_ra, CAST(s_suppkey % 4 * 10 AS DOUBLE) AS ppc_dec,
           CASE WHEN s_suppkey % 2 = 0 THEN 90.0 END AS ppc_pa, CASE WHEN s_suppkey % 3 = 0 THEN 'M' ELSE 'L' END AS ppc_resolution,
           CASE WHEN s_suppkey % 5 = 0 THEN 0.0 ELSE s_acctbal END AS ppc_priority
    FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey < 4)) WHERE rn = 1
""")
def user_pointing_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    p = read(spark, sf_dir, "supplier").select(
        k.alias("user_pointing_id"), (k % 9 * 40).cast("double").alias("ppc_ra"), (k % 4 * 10).cast("double").alias("ppc_dec"), F.when(k % 2 == 0, 90.0).alias("ppc_pa"),
        F.when(k % 3 == 0, "M").otherwise("L").alias("ppc_resolution"), F.when(k % 5 != 0, F.col("s_acctbal")).alias("ppc_priority"), F.col("s_nationkey").alias("input_catalog_id"),
    )
    ok = F.col("n_regionkey") < 4
    c = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("input_catalog_id"), ok.alias("active"), ok.alias("is_classical"), ok.alias("is_user_pointing"))
    return targets.user_pointings(p, c).drop("input_catalog_id")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40)")
def anti_unassigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = read(spark, sf_dir, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"))
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(hit, "o_orderkey", "left_anti")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40)")
def semi_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = read(spark, sf_dir, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"))
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(hit, "o_orderkey", "left_semi")


_RANKED = """
ranks AS (SELECT rank, coalesce(lag(rank) OVER (ORDER BY rank), 0.0) AS p FROM (SELECT DISTINCT rank FROM {t})),
ranked AS (SELECT t.*, exp(0.55 * t.rank + 0.45 * p + (9 - priority) * 0.05 * (t.rank - p)) AS rank_fin FROM {t} t JOIN ranks ON t.rank = ranks.rank)"""


@query(f"WITH {UNIQUE}, {_RANKED.format(t='once')} SELECT proposal_id, ob_code, round(rank_fin, 6) AS rank_fin FROM ranked")
def rank_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weights.rank_weight(unique_targets(spark, sf_dir)).select("proposal_id", "ob_code", r6("rank_fin"))


_DENSE = "dense AS (SELECT *, count(*) OVER (PARTITION BY greatest(trunc(dec + 40), 0), trunc(ra)) AS local_count FROM {t})"


@query(f"WITH {UNIQUE}, {_DENSE.format(t='once')} SELECT proposal_id, ob_code, local_count FROM dense")
def local_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weights.local_density(unique_targets(spark, sf_dir)).select("proposal_id", "ob_code", "local_count")


@query(f"""
WITH {REMAINING}, {_RANKED.format(t="remain")}, {_DENSE.format(t="ranked")},
w AS (SELECT *, pow(rank_fin, 2) * pow("exptime_PPP" / 900, 0.5) * pow(local_count, 0.25) AS w0, exptime_done > 0 OR "exptime_PPP" < exptime AS begun FROM dense)
SELECT identify_code, round(ln(CASE WHEN begun THEN w0 + max(w0) OVER () ELSE w0 END), 6) AS weight,
       round(CASE WHEN begun THEN rank_fin + max(rank_fin) OVER () ELSE rank_fin END, 3) AS rank_fin FROM w
""")
def combined_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = weights.local_density(weights.rank_weight(cut_lineage(remaining_targets(spark, sf_dir))))
    w = weights.weighted(cut_lineage(t), 900.0, 2.0, 0.5, 0.25)
    return w.select("identify_code", F.round(F.ln("weight"), 6).alias("weight"), F.round("rank_fin", 3).alias("rank_fin"))


_VALUE = "CASE priority WHEN 0 THEN 100.0 WHEN 1 THEN 5 WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 4 THEN 0.5 WHEN 5 THEN 0.5 WHEN 6 THEN 0.4 WHEN 9 THEN 0.1 ELSE 0 END"


@query(f"""
WITH {REMAINING},
asg AS (SELECT *, input_catalog_id % 50 AS pointing, greatest(least("exptime_PPP", 900.0), 0) AS step FROM remain WHERE obj_id % 2 = 0),
cnt AS (
  SELECT pointing, count(*) AS n_assigned, count(*) FILTER (WHERE priority = 1) AS n_p1, count(*) FILTER (WHERE "exptime_PPP" <= 900) AS n_finish,
         count(*) FILTER (WHERE exptime_done > 0) AS n_continue, count(*) FILTER (WHERE exptime_done <= 0 AND "exptime_PPP" > 900) AS n_new_partial, sum({_VALUE}) AS prio
  FROM asg GROUP BY pointing),
bud AS (SELECT proposal_id, max(rank) / 10 AS w, greatest(0.0, max(allocated_time) - sum(least(exptime_done, exptime)) / 3600) AS rest FROM remain GROUP BY proposal_id),
den AS (SELECT least(sum(w * rest), 2394 * 900.0 / 3600 * max(w)) AS d FROM bud),
worth AS (SELECT sum({_VALUE}) AS v FROM remain WHERE "exptime_PPP" > 0),
gain AS (
  SELECT pointing, sum(w * least(d, rest)) AS use, sum(w * greatest(0.0, d - rest)) AS more
  FROM (SELECT pointing, proposal_id, sum(step) / 3600 AS d FROM asg GROUP BY pointing, proposal_id) JOIN bud USING (proposal_id) GROUP BY pointing)
SELECT pointing, n_assigned, n_p1, n_finish, n_continue, n_new_partial, round(use / d, 6) AS fh, round(prio / v, 6) AS prio, round(more / d, 6) AS over,
       round(5 * use / d + 2.5 * n_finish / n_assigned + 0.1 * n_continue / n_assigned + 1.5 * prio / v + 0.5 * n_assigned / 2394
             - 0.1 * n_new_partial / n_assigned - 0.05 * more / d, 6) AS score
FROM cnt JOIN gain USING (pointing), den, worth
""")
def pointing_score_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = cut_lineage(remaining_targets(spark, sf_dir))  # read five times
    assigned = t.where("obj_id % 2 = 0").select("identify_code", (F.col("input_catalog_id") % 50).alias("pointing"))
    s = scoring.pointing_scores(t, assigned)
    return s.select("pointing", "n_assigned", "n_p1", "n_finish", "n_continue", "n_new_partial", r6("fh"), r6("prio"), r6("over"), r6("score"))


@query(f"""
WITH {REMAINING}
SELECT priority, count(*) FILTER (WHERE obj_id % 2 = 0) AS n_assigned, count(*) AS n_total FROM remain GROUP BY priority
""")
def priority_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = remaining_targets(spark, sf_dir, ("priority", "obj_id"))
    return scoring.tracked_by_priority(t, t.where("obj_id % 2 = 0"))


@query(f"""
WITH {REMAINING} SELECT "exptime_PPP", count(*) AS n FROM remain GROUP BY "exptime_PPP"
""")
def remaining_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remaining_targets(spark, sf_dir, ()).groupBy("exptime_PPP").agg(F.count("*").alias("n"))


@query("""
WITH got AS (SELECT o_custkey % 7 AS k, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS p, o_orderstatus = 'F' AS hit FROM orders),
s AS (
  SELECT k, sum(CAST(hit AS INT)) / count(*) + 3 * sum(CASE WHEN p = 0 AND hit THEN 1 ELSE 0 END) / sum(CASE WHEN p = 0 THEN 1 ELSE 0 END)
            + 2 * sum(CASE WHEN p = 1 AND hit THEN 1 ELSE 0 END) / sum(CASE WHEN p = 1 THEN 1 ELSE 0 END) AS score
  FROM got GROUP BY k)
SELECT ['baseline', 'linear_100_to_1', 'linear_1000_to_10', 'steep_exp', 'highlight_p0_p1', 'highlight_p0_p2', 'gentle_tail'][k + 1] AS pattern, round(score, 6) AS score
FROM s ORDER BY s.score DESC, k LIMIT 1
""")
def cost_pattern_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pattern with the highest score, the first of equals."""
    o = read(spark, sf_dir, "orders").select((F.col("o_custkey") % 7).cast("int").alias("ordinal"), (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("priority"), (F.col("o_orderstatus") == "F").cast("int").alias("hit"))
    got = o.groupBy("ordinal", "priority").agg(F.sum("hit").alias("n_got"), F.count("*").alias("n_available"))
    names = pointing.cost_patterns(spark).select("pattern", "ordinal").distinct()
    met = got.join(names, "ordinal")
    scores = scoring.cost_pattern_scores(met).join(names, "pattern")
    return scoring.first_best(scores, "score", "ordinal").select("pattern", r6("score"))


@query(f"""
WITH {REMAINING}, s AS (SELECT s_suppkey AS ppc_id, s_acctbal AS score FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 20)
SELECT ppc_id, 'que_L_240101_' || CAST(row_number() OVER (ORDER BY score DESC, ppc_id) AS VARCHAR) AS ppc_code, CAST(row_number() OVER (ORDER BY score DESC, ppc_id) AS INTEGER) AS ppc_rank, score FROM s
""")
def top_pointings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ppc = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ppc_id"), F.col("s_acctbal").alias("score"))
    return scoring.top_pointings(ppc, 20, "score", "que_L_240101")


_PPC = """
ppc AS (SELECT 'ppc_' || CAST(l_suppkey AS VARCHAR) AS ppc_code, list(DISTINCT CAST(l_orderkey AS VARCHAR)) AS ids FROM lineitem GROUP BY l_suppkey),
al AS (SELECT ppc_code, unnest(ids) AS identify_code FROM ppc),
t AS (SELECT CAST(o_orderkey AS VARCHAR) AS identify_code, round(o_totalprice) AS rank_fin FROM orders WHERE o_orderstatus <> 'P'),
sched AS (SELECT 'ppc_' || CAST(user_id AS VARCHAR) AS ppc_code, min(ts) AS obstime FROM events GROUP BY user_id)"""


def _ppc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("ppc_"), F.col("l_suppkey").cast("string")).alias("ppc_code")).agg(F.collect_set(F.col("l_orderkey").cast("string")).alias("ppc_allocated_targets"))


def _ppc_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").cast("string").alias("identify_code"), F.round("o_totalprice").alias("rank_fin"))


@query(f"""
WITH {_PPC}
SELECT ppc_code, identify_code, rank_fin, CAST(obstime AS VARCHAR)[1:19] AS obstime, CAST(CAST(obstime AS DATE) - 1 AS VARCHAR) AS obsdate_in_hst
FROM sched JOIN al USING (ppc_code) JOIN t USING (identify_code)
""")
def plan_output_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    sched = read(spark, sf_dir, "events").groupBy(F.concat(F.lit("ppc_"), F.col("user_id").cast("string")).alias("ppc_code")).agg(F.min("ts").alias("obstime"))
    out = output.plan_output(_ppc(spark, sf_dir), sched, _ppc_targets(spark, sf_dir))
    return out.select("ppc_code", "identify_code", "rank_fin", F.date_format("obstime", "yyyy-MM-dd HH:mm:ss").alias("obstime"), F.col("obsdate_in_hst").cast("string").alias("obsdate_in_hst"))


@query(f"""
WITH {_PPC}
SELECT ppc_code, sum(rank_fin) AS ppc_priority, count(*) AS n_targets, round(count(*) / 2394, 9) AS usage_fraction, round(count(*) / 2394 * 100, 6) AS usage_percent
FROM al LEFT JOIN t USING (identify_code) GROUP BY ppc_code
""")
def pointing_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scoring.pointing_priority(_ppc(spark, sf_dir), _ppc_targets(spark, sf_dir))
    return out.withColumn("usage_fraction", F.round("usage_fraction", 9)).withColumn("usage_percent", F.round("usage_percent", 6))


@query(f"""
WITH {_PPC}, n AS (SELECT identify_code, count(*) AS n FROM al GROUP BY identify_code)
SELECT identify_code, rank_fin, coalesce(n, 0) * 900.0 AS exptime_assign FROM t LEFT JOIN n USING (identify_code)
""")
def allocated_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.allocated_counts(_ppc(spark, sf_dir), _ppc_targets(spark, sf_dir), 900.0)


@query("""
WITH s AS (SELECT o_custkey % 36 * 10 - 90 AS pa, round(o_totalprice) AS priority, o_custkey % 100 AS usage, o_orderkey % 97 AS t FROM orders)
SELECT CAST(pa AS DOUBLE) AS pa, sum(priority) AS priority, CAST(sum(usage) AS DOUBLE) AS usage, count(DISTINCT t) AS n_targets FROM s GROUP BY pa
""")
def shared_angle_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_custkey")
    c = read(spark, sf_dir, "orders").select((k % 36 * 10 - 90).cast("double").alias("pa"), F.round("o_totalprice").alias("priority"), (k % 100).cast("double").alias("usage"), F.array((F.col("o_orderkey") % 97).cast("string")).alias("allocated"))
    return scoring.shared_angle_score(c)


@query(f"""
WITH {UNIQUE}
SELECT proposal_id, sum(exptime_usr) / 3600 AS requested, max(allocated_time_tac) AS allocated FROM once
GROUP BY proposal_id HAVING sum(exptime_usr) / 3600 < max(allocated_time_tac)
""")
def under_requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completion.under_requested(unique_targets(spark, sf_dir))


@query("""
WITH p AS (SELECT o_orderkey AS ppc, o_totalprice / 100 AS total, greatest(2, CAST(o_custkey % 40 AS INTEGER)) AS n FROM orders),
q AS (SELECT *, CAST(greatest(2, ceil(1800 / (total / n))) AS INTEGER) AS per FROM p)
SELECT ppc, n AS n_frames, CAST(block AS INTEGER) AS block, CAST(least(per, n - block * per) AS INTEGER) AS nframe
FROM (SELECT *, unnest(range(0, CAST(ceil(n / per) AS BIGINT))) AS block FROM q)
""")
def ope_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ppc"), (F.col("o_totalprice") / 100).alias("total_exptime"), (F.col("o_custkey") % 40).cast("int").alias("n_split"))
    return output.exposure_frames(p).select("ppc", "n_frames", "block", "nframe")


@query(f"""
WITH {TARGETS}
SELECT ob_code, 'sci_P' || CAST(priority AS VARCHAR) AS target_class, CASE WHEN resolution = 'L' THEN 'brn' ELSE 'bmn' END AS arms,
       CASE WHEN grade = 'BUILDING' THEN 'C' WHEN grade = 'MACHINERY' THEN 'F' ELSE 'B' END AS grade FROM tgt
""")
def classes_and_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bound_targets(spark, sf_dir)
    pid = F.when(F.col("grade") == "BUILDING", "QN").when(F.col("grade") == "MACHINERY", "QF").otherwise("Q")
    return t.select("ob_code", output.target_class("priority").alias("target_class"), X.arms("resolution").alias("arms"), completion.grade(pid, F.col("grade").isin("BUILDING", "MACHINERY")).alias("grade"))


@query("""
SELECT n_nationkey AS obj_id, 0 AS kind FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)
""")
def unexpected_catalogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("obj_id"))
    rest = targets.unexpected(have, read(spark, sf_dir, "supplier").where("s_acctbal > 9000").select("s_nationkey"))
    return rest.withColumn("kind", F.lit(0))


@query("""
SELECT p_partkey, CAST(ntile(7) OVER (ORDER BY p_partkey) AS INTEGER) AS chunk FROM part
""")
def near_equal_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return targets.near_equal_chunks(read(spark, sf_dir, "part").select("p_partkey"), 7, ["p_partkey"])


@query()
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """200 targets, the same every time (a sampling operator)."""
    return targets.hash_sample(unique_targets(spark, sf_dir).select("ob_code", "proposal_id"), "ob_code", 200)


@query()
def greedy_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three pointings by the greedy planner over all remaining targets."""
    t = remaining_targets(spark, sf_dir)
    t = weights.weighted(weights.local_density(weights.rank_weight(t)))
    return pointing.plan_pointings(t, 3, radius=5.0).select("pointing", "ra", "dec", "score", F.size("ppc_allocated_targets").alias("n_targets"))


@query("""
WITH m AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS k, 0 AS s, o_totalprice AS v FROM orders WHERE o_custkey % 2 = 0
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 1, o_totalprice + 1 FROM orders WHERE o_custkey % 3 = 0)
SELECT k, arg_max(v, s) AS v FROM m GROUP BY k
""")
def later_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("k"), "o_custkey", F.col("o_totalprice").alias("v"))
    return output.later_wins(o.where("o_custkey % 2 = 0").select("k", "v"), o.where("o_custkey % 3 = 0").select("k", (F.col("v") + 1).alias("v")), key="k")


@query("""
WITH o AS (SELECT o_custkey AS proposal_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS e, o_totalprice AS usr, o_custkey % 10 - 0 AS tac FROM orders)
SELECT proposal_id, count(*) AS n, round(sum(coalesce(e, usr)), 2) AS exptime, CAST(max(tac) AS DOUBLE) AS allocated_time FROM o GROUP BY proposal_id
""")
def classic_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("proposal_id"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("exptime"), F.col("o_totalprice").alias("exptime_usr"),
        F.lit(None).cast("double").alias("allocated_time"), (F.col("o_custkey") % 10).cast("double").alias("allocated_time_tac"),
    )
    out = targets.classic_defaults(o)
    return out.groupBy("proposal_id").agg(F.count("*").alias("n"), F.round(F.sum("exptime"), 2).alias("exptime"), F.max("allocated_time").alias("allocated_time"))
