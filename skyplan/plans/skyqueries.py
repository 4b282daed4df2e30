"""Queries on the sky and on the focal plane."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import scalar as X
from ..operators import design, pointing, schedule, scoring, spatial
from . import query
from .binding import places, read, separation_sql, sky, sky_sql

_PARTS = f"p AS (SELECT p_partkey AS id, {sky_sql('p_partkey')}, p_retailprice FROM part)"
_SUPPLIERS = f"s AS (SELECT s_suppkey AS id, {sky_sql('s_suppkey * 7 + 1')}, s_acctbal FROM supplier)"


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ra, dec = sky(F.col("s_suppkey") * 7 + 1)
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), ra.alias("ra"), dec.alias("dec"), "s_acctbal")


@query(f"""
WITH {_PARTS}, {_SUPPLIERS}
SELECT p.id AS p_id FROM p WHERE EXISTS (SELECT 1 FROM s WHERE {separation_sql("p", "s")} <= 2)
""")
def cone_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.near_any(places(spark, sf_dir, "part", "p_partkey", "p"), _suppliers(spark, sf_dir)).select("p_id")


@query(f"""
WITH {_PARTS}, {_SUPPLIERS},
d AS (SELECT p.id AS l_id, s.id AS r_id, {separation_sql("p", "s")} AS separation FROM p, s)
SELECT l_id, arg_min(r_id, separation) AS ppc_id, round(min(separation), 6) AS separation FROM d WHERE separation <= 5 GROUP BY l_id
""")
def nearest_pointing(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = places(spark, sf_dir, "part", "p_partkey", "l")
    found = pointing.nearest_pointing(t, _suppliers(spark, sf_dir).withColumnRenamed("id", "r_id"), 5.0)
    return found.withColumn("separation", F.round("separation", 6))


@query(f"""
WITH RECURSIVE {_SUPPLIERS},
e AS (SELECT a.id AS a, b.id AS b FROM s a, s b WHERE a.id <> b.id AND {separation_sql("a", "b")} <= 4),
r AS (SELECT id, id AS g FROM s UNION SELECT e.b, r.g FROM r JOIN e ON r.id = e.a)
SELECT id, min(g) AS "group" FROM r GROUP BY id
""")
def pointing_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.connected_groups(_suppliers(spark, sf_dir).select("id", "ra", "dec"), 4.0)


@query(f"""
WITH RECURSIVE {_PARTS},
e AS (SELECT a.id AS a, b.id AS b FROM p a, p b WHERE a.id <> b.id AND abs(a.dec - b.dec) <= 1.38 AND {separation_sql("a", "b")} <= 1.38),
r AS (SELECT id, id AS g FROM p UNION SELECT e.b, r.g FROM r JOIN e ON r.id = e.a AND r.g < e.b),
c AS (SELECT id, min(g) AS "group" FROM r GROUP BY id),
h AS (SELECT "group", sum(round(p_retailprice)) AS total FROM c JOIN p USING (id) GROUP BY "group")
SELECT id, "group", total, CAST(dense_rank() OVER (ORDER BY total DESC, "group") AS BIGINT) AS "order" FROM c JOIN h USING ("group")
""")
def target_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all targets, the heaviest first."""
    price = read(spark, sf_dir, "part").select("p_partkey", F.round("p_retailprice").alias("rank_fin"))
    at = places(spark, sf_dir, "part", "p_partkey", "p").join(price, F.col("p_id") == F.col("p_partkey")).select(F.col("p_id").alias("id"), "ra", "dec", "rank_fin")
    return spatial.clusters_by_weight(at, 1.38).select("id", "group", "total", "order")


@query(f"""
WITH {_PARTS}, {_SUPPLIERS}
SELECT p.id AS fiber_id, s.id AS source_id, round({separation_sql("p", "s")} * 3600, 3) AS separation FROM p, s
WHERE s.s_acctbal < 5000 AND sqrt(pow((s.ra - p.ra) * cos(radians(p.dec)), 2) + pow(s.dec - p.dec, 2)) < 1.5
""")
def bright_near_fibres(spark: SparkSession, sf_dir: str) -> DataFrame:
    fiber = places(spark, sf_dir, "part", "p_partkey", "fiber")
    star = _suppliers(spark, sf_dir).where("s_acctbal < 5000").select(F.col("id").alias("source_id"), "ra", "dec", F.col("s_acctbal").alias("g_mag"))
    found = design.bright_near_fibers(fiber, star, 1.5)
    return found.select("fiber_id", "source_id", F.round("separation", 3).alias("separation"))


_XY = "f AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) * 600 AS x, CAST(embedding[2] AS DOUBLE) * 600 AS y FROM embeddings)"
_POINTS = """pts AS (
  SELECT 0 AS i, 0.0 AS px, 0.0 AS py
  UNION ALL SELECT CAST(1 + k AS INTEGER), 100 * cos(radians(105 + 60.0 * k)), 100 * sin(radians(105 + 60.0 * k)) FROM range(6) t(k)
  UNION ALL SELECT CAST(7 + k AS INTEGER), 175 * cos(radians(70 + 360.0 / 13 * k)), 175 * sin(radians(70 + 360.0 / 13 * k)) FROM range(13) t(k)),
sec AS (
  SELECT vec_id, label, x, y, CAST(arg_min(i, d2) AS INTEGER) AS sector
  FROM (SELECT f.*, i, pow(x - px, 2) + pow(y - py, 2) AS d2 FROM f, pts) GROUP BY vec_id, label, x, y)"""


def _fibers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", (F.col("embedding")[0].cast("double") * 600).alias("x"), (F.col("embedding")[1].cast("double") * 600).alias("y"))


@query(f"WITH {_XY}, {_POINTS} SELECT vec_id, sector FROM sec")
def nearest_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.nearest_sector(_fibers(spark, sf_dir)).select("vec_id", "sector")


@query(f"""
WITH {_XY}, {_POINTS},
n AS (SELECT vec_id % 5 AS design_id, label % 2 + 2 AS target_type, sector, count(*) AS n FROM sec GROUP BY ALL)
SELECT design_id, CAST(target_type AS INTEGER) AS target_type, round(avg(n), 6) AS mean, round(stddev_pop(n), 6) AS std,
       CASE WHEN count(*) < 12 THEN 0 ELSE min(n) END AS min, max(n) AS max, CAST(sum(n) AS BIGINT) AS sum FROM n GROUP BY design_id, target_type
""")
def sector_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = spatial.nearest_sector(_fibers(spark, sf_dir)).withColumn("design_id", F.col("vec_id") % 5).withColumn("target_type", (F.col("label") % 2 + 2).cast("int"))
    return spatial.sector_stats(f).withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@query(f"""
WITH {_XY},
c AS (SELECT *, label * 12.0 - 60 AS cx, 60 - label * 12.0 AS cy, 60.0 AS l1, 20.0 + label AS l2 FROM f)
SELECT vec_id, side FROM (
  SELECT vec_id, CASE WHEN sqrt(pow(x - cx, 2) + pow(y - cy, 2)) > l1 + l2 THEN 1 WHEN sqrt(pow(x - cx, 2) + pow(y - cy, 2)) < abs(l1 - l2) THEN -1 ELSE 0 END AS side FROM c)
WHERE side <> 0
""")
def patrol_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _fibers(spark, sf_dir).withColumn("cobra_id", F.col("label"))
    c = f.select("cobra_id").distinct().select("cobra_id", (F.col("cobra_id") * 12.0 - 60).alias("x"), (60 - F.col("cobra_id") * 12.0).alias("y"), F.lit(60.0).alias("l1"), (F.lit(20.0) + F.col("cobra_id")).alias("l2"))
    return design.patrol_violations(f, c).select("vec_id", "side")


@query(f"""
WITH {_XY}
SELECT vec_id, CAST(floor(((degrees(atan2(y, x)) % 360) + 360) % 360 / 60) + CASE WHEN sqrt(x * x + y * y) > 220 / sqrt(2) THEN 6 ELSE 0 END AS INTEGER) AS wedge FROM f
""")
def wedge_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fibers(spark, sf_dir).select("vec_id", G.wedge("x", "y").alias("wedge"))


def _camera_counts(e: DataFrame) -> DataFrame:
    s = e.select((F.col("vec_id") % 6).alias("design_id"), (F.col("label") % 6).cast("int").alias("cam"), (15 + F.abs(F.col("embedding")[0].cast("double")) * 20).alias("magnitude"))
    return design.camera_counts(s)


@query("""
WITH s AS (SELECT vec_id % 6 AS design_id, CAST(label % 6 AS INTEGER) AS cam, 15 + abs(CAST(embedding[1] AS DOUBLE)) * 20 AS m FROM embeddings),
c AS (SELECT DISTINCT design_id, CAST(k AS INTEGER) AS cam FROM s, range(6) t(k)),
n AS (SELECT c.design_id, c.cam, count(m) AS n, count(*) FILTER (WHERE m <= 19) AS n_bright FROM c LEFT JOIN s ON c.design_id = s.design_id AND c.cam = s.cam GROUP BY ALL)
SELECT design_id, cam, n, n_bright FROM n UNION ALL SELECT design_id, NULL, CAST(sum(n) AS BIGINT), CAST(sum(n_bright) AS BIGINT) FROM n GROUP BY design_id
""")
def camera_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _camera_counts(read(spark, sf_dir, "embeddings"))


@query(f"""
WITH {_SUPPLIERS}, a AS (SELECT s.*, k, 30 + 60 * k + id % 90 AS t FROM s, range(7) g(k)),
o AS (SELECT *, asin(sin(radians(dec)) * cos(radians(0.69)) + cos(radians(dec)) * sin(radians(0.69)) * cos(radians(t))) AS d2 FROM a)
SELECT id, CAST(k AS INTEGER) AS k, round((degrees(radians(ra) + atan2(sin(radians(t)) * sin(radians(0.69)) * cos(radians(dec)), cos(radians(0.69)) - sin(radians(dec)) * sin(d2))) + 720) % 360, 5) AS ra,
       round(degrees(d2), 5) AS dec FROM o
""")
def field_hexagon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corners of the field, the first one again at the end."""
    s = _suppliers(spark, sf_dir).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(6))))
    ra, dec = G.offset("ra", "dec", 30 + 60 * F.col("k") + F.col("id") % 90, 0.69)
    return s.select("id", "k", F.round(ra, 5).alias("ra"), F.round(dec, 5).alias("dec"))


_HMS = "printf('%02d%02d%02d.%03d', u // 3600000, u // 60000 % 60, u // 1000 % 60, u % 1000)"


@query(f"""
WITH {_SUPPLIERS}, q AS (SELECT id, dec, CAST(round(ra / 15 * 3600 * 1000) AS BIGINT) % 86400000 AS u, CAST(round(abs(dec) * 360000) AS BIGINT) AS v FROM s)
SELECT id, {_HMS} AS ra_text, CASE WHEN dec < 0 THEN '-' ELSE '+' END || printf('%02d%02d%02d.%02d', v // 360000, v // 6000 % 60, v // 100 % 60, v % 100) AS dec_text FROM q
""")
def coord_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suppliers(spark, sf_dir).select("id", X.ra_text("ra").alias("ra_text"), X.dec_text("dec").alias("dec_text"))


_LST = "((280.46061837 + 360.98564736629 * (epoch_us({t}) / 86400e6 + 2440587.5 - 2451545.0) - 155.4761) % 360 + 360) % 360"
_ALT = "degrees(asin(sin(radians({d})) * sin(radians(19.8256)) + cos(radians({d})) * cos(radians(19.8256)) * cos(radians({lst} - {r}))))"


@query(f"""
WITH {_SUPPLIERS}, t AS (SELECT TIMESTAMP '2024-03-01 05:00:00' + to_hours(CAST(k AS INTEGER)) AS t FROM range(12) g(k)),
e AS (SELECT t, {_ALT.format(d="dec", r="ra", lst=_LST.format(t="t"))} AS el FROM s, t),
b AS (SELECT t, count(*) FILTER (WHERE el BETWEEN 30 AND 75) AS n, sum(el) FILTER (WHERE el BETWEEN 30 AND 75) AS total FROM e GROUP BY t)
SELECT CAST(t AS VARCHAR) AS time, n, round(total, 3) AS total FROM b ORDER BY b.n DESC, b.total DESC, t LIMIT 1
""")
def best_observation_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = spark.sql("SELECT explode(sequence(TIMESTAMP '2024-03-01 05:00:00', TIMESTAMP '2024-03-01 16:00:00', INTERVAL 1 HOUR)) AS time")
    c = _suppliers(spark, sf_dir).crossJoin(t).withColumn("elevation", G.altitude("ra", "dec", "time"))
    return scoring.best_time(c).select(F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "n", F.round("total", 3).alias("total"))


@query(f"""
WITH {_PARTS}, t AS (SELECT TIMESTAMP '2024-03-01 10:00:00' + to_minutes(CAST(k * 15 AS INTEGER)) AS t FROM range(28) g(k)),
g AS (SELECT CAST(r AS INTEGER) AS ra, CAST(d - 30 AS INTEGER) AS dec FROM range(361) a(r), range(121) b(d)),
v AS (SELECT ra, dec, bool_or(a > 32 AND a < 75) AS ok FROM (SELECT ra, dec, {_ALT.format(d="dec", r="ra", lst=_LST.format(t="t"))} AS a FROM g, t) GROUP BY ra, dec)
SELECT id AS p_id, coalesce(ok, false) AS is_visible FROM p LEFT JOIN v ON round_even(p.ra, 0) = v.ra AND round_even(p.dec, 0) = v.dec
""")
def visibility_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = spark.sql("SELECT explode(sequence(TIMESTAMP '2024-03-01 10:00:00', TIMESTAMP '2024-03-01 16:45:00', INTERVAL 15 MINUTES)) AS t")
    return schedule.with_visibility(places(spark, sf_dir, "part", "p_partkey", "p"), schedule.visibility_grid(t)).select("p_id", "is_visible")


@query(f"""
WITH {_SUPPLIERS}, c AS (SELECT id, -90.0 + 10 * k AS pa, (id + k) % 5 > 0 AS ok, (id * 3 + k) % 4 AS nb, CAST((id * 7 + k * 3) % 11 AS DOUBLE) AS score, (id + 2 * k) % 9 AS n FROM s, range(36) g(k))
SELECT id AS ppc, pa, score, n AS n_assigned FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, n DESC, pa) AS rn FROM c WHERE ok AND nb = 0) WHERE rn = 1
""")
def pa_candidates_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    angles = [(k, a) for k, a in enumerate(pointing.angle_candidates())]
    c = _suppliers(spark, sf_dir).crossJoin(spark.createDataFrame(angles, "k int, pa double"))
    i, k = F.col("id"), F.col("k")
    c = c.select(i.alias("ppc"), "pa", ((i + k) % 5 > 0).alias("continuous"), ((i * 3 + k) % 4).alias("n_bright"), ((i * 7 + k * 3) % 11).cast("double").alias("score"), ((i + 2 * k) % 9).alias("n_assigned"))
    return pointing.best_angle(c)


@query("""
SELECT s_suppkey AS id, round(CASE WHEN p > 270 THEN p - 360 ELSE p END, 6) AS pa, round(((s_acctbal + 180) % 360 + 360) % 360 - 180, 6) AS signed
FROM (SELECT *, (s_acctbal % 360 + 360) % 360 AS p FROM supplier)
""")
def angle_wraps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.round(X.wrap_pa("s_acctbal"), 6).alias("pa"), F.round(X.wrap_signed("s_acctbal"), 6).alias("signed"))


@query(f"""
WITH {_SUPPLIERS},
o AS (SELECT i, j FROM range(-6, 7) a(i), range(-6, 7) b(j)),
c AS (SELECT round_even(ra, 0) + i AS gx, round_even(dec, 0) + j AS gy, ra, dec, abs(s_acctbal) AS w FROM s, o),
m AS (SELECT gx, gy, sum(w * (1 - sqrt(pow(gx - ra, 2) + pow(gy - dec, 2)) / 5)) AS density FROM c WHERE sqrt(pow(gx - ra, 2) + pow(gy - dec, 2)) < 5 GROUP BY gx, gy),
z AS (SELECT gx, gy, density, (density - avg(density) OVER ()) / stddev_pop(density) OVER () AS z FROM m),
t AS (SELECT *, row_number() OVER (ORDER BY gx, gy) - 1 AS i, count(*) OVER () AS n FROM z WHERE z = (SELECT max(z) FROM z))
SELECT gx AS ra, gy AS dec, round(density, 6) AS density, round(z, 6) AS z FROM t WHERE i = least(round_even(n * 0.5, 0), n - 1)
""")
def density_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _suppliers(spark, sf_dir).select("ra", "dec", F.abs("s_acctbal").alias("weight"))
    peak = spatial.middle_of_peak(spatial.density_peak(p, 5.0, 1.0))
    return peak.select("ra", "dec", F.round("density", 6).alias("density"), F.round("z", 6).alias("z"))


@query(f"""
WITH {_PARTS}, {_SUPPLIERS},
d AS (SELECT p.id AS t, s.id AS g, round({separation_sql("p", "s")}, 9) AS sep, p_retailprice AS w FROM p, s),
o AS (SELECT t, arg_min(g, sep) AS g, min(sep) AS sep, any_value(w) AS w FROM d WHERE sep <= 6 GROUP BY t)
SELECT g AS pointing, CAST(t AS VARCHAR) AS identify_code FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY w DESC, sep, CAST(t AS VARCHAR)) AS rn FROM o) WHERE rn <= 3
""")
def greedy_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three fibres to each pointing, so that the limit of fibres shows."""
    ra, dec = sky("p_partkey")
    t = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("identify_code"), ra.alias("ra"), dec.alias("dec"), F.col("p_retailprice").alias("weight"))
    return pointing.greedy_assignment(t, _suppliers(spark, sf_dir).withColumnRenamed("id", "pointing"), 3, 6.0).select("pointing", "identify_code")
