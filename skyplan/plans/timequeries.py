"""Queries on time: gaps, rotator, nights and the parsing of times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..functions.geometry import MOON_LATITUDE, MOON_LONGITUDE, MOON_PARALLAX
from ..operators import nights, schedule
from ..operators.lineage import written_folder
from ..sources import text as T
from . import query
from .binding import read, sky


@query("""
WITH o AS (SELECT CAST(user_id AS VARCHAR) || ' ' || CAST(CAST(ts AS DATE) AS VARCHAR) AS night, CAST(ts AS DATE) AS day, ts AS start FROM events),
w AS (SELECT DISTINCT night, day + INTERVAL 4 HOUR AS ws, day + INTERVAL 16 HOUR AS we FROM o),
i AS (SELECT o.night, ws, we, start, start + INTERVAL 1260 SECOND AS stop FROM o JOIN w USING (night) WHERE start BETWEEN ws AND we),
l AS (SELECT *, lag(start) OVER k AS b, lead(start) OVER k AS a FROM i WINDOW k AS (PARTITION BY night ORDER BY start)),
g AS (
  SELECT night, ws AS s, start AS e, 10 AS m FROM l WHERE b IS NULL
  UNION ALL SELECT night, stop, coalesce(a, we), CASE WHEN a IS NULL THEN 10 ELSE 15 END FROM l
  UNION ALL SELECT night, ws, we, 10 FROM w WHERE night NOT IN (SELECT night FROM i))
SELECT night, epoch_us(s) AS gap_start, epoch_us(e) AS gap_stop FROM g WHERE epoch_us(e) - epoch_us(s) > m * 60000000
""")
def schedule_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps in every user's own nights: all events count, and gaps show at any
    size."""
    t = F.col("ts").cast("timestamp")
    e = read(spark, sf_dir, "events").select(F.concat_ws(" ", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("night"), t.alias("start"))
    day = F.date_trunc("day", "start")
    w = e.select("night", (day + F.expr("INTERVAL 4 HOURS")).alias("win_start"), (day + F.expr("INTERVAL 16 HOURS")).alias("win_stop")).distinct()
    gaps = schedule.schedule_gaps(e, w)
    return gaps.select("night", F.unix_micros("gap_start").alias("gap_start"), F.unix_micros("gap_stop").alias("gap_stop"))


@query("""
WITH s AS (SELECT user_id AS ppc, ts, event_id, ((value * 7 + 180) % 360 + 360) % 360 - 180 AS inr FROM events),
l AS (SELECT *, lag(inr) OVER (PARTITION BY ppc ORDER BY ts, event_id) AS p FROM s)
SELECT ppc, round(coalesce(max(abs(inr - p)), 0), 6) AS max_jump,
       count(*) FILTER (WHERE (p >= 170 AND inr <= -170) OR (p <= -170 AND inr >= 170)) AS n_crossings,
       count(*) FILTER (WHERE (p >= 170 AND inr <= -170) OR (p <= -170 AND inr >= 170)) = 0 AS continuous
FROM l GROUP BY ppc
""")
def inr_jumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("ppc"), F.struct("ts", "event_id").alias("t"), X.wrap_signed(F.col("value") * 7).alias("inr"))
    return schedule.rotator_jumps(e).withColumn("max_jump", F.round("max_jump", 6))


@query("""
WITH l AS (
  SELECT user_id AS log, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, event_id,
         CASE WHEN event_id % 2 = 0 THEN 'slew time is ' || CAST(event_id % 300 AS VARCHAR) || '.5 sec' ELSE 'assigning ob/code_' || CAST(event_id % 50 AS VARCHAR) || '(x)' END AS line FROM events),
p AS (SELECT *, lag(line) OVER (PARTITION BY log ORDER BY n) AS prev FROM l),
q AS (SELECT log, n, 'code_' || CAST(event_id % 50 AS VARCHAR) AS ppc_code, CAST(regexp_extract(prev, 'slew time .*? ([0-9.]+) sec', 1) AS DOUBLE) AS slew FROM p WHERE line LIKE 'assigning%' AND prev LIKE 'slew%')
SELECT ppc_code, arg_max(slew, log * 1000000 + n) AS slew_time FROM q GROUP BY ppc_code
""")
def log_slew_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    i = F.col("event_id")
    slew = F.concat(F.lit("slew time is "), (i % 300).cast("string"), F.lit(".5 sec"))
    code = F.concat(F.lit("assigning ob/code_"), (i % 50).cast("string"), F.lit("(x)"))
    return schedule.slew_times(e.select(F.col("user_id").alias("log"), n.alias("n"), F.when(i % 2 == 0, slew).otherwise(code).alias("line")))


@query("""
WITH l AS (
  SELECT CAST(ts AS DATE) AS log, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS n, event_id FROM events),
p AS (SELECT *, lag(event_id) OVER (PARTITION BY log ORDER BY n) AS prev FROM l)
SELECT 'code_' || CAST(event_id % 50 AS VARCHAR) AS ppc_code, arg_max(prev % 300 + 0.5, epoch_us(CAST(log AS TIMESTAMP)) * 10 + n) AS slew_time
FROM p WHERE event_id % 2 = 1 AND prev % 2 = 0 GROUP BY 1
""")
def log_file_slews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of days, written as text files and read in splits."""
    i = F.col("event_id")
    slew = F.concat(F.lit("slew time is "), (i % 300).cast("string"), F.lit(".5 sec"))
    code = F.concat(F.lit("assigning ob/code_"), (i % 50).cast("string"), F.lit("(x)"))
    e = read(spark, sf_dir, "events").select(F.to_date("ts").cast("string").alias("log"), "ts", "event_id", F.when(i % 2 == 0, slew).otherwise(code).alias("value"))
    path = written_folder(spark, "logs")
    e.repartition("log").sortWithinPartitions("log", "ts", "event_id").select("log", "value").write.partitionBy("log").text(path)
    return schedule.slew_times(T.numbered_lines(spark, path))


@query("""
SELECT event_id, CAST(CAST(ts - INTERVAL 22 HOUR AS DATE) AS VARCHAR) AS night, CAST(CAST(ts AS DATE) - 1 AS VARCHAR) AS hst_date,
       epoch_us(CASE WHEN hour(ts) < 12 THEN ts + INTERVAL 1 DAY ELSE ts END) AS rolled FROM events
""")
def night_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, t = read(spark, sf_dir, "events"), F.col("ts").cast("timestamp")
    return e.select("event_id", X.night_of(t).cast("string").alias("night"), X.hst_date(t).cast("string").alias("hst_date"), F.unix_micros(X.roll_midnight(t)).alias("rolled"))


@query("""
WITH t AS (SELECT event_id, date_trunc('minute', ts) AS h, event_id % 6 AS k FROM events)
SELECT event_id, CASE WHEN k < 4 THEN CAST(h + INTERVAL 10 HOUR AS VARCHAR) END AS utc, k <> 5 AS has_date FROM t
""")
def hst_utc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four formats, one that isn't a time of day, one that isn't a date."""
    e, h, k = read(spark, sf_dir, "events"), F.date_trunc("minute", "ts"), F.col("event_id") % 6
    given = F.when(k == 0, F.date_format(h, "yyyy-MM-dd HH:mm:ss")).when(k == 1, F.date_format(h, "yyyy-MM-dd'T'HH:mm:ss")).when(k == 2, F.date_format(h, "yyyy-MM-dd HH:mm"))
    given = given.when(k == 3, F.date_format(h, "yyyy-MM-dd'T'HH:mm")).when(k == 4, F.date_format(h, "yyyy-MM-dd")).otherwise(F.lit("soon"))
    e = e.withColumn("given", given)
    return e.select("event_id", F.date_format(X.parse_hst("given"), "yyyy-MM-dd HH:mm:ss").alias("utc"), X.is_date("given").alias("has_date"))


@query("""
WITH p AS (SELECT o_orderkey AS k, o_custkey AS ppc_priority, o_orderdate AS t, CASE WHEN o_custkey % 9 = 0 THEN 'que_backup' ELSE 'que' END AS ppc_code FROM orders)
SELECT k, round(1 - ppc_priority / (SELECT max(ppc_priority) FROM p), 9) AS alpha, epoch_us(t + INTERVAL 1260 SECOND) AS stop, ppc_code = 'que_backup' AS is_backup FROM p
""")
def schedule_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    code = F.when(F.col("o_custkey") % 9 == 0, "que_backup").otherwise("que")
    s = o.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("ppc_priority"), F.col("o_orderdate").cast("timestamp").alias("obstime"), code.alias("ppc_code"))
    return schedule.timeline(s).select("k", F.round("alpha", 9).alias("alpha"), F.unix_micros("obstime_end").alias("stop"), "is_backup")


@query("""
WITH q AS (SELECT o_orderkey AS k, o_totalprice AS e, o_custkey % 4 AS n, o_custkey % 2 AS r FROM orders)
SELECT k, round(e + 300 + CASE WHEN n > 1 THEN (n - 1) * 60 ELSE 0 END, 2) AS exp, CASE WHEN r = 0 THEN 'brn' ELSE 'bmn' END AS arms FROM q
""")
def scheduler_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = read(spark, sf_dir, "orders"), F.col("o_custkey")
    p = o.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("ppc_exptime"), (c % 4).alias("n_split"), F.when(c % 2 == 0, "L").otherwise("M").alias("ppc_resolution"))
    return schedule.scheduler_requests(p).select("k", F.round("exp", 2).alias("exp"), "arms")


@query()
def greedy_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three slots a night, every night; a pointing is observed once."""
    e = read(spark, sf_dir, "events").withColumn("night", F.to_date("ts"))
    c = e.groupBy("night", F.col("user_id").alias("ppc")).agg(F.sum("value").alias("score"))
    return schedule.greedy_schedule(c, 3)


@query("""
WITH l AS (
  SELECT o_custkey AS doc, CAST(o_orderdate AS DATE) AS d, o_orderkey % 12 + 12 AS h1, o_orderkey % 10 AS h2, o_orderkey % 40 = 0 AS bad FROM orders),
ok AS (SELECT doc, NOT bool_or(bad) AS ok FROM l GROUP BY doc)
SELECT doc, CASE WHEN ok THEN epoch_us(d + to_hours(CAST(h1 AS INTEGER))) END AS start, CASE WHEN ok THEN epoch_us(d + INTERVAL 1 DAY + to_hours(CAST(h2 AS INTEGER))) END AS stop FROM l JOIN ok USING (doc)
""")
def obs_text_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k = read(spark, sf_dir, "orders"), F.col("o_orderkey")
    line = F.when(k % 40 == 0, "no window").otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd "), (k % 12 + 12).cast("string"), F.lit(":00-"), (k % 10).cast("string"), F.lit(":00")))
    found = T.observation_windows(o.select(F.col("o_custkey").alias("doc"), line.alias("line")))
    return found.select("doc", F.unix_micros("start").alias("start"), F.unix_micros("stop").alias("stop"))


@query("""
SELECT page_id AS key, CAST(p_n AS INTEGER) AS n_rows FROM (
  SELECT page_id, (page_id % 4 + 1) AS p_n FROM pages)
""")
def html_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows under the header of a table that is put behind each page."""
    n = F.col("page_id") % 4 + 1
    body = F.repeat(F.lit("<tr><td>2026-03-01</td><td>Spec</td></tr>"), n.cast("int"))
    page = F.concat("html", F.lit("<table><tr><th>Date</th><th>Instrument</th></tr>"), body, F.lit("</table>"))
    rows = T.table_with_header(T.html_rows(read(spark, sf_dir, "pages").select("page_id", page.alias("html"))), ["date", "instrument"])
    return rows.groupBy("key").agg(F.count("*").cast("int").alias("n_rows"))


@query("""
SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'S24A-' || CAST(100 + conv_id % 900 AS VARCHAR) END AS proposal_id FROM conversations WHERE turn % 3 = 0
""")
def schedule_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third line holds an entry; the others, as they are, should not,
    so that an entry found in them shows as a row that the SQL lacks."""
    c = read(spark, sf_dir, "conversations")
    entry = F.concat(F.lit("18:30-23:00 {grey} SPEC (someone; S24A-"), (100 + F.col("conv_id") % 900).cast("string"), F.lit(") and more"))
    line = F.when(F.col("turn") % 3 == 0, entry).otherwise(F.col("text"))
    return T.schedule_entries(c.select("conv_id", "turn", line.alias("line")), "SPEC").select("conv_id", "turn", "proposal_id")


_NIGHT_SLOTS = "SELECT CAST(n AS INTEGER) AS night, CAST(k AS INTEGER) AS slot, TIMESTAMP '2024-03-01 06:00:00' + to_days(CAST(n AS INTEGER)) + to_minutes(CAST(k * 60 AS INTEGER)) AS t FROM range(5) a(n), range(9) b(k)"


def _night_slots(spark: SparkSession) -> DataFrame:
    start = F.lit("2024-03-01 06:00:00").cast("timestamp")
    rows = spark.range(5).select(F.col("id").cast("int").alias("night")).crossJoin(spark.range(9).select(F.col("id").cast("int").alias("slot")))  # a row per slot
    return rows.withColumn("t", start + F.make_dt_interval(F.col("night"), F.col("slot")))


@query(f"""
WITH p AS (SELECT p_partkey AS ppc, (p_partkey * CAST(137.508 AS DOUBLE)) % 360.0 AS ra, (p_partkey * CAST(61.8034 AS DOUBLE)) % 120.0 - 30 AS dec FROM part),
s AS ({_NIGHT_SLOTS}),
a AS (
  SELECT ppc, night, slot, degrees(asin(sin(radians(dec)) * sin(radians(19.8256)) + cos(radians(dec)) * cos(radians(19.8256))
         * cos(radians(((280.46061837 + 360.98564736629 * (epoch_us(t) / 86400e6 + 2440587.5 - 2451545.0) - 155.4761) % 360 + 360) % 360 - ra)))) AS el FROM p, s)
SELECT ppc, night, count(*) AS n_slots, round(max(el), 6) AS highest FROM a WHERE el BETWEEN 30 AND 75 GROUP BY ppc, night
""")
def visible_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of five nights in which a pointing stands within the limits, by
    intervals of hour angle; the SQL computes every pair."""
    ra, dec = sky("p_partkey")
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("ppc"), ra.alias("ra"), dec.alias("dec"))
    pairs = nights.visible_pairs(p, _night_slots(spark))
    return pairs.groupBy("ppc", "night").agg(F.count("*").alias("n_slots"), F.round(F.max("altitude"), 6).alias("highest"))


@query()
def schedule_of_nights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nights over all parts as pointings, with slew, delay and elevation."""
    ra, dec = sky("p_partkey")
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("ppc"), ra.alias("ra"), dec.alias("dec"), (F.col("p_retailprice") / 1000).alias("rank"), (F.col("p_size") % 10).alias("priority"))
    return nights.schedule_nights(p, _night_slots(spark), beam=50)


def _moon_sql() -> str:
    """The Moon's place at t and the sidereal time."""
    terms = lambda f, table: " + ".join(f"{a} * {f}(radians({p} + {n} * cen))" for a, p, n in table)
    return f"""
c AS (SELECT t, (epoch_us(t) / 86400e6 + 2440587.5 - 2451545.0) / 36525 AS cen FROM night),
e AS (
  SELECT t, radians((280.46061837 + 360.98564736629 * cen * 36525 - 155.4761) % 360) AS here, radians(218.32 + 481267.881 * cen + {terms("sin", MOON_LONGITUDE)}) AS lon,
         radians({terms("sin", MOON_LATITUDE)}) AS lat, 1 / sin(radians(0.9508 + {terms("cos", MOON_PARALLAX)})) AS r FROM c),
x AS (
  SELECT here, r * cos(lat) * cos(lon) - cos(radians(19.8256)) * cos(here) AS x, r * (0.9175 * cos(lat) * sin(lon) - 0.3978 * sin(lat)) - cos(radians(19.8256)) * sin(here) AS y,
         r * (0.3978 * cos(lat) * sin(lon) + 0.9175 * sin(lat)) - sin(radians(19.8256)) AS z FROM e),
m AS (SELECT here, x / sqrt(x * x + y * y + z * z) AS x, y / sqrt(x * x + y * y + z * z) AS y, z / sqrt(x * x + y * y + z * z) AS z FROM x)"""


@query(f"""
WITH night AS (SELECT TIMESTAMP '2024-03-20 10:00:00' + to_minutes(CAST(k * 15 AS INTEGER)) AS t FROM range(28) g(k)), {_moon_sql()},
p AS (SELECT p_partkey AS p_id, radians((p_partkey * CAST(137.508 AS DOUBLE)) % 360.0) AS ra, radians((p_partkey * CAST(61.8034 AS DOUBLE)) % 120.0 - 30) AS dec FROM part),
a AS (
  SELECT p_id, degrees(asin(sin(dec) * sin(radians(19.8256)) + cos(dec) * cos(radians(19.8256)) * cos(here - ra))) AS el,
         degrees(acos(greatest(-1, least(1, cos(dec) * cos(ra) * x + cos(dec) * sin(ra) * y + sin(dec) * z)))) AS away FROM p, m)
SELECT p_id, count(*) FILTER (WHERE el > 32 AND el < 75 AND away > 30) AS n_times, bool_or(el > 32 AND el < 75 AND away > 30) AS is_visible FROM a GROUP BY p_id
""")
def moon_visibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets that a night sees between the altitudes and off the Moon."""
    ra, dec = sky("p_partkey")
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("p_id"), ra.alias("ra"), dec.alias("dec"))
    t = spark.sql("SELECT explode(sequence(TIMESTAMP '2024-03-20 10:00:00', TIMESTAMP '2024-03-20 16:45:00', INTERVAL 15 MINUTES)) AS t")
    return schedule.with_visible_times(p, t, moon_from=30.0).select("p_id", "n_times", "is_visible")
