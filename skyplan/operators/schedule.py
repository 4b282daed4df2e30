"""Nights, slots, gaps and rotator continuity."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.geometry import LATITUDE, altitude, moon, rotator_angle, separation, sidereal
from ..functions.scalar import SLOT_SECONDS, arms, col

#: Degrees at which the rotator wraps.
WRAP_EDGE = 170.0


def minutes(a: Column | str, b: Column | str) -> Column:
    return (F.unix_micros(col(b).cast("timestamp")) - F.unix_micros(col(a).cast("timestamp"))) / 60e6


def schedule_gaps(observed: DataFrame, window: DataFrame, slot_seconds: int = SLOT_SECONDS, edge: float = 10.0, inner: float = 15.0) -> DataFrame:
    """observed (night, start), window (night, win_start, win_stop) -> gaps
    (night, gap_start, gap_stop): before the first and after the last slot of
    more than `edge` minutes, between slots of more than `inner`, and windows
    without a slot. One window function per night."""
    stop = F.col("start") + F.make_interval(secs=F.lit(slot_seconds))
    inside = observed.join(window, "night").where(F.col("start").between(F.col("win_start"), F.col("win_stop"))).withColumn("stop", stop)
    w = Window.partitionBy("night", "win_start", "win_stop").orderBy("start")
    each = inside.withColumns({"before": F.lag("start").over(w), "after": F.lead("start").over(w)})
    first = each.where("before is null").select("night", F.col("win_start").alias("gap_start"), F.col("start").alias("gap_stop"), F.lit(edge).alias("least"))
    rest = each.select("night", F.col("stop").alias("gap_start"), F.coalesce("after", "win_stop").alias("gap_stop"), F.when(F.col("after").isNull(), edge).otherwise(inner).alias("least"))
    used = inside.select("night", "win_start", "win_stop").distinct()
    empty = window.join(used, ["night", "win_start", "win_stop"], "left_anti").select("night", F.col("win_start").alias("gap_start"), F.col("win_stop").alias("gap_stop"), F.lit(edge).alias("least"))
    found = first.unionByName(rest).unionByName(empty)
    return found.where(minutes("gap_start", "gap_stop") > F.col("least")).drop("least")


def rotator_jumps(samples: DataFrame, key: str = "ppc", order: str = "t", angle: str = "inr", edge: float = WRAP_EDGE) -> DataFrame:
    """By pointing: greatest step between samples, crossings of the wrap, and
    whether it is continuous (no crossing, no missing angle)."""
    w = Window.partitionBy(key).orderBy(order)
    x = samples.withColumn("__p", F.lag(angle).over(w))
    a, b = F.col("__p"), F.col(angle)
    crosses = ((a >= edge) & (b <= -edge)) | ((a <= -edge) & (b >= edge))
    by = x.groupBy(key).agg(F.coalesce(F.max(F.abs(b - a)), F.lit(0.0)).alias("max_jump"), F.count_if(crosses).alias("n_crossings"), F.count_if(b.isNull() | F.isnan(b)).alias("__bad"))
    return by.withColumn("continuous", (F.col("n_crossings") == 0) & (F.col("__bad") == 0)).drop("__bad")


def rotator_samples(ppc: DataFrame, nights: DataFrame, step_minutes: int = 20) -> DataFrame:
    """ppc (ppc, ra, dec, pa) x nights (start, stop): an angle each step, both
    ends included."""
    times = nights.select(F.explode(F.sequence("start", "stop", F.make_dt_interval(mins=F.lit(step_minutes)))).alias("t"))
    return ppc.crossJoin(times).withColumn("inr", rotator_angle("ra", "dec", "pa", "t"))


def slew_times(lines: DataFrame) -> DataFrame:
    """lines (log, n, line) of a scheduler, numbered without gaps ->
    (ppc_code, slew_time): the line that assigns a code follows that of its
    slew; the last pair of a code counts. A slew's time is the word before the
    unit, a code what stands between the first slash and the bracket. Lines
    that tell neither go in the scan, and the rest meet by log and number, so
    that no task needs a whole log in order."""
    told = F.substring_index(F.substr("line", F.instr("line", "slew time ") + 10), " sec", 1)
    slew = F.when(F.contains("line", F.lit("slew time ")) & F.contains("line", F.lit(" sec")), F.substring_index(told, " ", -1).try_cast("double"))
    named = F.substring_index(F.substr("line", F.instr("line", "assigning ") + 10), "(", 1)
    code = F.when(F.contains("line", F.lit("(")) & (F.instr(named, "/") > 0), F.trim(F.substr(named, F.instr(named, "/") + 1)))
    slews = lines.where(F.contains("line", F.lit("slew time "))).select("log", (F.col("n") + 1).alias("n"), slew.alias("slew")).where("slew is not null")
    codes = lines.where(F.contains("line", F.lit("assigning"))).select("log", "n", code.alias("ppc_code")).where("ppc_code <> ''")
    return codes.join(slews, ["log", "n"]).groupBy("ppc_code").agg(F.max_by("slew", F.struct("log", "n")).alias("slew_time"))


def schedule_with_slew(schedule: DataFrame, slew: DataFrame) -> DataFrame:
    return schedule.join(slew, "ppc_code", "left")


def night_window(nights: DataFrame, starts: DataFrame, stops: DataFrame) -> DataFrame:
    """nights (night, evening, morning: twilights) with overrides (at) of the
    start and the stop. Defaults: 5 minutes before evening and 30 after
    morning twilight. An override serves the first night that it fits."""
    n = nights.select("night", (F.col("evening") - F.expr("INTERVAL 5 MINUTES")).alias("d0"), (F.col("morning") + F.expr("INTERVAL 30 MINUTES")).alias("d1"))
    at, hour = F.col("at"), F.expr("INTERVAL 1 HOUR")
    today, next_day = F.to_date("at") == F.col("night"), F.to_date("at") == F.date_add("night", 1)

    def chosen(given: DataFrame, value: Column, name: str) -> DataFrame:
        met = n.join(given, today | next_day).withColumn("value", value).where("value is not null")
        met = met.withColumn("__k", F.row_number().over(Window.partitionBy("at").orderBy("night"))).where("__k = 1")
        return met.groupBy("night").agg(F.min_by("value", "at").alias(name))

    start = F.when(today & (at >= F.col("d0")), at).when(today & (at > F.col("d0") - hour), F.col("d0")).when(next_day & (at <= F.col("d1")), at)
    stop = F.when(today & (at >= F.col("d0")), at).when(next_day & (at <= F.col("d1")), at).when(next_day & (at <= F.col("d1") + hour), F.col("d1"))
    out = n.join(chosen(starts, start, "s"), "night", "left").join(chosen(stops, stop, "e"), "night", "left")
    return out.select("night", F.coalesce("s", "d0").alias("start"), F.coalesce("e", "d1").alias("stop"))


def visibility_grid(times: DataFrame, low: float = 32.0, high: float = 75.0, step: int = 1) -> DataFrame:
    """Cells (ra, dec) of whole degrees that are within the altitudes at any
    of the times: a grid of fixed size against a few times."""
    spark = times.sparkSession
    grid = spark.range(0, 361, step).select(F.col("id").cast("int").alias("ra")).crossJoin(spark.range(-30, 91, step).select(F.col("id").cast("int").alias("dec")))
    alt = altitude(F.col("ra").cast("double"), F.col("dec").cast("double"), "t")
    return grid.crossJoin(times).groupBy("ra", "dec").agg(F.bool_or((alt > low) & (alt < high)).alias("is_visible"))


def with_visibility(target: DataFrame, grid: DataFrame) -> DataFrame:
    """The cell of each target, to the nearest degree, half to even."""
    g = grid.select(F.col("ra").alias("__r"), F.col("dec").alias("__d"), F.col("is_visible").alias("__v"))
    met = target.join(g, (F.rint("ra").cast("int") == F.col("__r")) & (F.rint("dec").cast("int") == F.col("__d")), "left")
    return met.withColumn("is_visible", F.coalesce("__v", F.lit(False))).drop("__r", "__d", "__v")


def with_visible_times(target: DataFrame, times: DataFrame, low: float = 32.0, high: float = 75.0, moon_from: float = 0.0, moon_to: float = 360.0) -> DataFrame:
    """target (ra, dec, ...), times (t) of a night -> with n_times, how many
    of them see the target between the altitudes and the distances from the
    Moon, and is_visible. The sidereal times and the Moon's places are one
    short array, which every target goes through where it is: no grid, no join
    of targets and times. A target without a place is seen at none."""
    ra, dec = moon("t")
    night = times.agg(F.collect_list(F.struct(sidereal("t").alias("lst"), ra.alias("ra"), dec.alias("dec"))).alias("__night"))  # one row, of the night's times
    d, p = F.radians("dec"), math.radians(LATITUDE)

    def seen(x: Column) -> Column:
        altitude = F.degrees(F.asin(F.sin(d) * math.sin(p) + F.cos(d) * math.cos(p) * F.cos(F.radians(x["lst"] - F.col("ra")))))
        away = separation(F.col("ra"), F.col("dec"), x["ra"], x["dec"])
        return (altitude > low) & (altitude < high) & (away > moon_from) & (away < moon_to)

    met = target.crossJoin(F.broadcast(night))
    n = F.when(F.col("ra").isNull() | F.col("dec").isNull(), 0).otherwise(F.size(F.filter("__night", seen)))
    return met.withColumn("n_times", n.cast("long")).withColumn("is_visible", F.col("n_times") > 0).drop("__night")


def scheduler_requests(ppc: DataFrame, overhead_minutes: float = 5.0) -> DataFrame:
    """Exposure with overheads, and the words that the scheduler expects."""
    split = F.when(F.col("n_split") > 1, (F.col("n_split") - 1) * 60).otherwise(0)
    return ppc.withColumn("exp", F.col("ppc_exptime") + overhead_minutes * 60 + split).withColumn("arms", arms("ppc_resolution"))


def timeline(schedule: DataFrame) -> DataFrame:
    """Start, stop and shade of each slot; backups are marked."""
    top = schedule.agg(F.max("ppc_priority").alias("__t"))
    out = schedule.crossJoin(top).withColumn("alpha", 1 - F.col("ppc_priority") / F.col("__t")).drop("__t")
    return out.withColumn("obstime_end", F.col("obstime") + F.make_interval(secs=F.lit(SLOT_SECONDS))).withColumn("is_backup", F.contains("ppc_code", F.lit("backup")))


def greedy_schedule(candidates: DataFrame, slots_per_night: int) -> DataFrame:
    """candidates (night, ppc, score): slots go to the best pointings of each
    night that no earlier night had; not equal to the planner with slew and
    delay costs. At most slots * (k - 1) pointings are taken before night k,
    so its choice is among its slots * k best: these are ranked by the cluster,
    and one pass over them, whose number doesn't grow with the pointings but
    with the nights, accepts in order."""
    nights = candidates.select("night").distinct().withColumn("__k", F.row_number().over(Window.orderBy("night")))  # a row per night
    most = slots_per_night * nights.count()
    w = Window.partitionBy("night").orderBy(F.col("score").desc(), "ppc")
    best = candidates.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most)  # a fixed limit, which tasks apply before the shuffle
    ranked = best.join(nights, "night").where(F.col("__n") <= slots_per_night * F.col("__k"))

    def accept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        taken: set = set()
        used: dict = {}
        for rows in batches:
            slots = []
            for night, ppc in zip(rows["__k"], rows["ppc"]):
                free = used.get(night, 0) < slots_per_night and ppc not in taken
                if free:
                    taken.add(ppc)
                    used[night] = used.get(night, 0) + 1
                slots.append(used[night] if free else 0)
            out = rows.assign(slot=slots)
            yield out[out["slot"] > 0].drop(columns=["__k", "__n"])

    schema = StructType([*candidates.schema.fields, StructField("slot", IntegerType())])
    ordered = ranked.select(*candidates.columns, "__k", "__n").repartition(1).sortWithinPartitions("__k", "__n")
    return ordered.mapInPandas(accept, schema)


def observation_rows(slots: DataFrame) -> DataFrame:
    """slots (start_time, ob_code, derived) -> (datetime, ob_code) of those
    that hold an observation of their own."""
    return slots.where("ob_code is not null and not derived").select(F.col("start_time").alias("datetime"), "ob_code")


def upcoming(dates: DataFrame, today: str, column: str = "obs_date") -> DataFrame:
    """Dates of which noon in Hawaii isn't past on the given day's noon."""
    return dates.where(F.col(column) >= F.lit(today).cast("date"))


def schedule_datetimes(entries: DataFrame, year: int) -> DataFrame:
    """entries (date `M/D`, start, stop `H:MM`) of a semester's year -> with
    both as times; null where a part isn't a number."""
    parts = F.split("date", "/")

    def at(c: str) -> Column:
        clock = F.split(c, ":")
        numbers = [F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.get(clock, F.lit(0)), F.get(clock, F.lit(1))]
        return F.try_make_timestamp(F.lit(year), *[x.try_cast("int") for x in numbers], F.lit(0))

    return entries.withColumns({"start_at": at("start"), "stop_at": at("stop")})


#: Dates and hours (HST) to try if no date is scheduled.
SEASON_DATES = ("2026-01-15", "2026-03-15", "2026-05-15", "2026-07-15", "2026-09-15", "2026-11-15")
SEASON_HOURS = (21, 0, 3)


def candidate_times(spark: SparkSession, dates: Iterable[str] | None = None, hours: Iterable[int] = SEASON_HOURS) -> DataFrame:
    """(date, hour, t): UTC of each hour of each local date."""
    given = [(d,) for d in (SEASON_DATES if dates is None else dates)]
    days = spark.createDataFrame(given, "date string").withColumn("hour", F.explode(F.array(*[F.lit(h) for h in hours])))
    return days.withColumn("t", F.to_timestamp("date") + F.make_interval(hours=F.col("hour") + 10))
