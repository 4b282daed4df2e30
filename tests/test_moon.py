"""The Moon's place, and what a night sees off it."""

import pytest
from pyspark.sql import functions as F

from skyplan.functions.geometry import altitude, moon, separation
from skyplan.operators import schedule


def test_published_place(spark):
    """The worked example of 1992 April 12, 0h dynamical time: 134.688, 13.768."""
    t = spark.createDataFrame([("1992-04-11 23:59:01",)], "t string").withColumn("t", F.to_timestamp("t"))
    ra, dec = moon("t", None)
    got = t.select(ra.alias("ra"), dec.alias("dec")).first()
    assert got.ra == pytest.approx(134.688, abs=0.35) and got.dec == pytest.approx(13.768, abs=0.25)
    here = t.select(*[c.alias(n) for c, n in zip(moon("t"), ("ra", "dec"))]).first()
    assert 0.1 < ((here.ra - got.ra) ** 2 + (here.dec - got.dec) ** 2) ** 0.5 < 1.1


def test_every_time(spark):
    target = spark.createDataFrame([(k, 7.3 * k % 360, -30 + 0.6 * k % 120) for k in range(200)] + [(900, None, 1.0)], "id int, ra double, dec double")
    times = spark.sql("SELECT explode(sequence(TIMESTAMP '2024-03-20 10:00:00', TIMESTAMP '2024-03-20 16:00:00', INTERVAL 30 MINUTES)) AS t")
    every = target.crossJoin(times)
    for limits in ((0.0, 360.0), (60.0, 360.0), (0.0, 40.0)):
        away = separation("ra", "dec", *moon("t"))
        a = altitude("ra", "dec", "t")
        want = {r.id: r.n for r in every.where((a > 32) & (a < 75) & (away > limits[0]) & (away < limits[1])).groupBy("id").agg(F.count("*").alias("n")).collect()}
        got = schedule.with_visible_times(target, times, 32.0, 75.0, *limits).collect()
        assert {r.id: r.n_times for r in got if r.n_times} == want and all(r.is_visible == (r.id in want) for r in got) and len(got) == 201
    assert schedule.with_visible_times(target, times.limit(0)).where("is_visible").count() == 0
