"""Pairs within wide circles near the poles, where a circle reaches further in
right ascension than its radius over the cosine."""

import random

from pyspark.sql import functions as F

from skyplan.functions.geometry import separation
from skyplan.operators import spatial


def test_every_pair(spark):
    rng = random.Random(17)
    points = [(i, rng.uniform(0, 360), rng.choice([rng.uniform(60, 90), rng.uniform(-90, -60), rng.uniform(-60, 60)])) for i in range(700)] + [(900, 0.0, 90.0), (901, 10.0, -90.0)]
    left = spark.createDataFrame(points, "l_id int, ra double, dec double")
    right = left.where("l_id % 3 = 0").withColumnRenamed("l_id", "r_id")
    every = left.crossJoin(right.select("r_id", F.col("ra").alias("r_ra"), F.col("dec").alias("r_dec"))).withColumn("d", separation("ra", "dec", "r_ra", "r_dec"))
    for radius in (0.69, 2.0, 6.0, 17.0):
        got = sorted((r.l_id, r.r_id) for r in spatial.cone_pairs(left, right, radius).select("l_id", "r_id").collect())
        assert got == sorted((r.l_id, r.r_id) for r in every.where(F.col("d") <= radius).select("l_id", "r_id").collect())
        near = {r.l_id for r in spatial.near_any(left, right.withColumnRenamed("r_id", "id"), radius).collect()}
        assert near == {a for a, _ in got}
