"""Many pointings a round against the serial planner and all pairs of peaks."""

import math
import random

from pyspark.sql import functions as F

from skyplan.operators import pointing, rounds
from skyplan.operators.rounds import independent_peaks
from skyplan.operators.spatial import middle_of_peak

SCHEMA = "identify_code string, proposal_id string, ra double, dec double, weight double, rank double, priority int, exptime double, exptime_done double, exptime_PPP double, allocated_time double"


def patches(centres, n=12, seconds=900.0):
    out = []
    for k, (ra, dec) in enumerate(centres):
        out += [(f"t{k}_{i:02}", f"p{k}", (ra + 0.07 * (i % 4)) % 360, dec + 0.07 * (i // 4), 1.0 + k + i / 100, 5.0, 1, seconds, 0.0, seconds, 10.0) for i in range(n)]
    return out


def test_as_serial_where_fields_are_apart(spark):
    """One round for five patches, the same fields and targets as in five
    serial rounds."""
    target = spark.createDataFrame(patches([(20, 0), (60, 10), (359.9, -20), (200, 45), (300, 5)]), SCHEMA)
    serial = pointing.plan_pointings(target, 5).collect()
    found = rounds.plan_in_rounds(target, 50).collect()
    key = lambda rows: {tuple(r.ppc_allocated_targets): (round(r.ra, 6), round(r.dec, 6)) for r in rows if r.ppc_allocated_targets}
    # a patch over the wrap has two peaks on the serial planner's flat map, so only its targets are compared
    a, b = key(serial), key(found)
    assert {x for t in b for x in t} == {r[0] for r in patches([(0, 0)] * 5)}
    for t, at in a.items():
        if not any(x.startswith("t2_") for x in t):
            assert b[t] == at
    assert {r.round for r in found} <= {0, 1} and [r.pointing for r in sorted(found, key=lambda r: r.pointing)] == list(range(len(found)))


def test_fields_over_each_other(spark):
    """More targets than fibres, and several exposures: rounds follow these,
    and no target gets more exposures than it needs."""
    target = spark.createDataFrame(patches([(20, 0), (60, 10)], n=12, seconds=1800.0), SCHEMA)
    found = rounds.plan_in_rounds(target, 50, fibers=6).collect()
    times = {}
    for r in found:
        assert len(r.ppc_allocated_targets) <= 6
        for x in r.ppc_allocated_targets:
            times[x] = times.get(x, 0) + 1
    assert len(times) == 24 and set(times.values()) == {2} and max(r.round for r in found) + 1 <= 6
    assert len(rounds.plan_in_rounds(target, 1, fibers=6).collect()) == 1
    assert rounds.plan_in_rounds(target.limit(0), 3).count() == 0


def test_peaks_are_independent(spark):
    rng, wide = random.Random(8), 4.0
    cells = [(rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1))), rng.choice([1.0, 2.0, 3.0]) + rng.random()) for _ in range(3000)]
    got = [tuple(r) for r in rounds.independent_peaks(spark.createDataFrame(cells, "ra double, dec double, density double"), wide).collect()]

    def apart(p, q):
        a, b, d = math.radians(p[1]), math.radians(q[1]), math.radians(q[0] - p[0])
        return math.degrees(math.acos(max(-1.0, min(1.0, math.sin(a) * math.sin(b) + math.cos(a) * math.cos(b) * math.cos(d)))))

    assert max(cells, key=lambda c: c[2]) in got and len(got) > 50
    assert all(apart(p, q) > wide for i, p in enumerate(got) for q in got[:i])


def test_peak_of_sums_that_vary(spark):
    """Sums of doubles differ in the last bits from one evaluation to the next;
    the top and the cells that have it must be of one evaluation."""
    jitter = F.udf(lambda: random.random() * 1e-9, "double").asNondeterministic()
    cells = spark.range(60).select((F.col("id") % 10).cast("double").alias("ra"), F.floor(F.col("id") / 10).cast("double").alias("dec"), (F.col("id") + jitter()).alias("z"))
    assert middle_of_peak(cells).first().ra == 9.0
    found = independent_peaks(cells.withColumnRenamed("z", "density"), 30.0).collect()
    assert [(r.ra, r.dec) for r in found] == [(9.0, 5.0)]
