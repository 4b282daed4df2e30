"""Aggregates beside rows, with one key that holds nine tenths of them."""

import math
import random

from pyspark.sql import functions as F

from skyplan.operators import design, keyed, targets, weights


def test_values_as_by_hand(spark):
    rows = [(None if i % 7 == 0 else "hot" if i % 10 else f"k{i}", i % 3 or None, float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, m int, x double")
    want = {}
    for k, m, x in rows:
        want.setdefault((k, m), []).append(x)
    got = keyed.with_aggregates(df, ["k", "m"], n=F.count("*"), total=F.sum("x")).collect()
    assert len(got) == 400 and all((r.n, r.total) == (len(want[r.k, r.m]), sum(want[r.k, r.m])) for r in got)
    assert targets.all_duplicates(df, ["k", "m"]).count() == sum(len(v) for v in want.values() if len(v) > 1)


def test_no_window_over_a_key(spark):
    """The plans sort no key's rows in one task."""
    df = spark.createDataFrame([("p", "L", 1.0, 10.0, 1, 1, 2.0, 3.0)], "proposal_id string, resolution string, exptime_done double, allocated_time_tac double, design_id int, fiber_id int, ra double, dec double")
    for made in (targets.with_allocation(df), targets.all_duplicates(df, ["design_id"]), design.duplicate_fibers(df), weights.local_density(df)):
        assert "Window" not in made._jdf.queryExecution().toString()


def test_ranks(spark):
    rng = random.Random(4)
    ranks = [rng.choice([None, *range(-5, 40)]) for _ in range(300)]
    df = spark.createDataFrame([(i, None if r is None else r / 4, i % 10) for i, r in enumerate(ranks)], "id int, rank double, priority int")
    order = sorted({r / 4 for r in ranks if r is not None})
    for r in weights.rank_weight(df).collect():
        if r.rank is not None:
            at = order.index(r.rank)
            p = order[at - 1] if at else 0.0
            assert abs(r.rank_fin - math.exp(0.55 * r.rank + 0.45 * p + (9 - r.priority) * 0.05 * (r.rank - p))) < 1e-9
