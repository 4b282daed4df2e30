"""The nearest within a radius, counts of fibres and arcs of stars, against all pairs."""

import math
import random

from skyplan.operators import angles, auction, spatial
from tests.test_clusters import apart


def test_nearest_in_crowded_and_empty_places(spark):
    """Places crowd in one part and are few elsewhere, some in the same spot:
    the search begins far below the radius and still finds the far ones."""
    rng = random.Random(3)
    places = [(i, 10 + rng.random() * 3, 5 + rng.random() * 3) for i in range(300)] + [(300 + i, rng.random() * 360, rng.uniform(-60, 90)) for i in range(40)]
    places += [(500 + i, *places[0][1:]) for i in range(3)]
    left = [(i, rng.random() * 360, rng.uniform(-60, 90)) for i in range(150)] + [(200 + i, 9 + rng.random() * 5, 4 + rng.random() * 5) for i in range(150)] + [(400, *places[0][1:])]
    right = spark.createDataFrame(places, "r_id long, ra double, dec double")
    assert spatial.first_radius(right, 9.0) < 2
    got = {r.l_id: (r.r_id, round(r.separation, 9)) for r in spatial.nearest_within(spark.createDataFrame(left, "l_id long, ra double, dec double"), right, 9.0).collect()}
    want = {}
    for p in left:
        d, i = min((round(apart(p, q), 9), q[0]) for q in places)
        if d <= 9:
            want[p[0]] = (i, d)
    assert got == want


def test_fibre_counts_without_rows_for_fibres(spark):
    rng = random.Random(4)
    t = spark.createDataFrame([(i, rng.random() * 8, rng.random() * 8) for i in range(80)], "target long, ra double, dec double")
    s = spark.createDataFrame([(i, rng.random() * 8, rng.random() * 8) for i in range(9)], "pointing long, ra double, dec double")
    want = {}
    for r in auction.fibre_pairs(t, s, 3.0, 4.0).collect():
        want.setdefault((r.target, r.pointing), []).append(r.distance)
    found = auction.fibre_counts(t, s, 3.0, 4.0, shorter=8.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate ") <= 2  # cells around the pointings only, no fibres
    got = {(r.target, r.pointing): (r.n_fibres, r.n_beyond, round(r.nearest, 9)) for r in found.collect()}
    assert got == {k: (len(d), sum(x > 8 for x in d), round(min(d), 9)) for k, d in want.items()}


def test_arcs_of_many_stars_are_few(spark):
    rng = random.Random(6)
    ppc = spark.createDataFrame([(1, 30.0, 20.0)], "ppc long, ra double, dec double")
    stars = [(i, 30 + rng.uniform(-0.3, 0.9), 20 + rng.uniform(0.1, 0.9), 5.0) for i in range(400)]
    arcs = angles.star_arcs(ppc, spark.createDataFrame(stars, "star long, ra double, dec double, g_mag double"), half=2.0).collect()
    near = [s for s in stars if 0.70 <= apart((0, 30.0, 20.0), s) <= 0.83]
    assert len(near) > 60 and len(arcs) <= angles.CAMERAS * 181
    assert len(arcs) < angles.CAMERAS * len(near)

    def bearing(s):
        a, b, d = math.radians(20.0), math.radians(s[2]), math.radians(s[1] - 30.0)
        return math.degrees(math.atan2(math.sin(d) * math.cos(b), math.cos(a) * math.sin(b) - math.sin(a) * math.cos(b) * math.cos(d)))

    every = [(99 + bearing(s) + 60 * c - 2.0) % 360 for s in near for c in range(6)]
    for k in range(3600):
        a = k / 10 + 0.0123
        assert any((a - r.start) % 360 <= r.length for r in arcs) == any((a - x) % 360 <= 4.0 for x in every)
