"""Free position angles against a dense search."""

import math
import random

from pyspark.sql import functions as F

from skyplan.functions import geometry
from skyplan.operators import angles, pointing, schedule


def signed(x):
    return (x + 180) % 360 - 180


def crosses(track, pa, edge=170.0):
    inr = [signed(p - pa) for p in track]
    return any((a >= edge and b <= -edge) or (a <= -edge and b >= edge) for a, b in zip(inr, inr[1:]))


def covered(arcs, pa):
    return any((pa - s) % 360 <= n for s, n in arcs)


def by(rows):
    out = {}
    for r in rows:
        out.setdefault(r.ppc, []).append((r.start, r[2]))
    return out


def test_wrap_arcs_as_dense_search(spark):
    rng, tracks = random.Random(2), {}
    for k in range(30):
        at, step = rng.uniform(-180, 180), rng.choice([0.5, 3, 8, 10, 13, 19.5, 25]) * rng.choice([1, -1])
        tracks[k] = [signed(at + step * i + rng.uniform(-1, 1)) for i in range(rng.choice([1, 2, 9]))]
    samples = spark.createDataFrame([(k, i, p) for k, t in tracks.items() for i, p in enumerate(t)], "ppc int, t int, parallactic double")
    arcs = angles.wrap_arcs(samples).cache()
    found, free = by(arcs.collect()), by(angles.free_angles(samples.select("ppc"), arcs).collect())
    for k, track in tracks.items():
        for i in range(1800):
            pa = -90 + 0.2 * i + 0.0123
            assert covered(found.get(k, []), pa) == crosses(track, pa), (k, pa, track)
            assert any(a < x < b for a, b in free.get(k, []) for x in (pa % 360, pa % 360 + 360)) != crosses(track, pa)


def test_stars_as_dense_search(spark):
    rng = random.Random(3)
    at = {1: (10.0, 5.0), 2: (359.9, -20.0), 3: (120.0, 84.0)}
    stars = [(i, (ra + rng.gauss(0, 0.5) / math.cos(math.radians(dec))) % 360, dec + rng.gauss(0, 0.5), rng.uniform(8, 14)) for i, (ra, dec) in enumerate(rng.choices(list(at.values()), k=120))]
    ppc = spark.createDataFrame([(k, *v) for k, v in at.items()], "ppc int, ra double, dec double")
    star = spark.createDataFrame(stars, "star int, ra double, dec double, g_mag double")
    found = by(angles.star_arcs(ppc, star).collect())
    pairs = ppc.select("ppc", F.col("ra").alias("a"), F.col("dec").alias("b")).crossJoin(star.where("g_mag < 12"))
    places = pairs.select("ppc", geometry.separation("a", "b", "ra", "dec").alias("d"), geometry.bearing("a", "b", "ra", "dec").alias("t")).where("d between 0.70 and 0.83").collect()
    assert len({r.ppc for r in places}) == 3
    for k in at:
        for i in range(1800):
            pa = -90 + 0.2 * i + 0.0123
            hit = False
            for r in places:
                if r.ppc == k:
                    t, b = math.radians(pa), math.radians(r.t)  # north and east on the plane, as directions() has them
                    x, y = math.cos(b) * math.sin(t) - math.sin(b) * math.cos(t), math.cos(b) * math.cos(t) + math.sin(b) * math.sin(t)
                    hit = hit or any(abs(signed(math.degrees(math.atan2(y, x)) + 60 * cam + 9)) <= 5 for cam in range(6))
            assert covered(found.get(k, []), pa) == hit, (k, pa)


def test_free_and_candidates(spark):
    ppc = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,)], "ppc int")
    arcs = spark.createDataFrame([(1, 350.0, 30.0), (1, 10.0, 20.0), (1, 100.0, 5.0), (1, 101.0, 1.0), (2, 0.0, 360.0), (3, 0.5, 355.0), (5, 30.0, 360.0)], "ppc int, start double, length double")
    free = angles.free_angles(ppc, arcs).cache()
    cut = angles.CUT
    assert sorted((r.ppc, round(r.start, 9), round(r.stop, 9)) for r in free.collect()) == [(1, 30.0, 100.0), (1, 105.0, 350.0), (3, 355.5, 360.5), (4, cut, cut + 360)]
    got = {}
    own = spark.createDataFrame([(1, 33.0), (3, 12.0), (4, None), (1, 101.5)], "ppc int, pa double")
    for r in angles.candidates(free, initial=own).collect():
        got.setdefault(r.ppc, []).append(r.pa)
    assert got[3] == [0.0] and sorted(got[4]) == [-80.0 + 10 * k for k in range(36)]
    narrow = angles.candidates(spark.createDataFrame([(1, 31.0, 37.0)], "ppc int, start double, stop double")).collect()
    assert [r.pa for r in narrow] == [34.0]
    assert 33.0 in got[1] and 101.5 not in got[1] and set(got) == {1, 3, 4} and 30.0 not in got[1] and 40.0 in got[1]
    assert angles.free_angles(ppc.limit(0), arcs.limit(0)).count() == 0


def test_missing_samples_forbid_all(spark):
    samples = spark.createDataFrame([(1, 0, 5.0), (1, 1, None), (2, 0, 1.0), (2, 1, 2.0)], "ppc int, t int, parallactic double")
    free = angles.free_angles(samples.select("ppc"), angles.wrap_arcs(samples)).collect()
    assert {r.ppc for r in free} == {2}


def test_whole_choice(spark):
    """Constraints, candidates and the best angle of a night, as by trying
    each angle with the samples themselves."""
    ppc = spark.createDataFrame([(k, 37.0 * k % 360, -25 + 9.0 * k) for k in range(12)], "ppc int, ra double, dec double")
    night = spark.sql("SELECT explode(sequence(TIMESTAMP '2024-03-01 05:00:00', TIMESTAMP '2024-03-01 15:00:00', INTERVAL 20 MINUTES)) AS t")
    samples = ppc.crossJoin(night).withColumn("parallactic", geometry.parallactic("ra", "dec", "t"))
    found = angles.candidates(angles.free_angles(ppc, angles.wrap_arcs(samples)))
    tried = ppc.crossJoin(spark.createDataFrame([(a,) for a in pointing.angle_candidates()], "pa double")).crossJoin(night)
    tried = tried.withColumn("key", F.concat_ws("|", "ppc", "pa")).withColumn("inr", geometry.rotator_angle("ra", "dec", "pa", "t"))
    ok = {r.key for r in schedule.rotator_jumps(tried, "key").where("continuous").collect()}
    grid = {a if a > -90 else 270.0 for a in pointing.angle_candidates()}
    got = {f"{r.ppc}|{r.pa if r.pa < 270 else -90.0}" for r in found.collect() if r.pa in grid}
    assert got == ok


def test_pointings_without_an_angle_meet_no_more_stars(spark, monkeypatch):
    """Parts of the stars leave what all of them leave, and a pointing that has
    no angle left doesn't meet the next part."""
    rng = random.Random(7)
    stars = [(k, 100 + rng.uniform(-1, 1), 10 + rng.uniform(-1, 1), 9.0) for k in range(4000)] + [(5000 + k, 200 + 0.1 * k, 20.75, 9.0) for k in range(3)]
    star = spark.createDataFrame(stars, "star long, ra double, dec double, g_mag double")
    ppc = spark.createDataFrame([(k, 99.9 + 0.05 * k, 10.0) for k in range(5)] + [(9, 200.0, 20.0)], "ppc long, ra double, dec double")
    arcs = spark.createDataFrame([(9, 300.0, 7.0)], "ppc long, start double, length double")
    met = []
    monkeypatch.setattr(angles, "PARTS", 64)
    monkeypatch.setattr(angles, "RING_STARS", 0.001)
    monkeypatch.setattr(angles, "star_arcs", lambda p, *x, real=angles.star_arcs: met.append(sorted(r.ppc for r in p.collect())) or real(p, *x))
    got = sorted(tuple(r) for r in angles.open_angles(ppc, arcs, star).collect())
    assert met[0] == [0, 1, 2, 3, 4, 9] and met[-1] == [9] and len(met) > 1
    whole = sorted(tuple(r) for r in angles.free_angles(ppc, arcs.unionByName(angles.star_arcs(ppc, star))).collect())
    assert {r[0] for r in got} == {9} and len(got) == len(whole)
    assert all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-9 and abs(a[2] - b[2]) < 1e-9 for a, b in zip(got, whole))
