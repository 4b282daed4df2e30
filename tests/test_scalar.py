"""Expressions against hand-computed literals, with nulls, NaN and ties."""

import math

import pytest
from pyspark.sql import functions as F

from skyplan.functions import geometry as G
from skyplan.functions import scalar as X

NAN = float("nan")


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_missing_numbers(spark):
    got = values(spark, [(NAN,), (None,), (0.0,), (-1.0,), (1000.0,)], "f double", X.known("f"), X.filled("f", 7.0), X.magnitude("f"))
    assert [g[0] for g in got] == [None, None, 0.0, -1.0, 1000.0]
    assert [g[1] for g in got] == [7.0, 7.0, 0.0, -1.0, 1000.0]
    assert [g[2] for g in got][:4] == [None] * 4 and got[4][2] == pytest.approx(23.9)


def test_missing_text(spark):
    got = values(spark, [("nan",), ("None",), ("--",), ("[]",), ("0.0",), (" ",), (None,), ("g2",)], "t string", X.text_or_null("t"))
    assert [g[0] for g in got] == [None] * 7 + ["g2"]


def test_given(spark):
    got = values(spark, [("1.5",), ("nan",), ("inf",), ("x",), (None,)], "t string", X.is_given("t"))
    assert [g[0] for g in got] == [True, False, False, False, False]


@pytest.mark.parametrize(("x", "pa", "signed"), [(0.0, 0.0, 0.0), (270.0, 270.0, -90.0), (271.0, -89.0, -89.0), (-90.0, 270.0, -90.0), (180.0, 180.0, -180.0), (725.0, 5.0, 5.0)])
def test_wraps(spark, x, pa, signed):
    assert values(spark, [(x,)], "x double", X.wrap_pa("x"), X.wrap_signed("x")) == [(pa, signed)]


def test_divide_and_ceil(spark):
    assert values(spark, [(1.0, 0.0), (1.0, 4.0), (1.0, -1.0)], "a double, b double", X.safe_divide("a", "b")) == [(0.0,), (0.25,), (0.0,)]
    assert values(spark, [(900.0,), (900.5,), (0.0,)], "a double", X.ceil_to("a", 900.0)) == [(900.0,), (1800.0,), (0.0,)]


def test_coordinates_as_text(spark):
    got = values(spark, [(0.0, -0.5), (359.9999999, 89.9999999), (187.5, -12.25)], "ra double, dec double", X.ra_text("ra"), X.dec_text("dec"), X.ra_text("ra", ":"))
    assert got == [("000000.000", "-003000.00", "00:00:00.000"), ("000000.000", "+900000.00", "00:00:00.000"), ("123000.000", "-121500.00", "12:30:00.000")]


def test_times(spark):
    rows = [("2025-01-01 20:00:00",), ("2025-01-01T20:00",), ("nan",), ("2025-13-01 00:00:00",), (None,)]
    got = values(spark, rows, "t string", F.date_format(X.parse_hst("t"), "yyyy-MM-dd HH:mm"), X.is_date("t"))
    assert got == [("2025-01-02 06:00", True), ("2025-01-02 06:00", True), (None, False), (None, False), (None, False)]
    nights = values(spark, [("2025-01-02 06:00:00",), ("2025-01-02 21:59:00",), ("2025-01-02 22:01:00",)], "t string", X.night_of(F.to_timestamp("t")).cast("string"))
    assert nights == [("2025-01-01",), ("2025-01-01",), ("2025-01-02",)]


def test_pairs_and_ids(spark):
    assert values(spark, [("3 (1)",), ("12",), ("",), (None,)], "t string", X.count_pair("t"))[:3] == [([3, 1],), ([12, 0],), ([0, 0],)]
    name = values(spark, [("design-0x00000000000f4243.fits",), ("a.ff.b",)], "t string", X.design_of_name("t"))
    assert name == [(1000003,), (255,)]
    assert values(spark, [(255,)], "i long", X.design_hex("i")) == [("0x00000000000000ff",)]
    assert values(spark, [("J2000.0",), ("2016",), ("x",)], "t string", X.epoch_number("t")) == [(2000.0,), (2016.0,), (None,)]


def test_flux_of_filter(spark):
    rows = [(["none", "g"], [1.0, 2.0], [3.0, 4.0]), (["g", "r"], [NAN, 2.0], [3.0, 4.0]), (["r"], [1.0], [3.0]), ([], [], [])]
    got = values(spark, rows, "n array<string>, t array<double>, p array<double>", X.flux_of("n", "t", F.lit("g"), "p"), X.first_filter("n"))
    assert got == [(2.0, "g"), (3.0, "g"), (None, "r"), (None, None)]


def test_separation(spark):
    rows = [(0.0, 0.0, 90.0, 0.0), (359.9, 0.0, 0.1, 0.0), (10.0, 90.0, 200.0, 90.0), (0.0, -90.0, 0.0, 90.0), (5.0, 5.0, 5.0, 5.0)]
    got = [g[0] for g in values(spark, rows, "a double, b double, c double, d double", G.separation("a", "b", "c", "d"))]
    assert got == pytest.approx([90.0, 0.2, 0.0, 180.0, 0.0], abs=1e-9)


def test_altitude_and_rotator(spark):
    t = F.to_timestamp(F.lit("2024-03-20 10:00:00"))
    lst = values(spark, [(1,)], "x int", G.sidereal(t))[0][0]
    got = values(spark, [(lst, G.LATITUDE), (lst, 0.0), ((lst + 180) % 360, 0.0)], "ra double, dec double", G.altitude("ra", "dec", t), G.azimuth("ra", "dec", t), G.rotator_angle("ra", "dec", F.lit(0.0), t))
    assert got[0][0] == pytest.approx(90.0, abs=1e-5)
    assert got[1][0] == pytest.approx(90 - G.LATITUDE, abs=1e-6) and got[1][1] == pytest.approx(180.0, abs=1e-6)
    assert got[2][0] < 0 and abs(got[1][2]) == pytest.approx(0.0, abs=1e-6)


def test_focal_plane(spark):
    points = G.sector_points()
    assert len(points) == 20 and points[0] == (0, 0.0, 0.0)
    assert all(math.hypot(x, y) == pytest.approx(100 if 0 < i < 7 else 175) for i, x, y in points if i)
    assert values(spark, [(200.0, 1.0), (1.0, 200.0), (-1.0, -0.5)], "x double, y double", G.wedge("x", "y")) == [(6,), (7,), (3,)]
    reach = values(spark, [(0.0,), (5.0,), (11.0,)], "x double", G.beyond_patrol(F.col("x"), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(6.0), F.lit(4.0)))
    assert reach == [(-1,), (0,), (1,)]
