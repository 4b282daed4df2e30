"""Joins and groups on the sky and on the focal plane.

A predicate on a distance alone would compare all pairs. Points are therefore
put in cells: bands of declination as high as the radius, cut in right
ascension by the band's widest circle. One side is copied to the cells around
its own; equal cells meet in a plain equi-join, and the exact distance decides.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import sector_points, separation
from .clusters import sky_clusters
from .lineage import cut_lineage
from .numbering import numbered


def _band(dec: Column, radius: float) -> Column:
    return F.floor(dec / radius)


def _cells_in_band(band: Column, radius: float) -> Column:
    """Cells as wide as a circle around a point can reach in right ascension
    whose points are in the band: such a centre lies at most the radius beyond
    the band's edge. Bands that circles over a pole may reach have one cell."""
    edge = F.greatest(F.abs(band * radius), F.abs((band + 1) * radius)) + radius
    width = F.degrees(F.asin(F.least(F.lit(1.0), F.lit(math.sin(math.radians(min(radius, 90.0)))) / F.cos(F.radians(F.least(edge, F.lit(89.9)))))))
    return F.when(edge + radius < 89.9, F.greatest(F.lit(1), F.floor(360 / width))).otherwise(1).cast("long")


def with_cell(df: DataFrame, radius: float, ra: str = "ra", dec: str = "dec") -> DataFrame:
    n = _cells_in_band(F.col("__b"), radius)
    return df.withColumn("__b", _band(F.col(dec), radius)).withColumn("__c", F.pmod(F.floor(F.col(ra) / 360 * n), n))


def with_cells_around(df: DataFrame, radius: float, ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Each row at its cell and all that a point within the radius may be in;
    nine cells at most but near a pole."""
    bands = F.sequence(_band(F.col(dec) - radius, radius), _band(F.col(dec) + radius, radius))
    out = df.withColumn("__b", F.explode(bands))
    n = _cells_in_band(F.col("__b"), radius)
    c = F.floor(F.col(ra) / 360 * n)
    return out.withColumn("__c", F.explode(F.array_distinct(F.array(F.pmod(c - 1, n), F.pmod(c, n), F.pmod(c + 1, n)))))


def _unit(df: DataFrame, name: str, ra: str, dec: str) -> DataFrame:
    """With the vector of a place, so that a pair's angle is three products."""
    r, d = F.radians(ra), F.radians(dec)
    return df.withColumns({f"{name}x": F.cos(d) * F.cos(r), f"{name}y": F.cos(d) * F.sin(r), f"{name}z": F.sin(d)})


#: More than rounding can shift the cosine of an angle.
_SHIFT = 1e-12


def cone_pairs(left: DataFrame, right: DataFrame, radius: float, parts: int | None = None) -> DataFrame:
    """left (l_id, ra, dec) x right (r_id, ra, dec) within the radius, with
    the separation. Give the smaller side as right: it is the one copied. Most
    pairs of cells are decided by the product of vectors; the separation
    decides where that is as near to the radius as rounding goes. parts: as
    many tasks get the left rows, with their cells, before they meet."""
    r = with_cells_around(_unit(right.select("r_id", F.col("ra").alias("r_ra"), F.col("dec").alias("r_dec")), "__r", "r_ra", "r_dec"), radius, "r_ra", "r_dec")
    l = with_cell(_unit(left, "__l", "ra", "dec"), radius)
    met = (l if parts is None else l.repartition(parts, "l_id")).join(r, ["__b", "__c"])
    along, limit = sum((F.col(f"__l{a}") * F.col(f"__r{a}") for a in "yz"), F.col("__lx") * F.col("__rx")), math.cos(math.radians(min(radius, 180.0)))
    apart = separation("ra", "dec", "r_ra", "r_dec")
    within = (along >= limit + _SHIFT) | ((along >= limit - _SHIFT) & (apart <= radius))
    return met.where(within).withColumn("separation", apart).drop("__b", "__c", *[f"__{side}{a}" for side in "lr" for a in "xyz"])


#: The nearest place is looked for first where a cell of the grid holds so many
#: places, on the mean over places.
PLACES_A_CELL = 2
#: Halvings of the radius that are tried.
HALVINGS = 12


def first_radius(places: DataFrame, radius: float) -> float:
    """The radius, halved until cells hold few places: one job for all sizes."""
    sizes = [radius / (1 << k) for k in range(HALVINGS + 1)]
    at = F.array(*[F.struct(F.lit(k).alias("k"), _band(F.col("dec"), r).alias("b"), F.pmod(F.floor(F.col("ra") / 360 * _cells_in_band(_band(F.col("dec"), r), r)), _cells_in_band(_band(F.col("dec"), r), r)).alias("c")) for k, r in enumerate(sizes)])
    cells = places.select(F.explode(at).alias("x")).groupBy("x.k", "x.b", "x.c").agg(F.count("*").cast("double").alias("n"))
    held = {r.k: r.n for r in cells.groupBy("k").agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("n")).collect()}  # a row per size
    return next((r for k, r in enumerate(sizes) if held.get(k, 0.0) <= PLACES_A_CELL), sizes[-1])


def nearest_within(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """left (l_id, ra, dec, ...), right (r_id, ra, dec) -> (l_id, r_id,
    separation, ...): the nearest within the radius, of equals the least r_id.
    Pairs within the radius grow with both tables, so the search begins with a
    radius that few pairs meet; what is found there has nothing nearer, and
    only the others look on with twice the radius. Rows of the same place are
    one place. Nearly all pairs are met only where places crowd far from
    everything that looks for them."""
    places = cut_lineage(right.where("ra is not null and dec is not null").groupBy("ra", "dec").agg(F.min("r_id").alias("r_id")))
    others = [c for c in left.columns if c not in ("l_id", "ra", "dec")]
    size, parts = first_radius(places, radius), []
    while True:
        met = cone_pairs(left, places, size).groupBy("l_id").agg(F.min(F.struct("separation", "r_id", *others)).alias("m"))
        found = met.select("l_id", "m.r_id", "m.separation", *[F.col("m")[c].alias(c) for c in others])
        if size >= radius:
            return reduce(DataFrame.unionByName, [*parts, found])
        parts.append(cut_lineage(found))
        left = cut_lineage(left.join(parts[-1].select("l_id"), "l_id", "left_anti"))
        size = min(2 * size, radius)


def near_any(target: DataFrame, ppc: DataFrame, radius: float = 2.0) -> DataFrame:
    """Targets within the radius of any pointing."""
    r = with_cells_around(ppc.select(F.col("ra").alias("r_ra"), F.col("dec").alias("r_dec")), radius, "r_ra", "r_dec")
    l = with_cell(target, radius)
    near = separation(l["ra"], l["dec"], r["r_ra"], r["r_dec"]) <= radius
    return l.join(r, (l["__b"] == r["__b"]) & (l["__c"] == r["__c"]) & near, "left_semi").drop("__b", "__c")


def self_pairs(points: DataFrame, radius: float) -> DataFrame:
    """points (id, ra, dec) -> pairs a < b within the radius."""
    found = cone_pairs(points.select(F.col("id").alias("l_id"), "ra", "dec"), points.select(F.col("id").alias("r_id"), "ra", "dec"), radius)
    return found.where("l_id < r_id").select(F.col("l_id").alias("a"), F.col("r_id").alias("b"), "separation")


def connected_groups(points: DataFrame, radius: float) -> DataFrame:
    """points (id, ra, dec) -> (id, group): the least id reachable by steps
    within the radius."""
    return sky_clusters(points, radius)


def clusters_by_weight(points: DataFrame, radius: float = 1.38) -> DataFrame:
    """points (id, ra, dec, rank_fin) -> (id, cluster, order): clusters by
    their summed weight, the heaviest first, ties by the least id."""
    groups = connected_groups(points, radius)
    met = points.join(groups, "id")
    heavy = met.groupBy("group").agg(F.sum("rank_fin").alias("total"))
    return met.join(numbered(heavy, [F.col("total").desc(), F.col("group")], "order"), "group")


def density_peak(points: DataFrame, radius: float = 0.69, step: float = 0.5) -> DataFrame:
    """Linear-kernel density of weighted points on a grid made from the cells
    around them, as z-score; a row per cell with any point near. The sums are
    written: the mean and the spread are of the same ones as the rows."""
    n = int(math.ceil(radius / step))
    near = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-n - 1, n + 2) for j in range(-n - 1, n + 2)])
    at = points.withColumn("__o", F.explode(near))
    at = at.withColumn("gx", F.rint(F.col("ra") / step) + F.col("__o.i")).withColumn("gy", F.rint(F.col("dec") / step) + F.col("__o.j"))
    d = F.hypot(F.col("gx") * step - F.col("ra"), F.col("gy") * step - F.col("dec"))
    mass = cut_lineage(at.where(d < radius).groupBy("gx", "gy").agg(F.sum(F.col("weight") * (1 - d / radius)).alias("density")))
    moments = mass.agg(F.avg("density").alias("__m"), F.stddev_pop("density").alias("__s"))
    z = mass.crossJoin(moments).withColumn("z", F.when(F.col("__s") > 0, (F.col("density") - F.col("__m")) / F.col("__s")).otherwise(0.0))
    return z.select((F.col("gx") * step).alias("ra"), (F.col("gy") * step).alias("dec"), "density", "z")


def middle_of_peak(z: DataFrame) -> DataFrame:
    """The cell with the highest score; of equals the middle one. Scores are
    written first: sums of doubles that are taken twice may differ in the last
    bit, by the order in which rows arrive, and then no cell has the top's."""
    z = cut_lineage(z)
    top = z.agg(F.max("z").alias("__t"))
    tied = z.crossJoin(top).where("z = __t").drop("__t")
    n = numbered(tied, [F.col("ra"), F.col("dec")], "__i").crossJoin(tied.agg(F.count("*").alias("__n")))  # one row
    return n.where(F.col("__i") - 1 == F.least(F.bround(F.col("__n") * 0.5), F.col("__n") - 1)).drop("__i", "__n")


def nearest_sector(fibers: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """The nearest of the fixed sector points, the first of equals: an
    expression over a literal array, no join."""
    points = F.array(*[F.struct(((F.col(x) - px) * (F.col(x) - px) + (F.col(y) - py) * (F.col(y) - py)).alias("d2"), F.lit(i).alias("i")) for i, px, py in sector_points()])
    return fibers.withColumn("sector", F.array_min(points)["i"])


def sector_stats(fibers: DataFrame, design: str = "design_id") -> DataFrame:
    """By design and type: statistics of the counts over sectors that are not
    empty; the least is 0 if fewer than 12 are."""
    counts = fibers.groupBy(design, "target_type", "sector").agg(F.count("*").alias("n"))
    return counts.groupBy(design, "target_type").agg(
        F.avg("n").alias("mean"), F.stddev_pop("n").alias("std"),
        F.when(F.count("*") < 12, F.lit(0)).otherwise(F.min("n")).cast("long").alias("min"), F.max("n").alias("max"), F.sum("n").alias("sum"),
    )

