"""Position angles of pointings by the intervals that are forbidden to them.

Trying every angle would test each of them against every sample of the night
and every bright star. Instead each pair of samples, and each star with each
camera, forbids one arc of angles, in closed form; the arcs of a pointing are
united by a sweep in the order of their starts, and what is left is free.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import bearing
from ..functions.scalar import wrap_pa, wrap_signed
from .lineage import cut_lineage
from .pointing import angle_candidates
from .schedule import WRAP_EDGE
from .spatial import cone_pairs

#: Degrees from the pointing within which cameras lie, degrees on either side
#: of a camera's middle, and the magnitude below which a star is too bright.
CAMERA_RING, CAMERA_HALF, BRIGHT = (0.70, 0.83), 5.0, 12.0
CAMERAS = 6
#: Where the circle is cut open for the sweep: no angle that anybody asks for.
CUT = 4.987654321
#: Parts that stars are dealt to, and how many stars a ring holds on the mean
#: where they are looked for first.
PARTS, RING_STARS = 1 << 16, 16


def _from_cut(angle: Column) -> Column:
    return CUT + F.pmod(angle - CUT, F.lit(360.0))


def _arc(start: Column, length: Column) -> list[Column]:
    return [F.pmod(start, F.lit(360.0)).alias("start"), length.alias("length")]


def wrap_arcs(samples: DataFrame, key: str = "ppc", order: str = "t", angle: str = "parallactic", edge: float = WRAP_EDGE) -> DataFrame:
    """samples (ppc, t, parallactic) -> (ppc, start, length): angles under
    which the rotator passes its end between a sample and the next, from one
    side within 180 - edge degrees of it to the other. With d the step of the
    parallactic angle, that is where both samples lie so near to the end: an
    arc of less than twice that width. A sample without an angle forbids all."""
    near = 180.0 - edge
    later = F.lead(angle).over(Window.partitionBy(key).orderBy(order))
    x = samples.select(key, F.col(angle).alias("a"), later.alias("b"), F.lead(order).over(Window.partitionBy(key).orderBy(order)).isNotNull().alias("followed"))
    d = wrap_signed(F.col("b") - F.col("a"))
    up = F.when((d > 0) & (d < 2 * near), F.struct((F.col("a") - 180 + F.greatest(F.lit(0.0), d - near)).alias("s"), (F.least(d, F.lit(near)) - F.greatest(F.lit(0.0), d - near)).alias("n")))
    down = F.when((d < 0) & (d > -2 * near), F.struct((F.col("a") - 180 + F.greatest(-F.lit(near), d)).alias("s"), (F.least(F.lit(0.0), d + near) - F.greatest(-F.lit(near), d)).alias("n")))
    bad = F.col("a").isNull() | F.isnan("a")
    met = x.select(key, bad.alias("bad"), F.when(F.col("followed"), F.coalesce(up, down)).alias("arc"))
    steps = met.where("not bad and arc is not null").select(key, *_arc(F.col("arc.s"), F.col("arc.n")))
    return steps.unionByName(met.where("bad").select(key, F.lit(0.0).alias("start"), F.lit(360.0).alias("length")).distinct())


def star_arcs(ppc: DataFrame, stars: DataFrame, ring: tuple[float, float] = CAMERA_RING, half: float = CAMERA_HALF, bright: float = BRIGHT) -> DataFrame:
    """ppc (ppc, ra, dec), stars (star, ra, dec, g_mag) -> (ppc, start,
    length): angles under which a bright star falls on a camera. A camera is a
    piece of the ring around the pointing, 2 * half degrees wide. Arcs that
    overlap are joined in ranges of half degrees, so a pointing has as many as
    the circle has room for, whatever the number of stars."""
    left = stars.where(F.col("g_mag") < bright).select(F.col("star").alias("l_id"), "ra", "dec")
    met = cone_pairs(left, ppc.select(F.col("ppc").alias("r_id"), "ra", "dec"), ring[1]).where(F.col("separation") >= ring[0])
    # arcs of a length whose starts lie less than that apart are one arc: of each such range the first and the last star count
    at = met.select(F.col("r_id").alias("ppc"), bearing("r_ra", "r_dec", "ra", "dec").alias("b")).withColumn("range", F.floor(F.col("b") / half))
    at = at.groupBy("ppc", "range").agg(F.min("b").alias("b"), F.max("b").alias("last")).withColumn("cam", F.explode(F.array(*[F.lit(k) for k in range(CAMERAS)])))
    # on the focal plane a star stands at 90 + bearing - angle, a camera at -60 cam - 9
    middle = 90 + F.col("b") + 60 * F.col("cam") + 9
    return at.select("ppc", *_arc(middle - half, F.col("last") - F.col("b") + 2.0 * half))


def free_angles(ppc: DataFrame, arcs: DataFrame) -> DataFrame:
    """ppc (ppc), arcs (ppc, start, length) -> (ppc, start, stop): what no arc
    covers, as intervals from CUT to CUT + 360. An arc over the cut is parted,
    and a sweep in the order of starts keeps the furthest stop so far."""
    return _gaps(ppc, _parted(arcs))


def _parted(arcs: DataFrame) -> DataFrame:
    """arcs (ppc, start, length) -> (ppc, start, stop) from the cut."""
    start, end = _from_cut(F.col("start")), F.lit(CUT + 360)
    stop = start + F.col("length")
    parts = F.array(F.struct(start.alias("start"), F.least(stop, end).alias("stop")), F.struct(F.lit(CUT).alias("start"), (stop - 360).alias("stop")))
    return arcs.select("ppc", F.explode(F.filter(parts, lambda x: x["stop"] > x["start"])).alias("x")).select("ppc", "x.*")


def _gaps(ppc: DataFrame, each: DataFrame) -> DataFrame:
    """each (ppc, start, stop) -> (ppc, start, stop): what they don't cover."""
    end = F.lit(CUT + 360)
    each = each.unionByName(ppc.select("ppc", end.alias("start"), end.alias("stop")).distinct())
    before = Window.partitionBy("ppc").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    swept = each.withColumn("low", F.coalesce(F.max("stop").over(before), F.lit(CUT)))
    return swept.where("start > low").select("ppc", F.col("low").alias("start"), F.col("start").alias("stop"))


def open_angles(ppc: DataFrame, arcs: DataFrame, stars: DataFrame, *shape: float) -> DataFrame:
    """free_angles() of the arcs and of the star_arcs(ppc, stars, *shape): ppc
    (ppc, ra, dec). A pointing that some of its stars leave no angle has none
    with the others either, and pairs of stars and pointings grow with both
    tables. So each star is in one part, drawn by a hash, the first so small
    that a ring holds few, the next eight times as large, and only pointings
    that have an angle left meet the next part; those meet all parts."""
    spark = stars.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bright = stars.where(F.col("g_mag") < (shape[2] if len(shape) > 2 else BRIGHT))
    stars = cut_lineage(bright.where("ra is not null and dec is not null").select("star", "ra", "dec", "g_mag", F.pmod(F.xxhash64("star"), F.lit(PARTS)).alias("part")))
    stars, held = stars.repartition(n, "star"), stars.count()  # few bytes, in few files, of many pairs
    ring = shape[0] if shape else CAMERA_RING
    share = (math.cos(math.radians(ring[0])) - math.cos(math.radians(ring[1]))) / 2
    size = min(PARTS, max(1, int(PARTS * RING_STARS / max(1.0, held * share))))
    begin, free = 0, cut_lineage(free_angles(ppc, arcs))
    while True:
        end = min(PARTS, begin + size)
        some = stars.where((F.col("part") >= begin) & (F.col("part") < end)).drop("part")
        left = cut_lineage(ppc.join(free.select("ppc").distinct(), "ppc", "left_semi"))
        # what was forbidden so far lies between the intervals that are free
        free = _gaps(left, _gaps(left, free).unionByName(_parted(star_arcs(left, some, *shape))))
        if end >= PARTS:
            return free
        free, begin, size = cut_lineage(free), end, 8 * size


def candidates(free: DataFrame, step: float = 10.0, initial: DataFrame | None = None) -> DataFrame:
    """(ppc, pa) in (-90, 270]: the angles of the grid that are free, the
    initial one (ppc, pa) if it is, and the middle of every free interval that
    has none of the grid, so that a pointing with any free angle has one."""
    grid = F.array(*[_from_cut(F.lit(a)) for a in angle_candidates(step=step)])
    inside = F.filter(grid, lambda a: (a > F.col("start")) & (a < F.col("stop")))
    found = free.select("ppc", F.explode(F.when(F.size(inside) > 0, inside).otherwise(F.array((F.col("start") + F.col("stop")) / 2))).alias("a"))
    if initial is not None:
        own = initial.where("pa is not null").select("ppc", _from_cut(F.col("pa")).alias("a"))
        found = found.unionByName(own.join(free, "ppc").where("a > start and a < stop").select("ppc", "a"))
    return found.select("ppc", F.round(wrap_pa("a"), 9).alias("pa")).distinct()
