"""Sky and focal-plane geometry, in degrees and millimetres.

Altitude, azimuth and rotator angle use the mean sidereal time and a spherical
sky, without refraction, nutation or aberration: an approximation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import col, wrap_signed

#: Place of the telescope: degrees east, degrees north.
LONGITUDE, LATITUDE = -155.4761, 19.8256
#: Millimetres; phase in degrees and number of points of each ring of sectors.
SECTOR_RINGS = ((100.0, 6, 15 + 90), (175.0, 13, -20 + 90))


def separation(ra1: Column | str, dec1: Column | str, ra2: Column | str, dec2: Column | str) -> Column:
    """Great-circle distance, well conditioned at every angle."""
    a, b, d = F.radians(col(dec1)), F.radians(col(dec2)), F.radians(col(ra2) - col(ra1))
    x = F.cos(b) * F.sin(d)
    y = F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)
    z = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(d)
    return F.degrees(F.atan2(F.sqrt(x * x + y * y), z))


def flat_distance(ra1: Column | str, dec1: Column | str, ra2: Column | str, dec2: Column | str) -> Column:
    """Distance on the plane at the first point."""
    dx = (col(ra2) - col(ra1)) * F.cos(F.radians(col(dec1)))
    return F.hypot(dx, col(dec2) - col(dec1))


def offset(ra: Column | str, dec: Column | str, angle: Column, distance: float) -> tuple[Column, Column]:
    """The point at a distance in a direction (east of north)."""
    d, a, t = F.radians(col(dec)), F.radians(F.lit(distance)), F.radians(angle)
    dec2 = F.asin(F.sin(d) * F.cos(a) + F.cos(d) * F.sin(a) * F.cos(t))
    ra2 = F.radians(col(ra)) + F.atan2(F.sin(t) * F.sin(a) * F.cos(d), F.cos(a) - F.sin(d) * F.sin(dec2))
    return F.pmod(F.degrees(ra2), F.lit(360.0)), F.degrees(dec2)


def julian_date(utc: Column | str) -> Column:
    return F.unix_micros(col(utc).cast("timestamp")) / 86_400e6 + 2440587.5


def sidereal(utc: Column | str, longitude: float = LONGITUDE) -> Column:
    """Local mean sidereal time in degrees."""
    days = julian_date(utc) - 2451545.0
    return F.pmod(280.46061837 + 360.98564736629 * days + longitude, F.lit(360.0))


def altitude(ra: Column | str, dec: Column | str, utc: Column | str, latitude: float = LATITUDE) -> Column:
    h, d, p = F.radians(sidereal(utc) - col(ra)), F.radians(col(dec)), math.radians(latitude)
    return F.degrees(F.asin(F.sin(d) * math.sin(p) + F.cos(d) * math.cos(p) * F.cos(h)))


def azimuth(ra: Column | str, dec: Column | str, utc: Column | str, latitude: float = LATITUDE) -> Column:
    h, d, p = F.radians(sidereal(utc) - col(ra)), F.radians(col(dec)), math.radians(latitude)
    return F.pmod(F.degrees(F.atan2(-F.sin(h) * F.cos(d), F.sin(d) * math.cos(p) - F.cos(d) * math.sin(p) * F.cos(h))), F.lit(360.0))


def parallactic(ra: Column | str, dec: Column | str, utc: Column | str, latitude: float = LATITUDE) -> Column:
    h, d, p = F.radians(sidereal(utc) - col(ra)), F.radians(col(dec)), math.radians(latitude)
    return F.degrees(F.atan2(F.sin(h), math.tan(p) * F.cos(d) - F.sin(d) * F.cos(h)))


def rotator_angle(ra: Column | str, dec: Column | str, pa: Column | str, utc: Column | str, latitude: float = LATITUDE) -> Column:
    """Parallactic angle less the position angle, in [-180, 180)."""
    return wrap_signed(parallactic(ra, dec, utc, latitude) - col(pa))


def bearing(ra1: Column | str, dec1: Column | str, ra2: Column | str, dec2: Column | str) -> Column:
    """The direction of the second point from the first, east of north."""
    a, b, d = F.radians(col(dec1)), F.radians(col(dec2)), F.radians(col(ra2) - col(ra1))
    return F.degrees(F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)))


#: Terms of the Moon's longitude, latitude and parallax (size,
#: phase and degrees a century), of low precision: 0.3, 0.2 and 0.003 degrees.
MOON_LONGITUDE = ((6.29, 135.0, 477198.87), (-1.27, 259.3, -413335.36), (0.66, 235.7, 890534.22), (0.21, 269.9, 954397.74), (-0.19, 357.5, 35999.05), (-0.11, 186.5, 966404.03))
MOON_LATITUDE = ((5.13, 93.3, 483202.02), (0.28, 228.2, 960400.89), (-0.28, 318.3, 6003.15), (-0.17, 217.6, -407332.21))
MOON_PARALLAX = ((0.0518, 135.0, 477198.87), (0.0095, 259.3, -413335.36), (0.0078, 235.7, 890534.22), (0.0028, 269.9, 954397.74))


def moon(utc: Column | str, latitude: float | None = LATITUDE) -> tuple[Column, Column]:
    """Right ascension and declination of the Moon as seen from the place of
    the telescope, or from the Earth's centre if the latitude is None."""
    t = (julian_date(utc) - 2451545.0) / 36525

    def terms(f, table: tuple) -> Column:
        return sum((a * f(F.radians(p + n * t)) for a, p, n in table), F.lit(0.0))

    lon = F.radians(218.32 + 481267.881 * t + terms(F.sin, MOON_LONGITUDE))
    lat = F.radians(terms(F.sin, MOON_LATITUDE))
    x, y, z = F.cos(lat) * F.cos(lon), 0.9175 * F.cos(lat) * F.sin(lon) - 0.3978 * F.sin(lat), 0.3978 * F.cos(lat) * F.sin(lon) + 0.9175 * F.sin(lat)
    if latitude is not None:
        r = 1 / F.sin(F.radians(0.9508 + terms(F.cos, MOON_PARALLAX)))
        here, p = F.radians(sidereal(utc)), math.radians(latitude)
        x, y, z = r * x - math.cos(p) * F.cos(here), r * y - math.cos(p) * F.sin(here), r * z - math.sin(p)
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0)), F.degrees(F.atan2(z, F.hypot(x, y)))


def sector_points() -> list[tuple[int, float, float]]:
    """The centre and the points of each ring: (index, x, y)."""
    points = [(0.0, 0.0)]
    for radius, n, phase in SECTOR_RINGS:
        points += [(radius * math.cos(math.radians(phase + 360 / n * k)), radius * math.sin(math.radians(phase + 360 / n * k))) for k in range(n)]
    return [(i, x, y) for i, (x, y) in enumerate(points)]


def wedge(x: Column | str, y: Column | str) -> Column:
    """Twelve sectors: six wedges of 60 degrees, inside and outside of the
    radius that halves the area."""
    ring = F.when(F.hypot(col(x), col(y)) > 220 / math.sqrt(2), 6).otherwise(0)
    return (F.floor(F.pmod(F.degrees(F.atan2(col(y), col(x))), F.lit(360.0)) / 60) + ring).cast("int")


def beyond_patrol(x: Column, y: Column, cx: Column, cy: Column, l1: Column, l2: Column) -> Column:
    """1 outside the arms' reach, -1 inside their blind spot, else 0."""
    r = F.hypot(x - cx, y - cy)
    return F.when(r > l1 + l2, 1).when(r < F.abs(l1 - l2), -1).otherwise(0)


def directions(pa: Column | str) -> tuple[Column, Column, Column, Column]:
    """Unit vectors to the north and to the east on the focal plane."""
    t = F.radians(col(pa))
    return F.sin(t), F.cos(t), -F.cos(t), F.sin(t)


def camera_label(cam: Column | str, radius: float = 245.0) -> tuple[Column, Column]:
    t = F.radians(-60.0 * col(cam) - 9.0)
    return radius * F.cos(t), radius * F.sin(t)
