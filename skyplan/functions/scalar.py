"""Scalar expressions. NaN counts as missing, so inputs pass through `known`
before any comparison (Spark holds NaN to be the greatest number)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HST = "Pacific/Honolulu"
SLOT_SECONDS = 1260
MISSING_TEXT = ("", "nan", "none", "--", "[]", "0.0")
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def known(c: Column | str) -> Column:
    """NaN becomes NULL."""
    return F.when(~F.isnan(col(c)), col(c))


def filled(c: Column | str, value: float = 0.0) -> Column:
    return F.coalesce(known(c), F.lit(value))


def text_or_null(c: Column | str) -> Column:
    """The sentinels for missing text become NULL."""
    return F.when(~F.lower(F.trim(col(c))).isin(*MISSING_TEXT), col(c))


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """0 where the denominator is not above 0."""
    return F.when(col(b) > 0, col(a) / col(b)).otherwise(F.lit(0.0))


def magnitude(flux: Column | str) -> Column:
    """AB magnitude of nJy; NULL unless the flux is above 0."""
    f = known(flux)
    return F.when(f > 0, 23.9 - 2.5 * F.log10(f / 1e3))


def ab_magnitude(flux: Column | str) -> Column:
    f = known(flux)
    return F.when(f > 0, -2.5 * F.log10(f * 1e-9 / 3631))


def wrap_pa(pa: Column | str) -> Column:
    """Position angle in (-90, 270]."""
    x = F.pmod(col(pa), F.lit(360.0))
    return F.when(x > 270, x - 360).otherwise(x)


def wrap_signed(x: Column | str) -> Column:
    """Angle in [-180, 180)."""
    return F.pmod(col(x) + 180, F.lit(360.0)) - 180


def is_given(c: Column | str) -> Column:
    """Castable to a finite number."""
    x = F.expr(f"try_cast(`{c}` AS double)") if isinstance(c, str) else c.try_cast("double")
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), F.lit(False))


def combined_weight(rank_fin: Column, exptime_ppp: Column, single: float, local_count: Column, a: float = 2.0, b: float = 0.0, c: float = 0.0) -> Column:
    w = F.pow(rank_fin, F.lit(a)) * F.pow(exptime_ppp / single, F.lit(b)) * F.pow(local_count.cast("double"), F.lit(c))
    return F.coalesce(F.nanvl(w, F.lit(0.0)), F.lit(0.0))


def ceil_to(x: Column | str, step: float) -> Column:
    return F.ceil(col(x) / step).cast("double") * step


def identify_code(proposal_id: Column | str, ob_code: Column | str) -> Column:
    """Proposal and code joined; the code alone without a proposal."""
    return F.concat_ws("_", col(proposal_id), col(ob_code))


def epoch_number(epoch: Column | str) -> Column:
    return F.regexp_replace(col(epoch), "^J+", "").try_cast("double")


def design_hex(design_id: Column | str) -> Column:
    return F.format_string("0x%016x", col(design_id))


def design_of_name(name: Column | str) -> Column:
    """Design id in a file name: the second part between dashes and dots."""
    part = F.element_at(F.split(col(name), "[-.]"), 2)
    return F.conv(F.regexp_replace(part, "^0x", ""), 16, 10).cast("long")


def count_pair(text: Column | str) -> Column:
    """'3 (1)' -> [3, 1]; the second is 0 if absent."""
    found = F.transform(F.regexp_extract_all(col(text), F.lit("(-?\\d+)"), 1), lambda x: x.cast("int"))
    return F.array(F.coalesce(F.get(found, F.lit(0)), F.lit(0)), F.coalesce(F.get(found, F.lit(1)), F.lit(0)))


def _sexagesimal(units: Column, per: int) -> list[Column]:
    whole = F.floor(units / per)
    return [F.floor(whole / 3600), F.pmod(F.floor(whole / 60), F.lit(60)), F.pmod(whole, F.lit(60)), F.pmod(units, F.lit(per))]


def ra_text(ra: Column | str, sep: str = "") -> Column:
    """HH MM SS.sss; rounded before it is cut, so seconds stay below 60."""
    units = F.pmod(F.round(F.pmod(col(ra), F.lit(360.0)) / 15 * 3600 * 1000).cast("long"), F.lit(86_400_000))
    h, m, s, f = _sexagesimal(units, 1000)
    return F.format_string(f"%02d{sep}%02d{sep}%02d.%03d", h, m, s, f)


def dec_text(dec: Column | str, sep: str = "") -> Column:
    """+DD MM SS.ss"""
    units = F.round(F.abs(col(dec)) * 3600 * 100).cast("long")
    d, m, s, f = _sexagesimal(units, 100)
    return F.concat(F.when(col(dec) < 0, "-").otherwise("+"), F.format_string(f"%02d{sep}%02d{sep}%02d.%02d", d, m, s, f))


def parse_hst(text: Column | str) -> Column:
    """UTC time of Hawaiian time in one of four formats; NULL if in none."""
    t = F.coalesce(*[F.try_to_timestamp(col(text), F.lit(f)) for f in TIME_FORMATS])
    return F.to_utc_timestamp(t, HST)


def is_date(text: Column | str) -> Column:
    return F.try_to_timestamp(F.substring(col(text), 1, 10), F.lit("yyyy-MM-dd")).isNotNull()


def night_of(utc: Column | str) -> Column:
    """Date of the evening of the night: before noon belongs to the day before."""
    return F.to_date(col(utc) - F.expr("INTERVAL 10 HOURS") - F.expr("INTERVAL 12 HOURS"))


def hst_date(utc: Column | str) -> Column:
    """The date in Hawaii of a night that is one date in UTC."""
    return F.date_sub(F.to_date(col(utc)), 1)


def roll_midnight(t: Column | str) -> Column:
    """Hours before noon belong to the next date."""
    return F.when(F.hour(col(t)) < 12, col(t) + F.expr("INTERVAL 1 DAY")).otherwise(col(t))


def flux_of(names: Column | str, flux: Column | str, band: Column | str, fallback: Column | str | None = None) -> Column:
    """The flux at the band's place among the names; the fallback's if it is
    missing there."""

    def at(values: Column) -> Column:
        place = F.array_position(col(names), col(band))
        return F.when(place > 0, known(F.try_element_at(values, place.cast("int"))))

    return at(col(flux)) if fallback is None else F.coalesce(at(col(flux)), at(col(fallback)))


def first_filter(names: Column | str) -> Column:
    return F.try_element_at(F.filter(col(names), lambda x: ~F.lower(x).isin("none", "nan")), F.lit(1))


def arms(resolution: Column | str) -> Column:
    return F.when(col(resolution) == "L", "brn").when(col(resolution) == "M", "bmn")


def resolution_word(resolution: Column | str) -> Column:
    return F.when(col(resolution) == "L", "low").when(col(resolution) == "M", "medium")
