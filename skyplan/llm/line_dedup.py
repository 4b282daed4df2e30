"""Line dedup by distinct-site spread (operator 9).

A line (text between LFs, with a character outside space and TAB..CR) that
occurs on min_sites distinct sites or more is boilerplate: it stays where it
first occurs (least id, then position; null ids last) and goes elsewhere, so
no text is lost from the corpus. min_sites is the share `site_share` of the
distinct sites, rounded up, and 2 at least, whatever their number; a caller
may give a number instead. A HyperLogLog sketch of the sites per line, merged
by map-side aggregation, gives an estimate; lines whose estimate is within
`band` of the threshold get an exact distinct count, so the result is that of
exact counts unless a sketch errs by more than the band (over six standard
errors at the default of 2^10 registers).

Lines are named by two 64-bit hashes. Texts are split once: the hashes, site,
id and position of every line are written. A line that occurs too seldom to
be on so many sites can't be boilerplate; a plain count, which needs no sketch,
leaves the rows of the others, and sketches, exact counts and removals read
these alone. Tables of line hashes that meet them are sent to every task if
few, else joined by hash, where a common line, with many rows on one side and
one on the other, can be split. Texts move once, to meet removed positions.

Defined results: a null site is one site of its own; null text stays null
and has no lines; rows that repeat id and text get equal results; an empty
table gives an empty result; other columns pass through untouched. A line
that goes takes its LF along.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, release, sent_if_small, text_hash, unpacked, written

#: log2 of the registers of a sketch; its standard error is about 1.04 / 32.
LG_K = 10
#: The share of the distinct sites that makes a line boilerplate; a line on
#: one site alone never is.
SITE_SHARE, LEAST_SITES = 0.5, 2
#: What a line with a word has.
_WORDED = "[^\\x20\\x09-\\x0D]"


def lines_of(docs: DataFrame, id_col: str, site_col: str, text_col: str) -> DataFrame:
    """(id, th, site, pos, h1, h2) of every line that has a word."""
    base = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("th"), F.xxhash64(F.col(site_col).isNull(), F.col(site_col)).alias("site"), F.split(text_col, "\\n").alias("lines"))
    each = base.select("id", "th", "site", F.posexplode("lines").alias("pos", "line")).where(F.col("line").rlike(_WORDED))
    return each.select("id", "th", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def common_lines(lines: DataFrame, least: float) -> DataFrame:
    """Rows of the lines that occur `least` times or more; written."""
    often = written(lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("h1", "h2"), "often")
    return written(lines.join(sent_if_small(often), ["h1", "h2"], "left_semi"), "common")


def boilerplate(lines: DataFrame, min_sites: int, band: float) -> DataFrame:
    """(h1, h2, first) of lines on min_sites distinct sites or more."""
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "pos", "th")
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"), F.min(first).alias("first"))
    low, high = min_sites * (1 - band), min_sites * (1 + band)
    wide = spread.where(F.col("sites") >= low)
    near = wide.where(F.col("sites") < high)
    # sites are made distinct before the join, so that a common line brings a row per site to it
    seen = lines.select("h1", "h2", "site").distinct()
    exact = seen.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.count("*").alias("exact"))
    sure = wide.where(F.col("sites") >= high).select("h1", "h2", "first")
    return sure.unionByName(near.join(exact.where(F.col("exact") >= min_sites), ["h1", "h2"]).select("h1", "h2", "first"))


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines at the given places. The text is split once,
    and places are taken apart by a hash set, so it is linear in the lines."""

    def joined(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    return F.element_at(F.transform(F.array(F.split(text, "\n")), joined), 1)


def with_removed(docs: DataFrame, id_col: str = "doc_id", site_col: str = "source", text_col: str = "text", min_sites: int | None = None, band: float = 0.25, site_share: float = SITE_SHARE) -> DataFrame:
    """Columns `row`, `n_lines`, `n_removed` and `clean` (the text left)."""
    if min_sites is None:
        sites = docs.select(F.xxhash64(F.col(site_col).isNull(), F.col(site_col)).alias("site")).distinct().count()
        min_sites = max(LEAST_SITES, math.ceil(site_share * sites))
    lines = written(lines_of(docs, id_col, site_col, text_col), "lines")
    common = common_lines(lines, min_sites * (1 - band))
    release(lines)
    found = sent_if_small(written(boilerplate(common, min_sites, band), "boilerplate"))
    same = F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.th") == F.col("th")) & (F.col("first.pos") == F.col("pos"))
    gone = common.join(found, ["h1", "h2"]).where(~same).groupBy("id", "th").agg(F.collect_set("pos").alias("gone"))
    rows = packed(docs).withColumns({"key": F.col("row")[id_col], "key_hash": text_hash(F.col("row")[text_col])})
    text: Column = F.col("row")[text_col]
    met = rows.join(gone, F.col("key").eqNullSafe(F.col("id")) & (F.col("key_hash") == F.col("th")), "left")
    cleaned = F.when(F.col("gone").isNull(), text).otherwise(_without(text, F.col("gone")))
    n_lines = F.regexp_count(text, F.lit(_WORDED + "[^\\n]*"))  # from a line's first word to its end
    return met.select("row", F.when(text.isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), cleaned.alias("clean"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", site_col: str = "source", text_col: str = "text", min_sites: int | None = None, band: float = 0.25, site_share: float = SITE_SHARE) -> DataFrame:
    """docs with boilerplate lines removed from the text."""
    rows = with_removed(docs, id_col, site_col, text_col, min_sites, band, site_share)
    return unpacked(rows.select(F.col("row").withField(f"`{text_col}`", F.col("clean")).alias("row")))
