"""Mixing sources to target weights by pivotal dependent rounding (operator 6).

Native: DataFrame and SQL functions only. Size is the number of words (runs
outside space and TAB..CR). Sources in code-point order, null last, have the
weights of a cycle and share `share` times all words; a source's target is
capped at `most` times its words, and what is above the caps is shared again
by weight: target = least(most * words, level * weight) for the one level at
which the targets add up.

Each document is copied floor(f) times, f = target / words of its source, and
once more with probability p = f - floor(f). The extra copies are drawn by
the pivotal method with words as mass: of two documents with fractional p,
mass moves one way or the other, at random and without bias, until one p is
0 or 1; the other goes on. So a source's words stay exact until its very
last document, which is rounded at random.

Reduction tree: documents of a source and of like size (steps of 1/4 of a
power of two) are dealt by hash to blocks of about `block` rows; each block is
one fold, which decides all its documents but one; residuals are dealt again
until one is left for each size. A last fold for each source takes these and
about `change` documents, drawn by hash and kept out of the tree, the largest
first: the small ones at its end settle what the large ones leave, so the
source's words end within about one small document of the target where it has
some hundred documents. A source of a few documents, all of them large, may end
as far off as its last draw is large. A hot source has more blocks, not larger
ones; no step grows with a source.

Draws are hashes of ids and sizes, so reruns agree. Defined results: null
text has size 0 and takes 0 words; a null source is the last source; rows that
repeat an id are numbered by text hash and are documents of their own; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, text_hash, unpacked, written

WEIGHTS = (3.0, 1.0, 2.0)
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _running(rows: DataFrame, order: list[Column], sums: list[str]) -> DataFrame:
    """rows, written, with `place` (from 0) in the given order, and for each
    column of sums the sum of it over the rows before (`before_<column>`).
    Ranges of the order are numbered and summed apart, so no task takes all
    rows; the ranges' totals, one row each, are what one window runs over."""
    spread = written(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    totals = spread.groupBy("part").agg(F.count("*").alias("n"), *[F.sum(c).alias(f"sum_{c}") for c in sums])
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"off_{c}") for c in ("n", *(f"sum_{c}" for c in sums))])
    within = Window.partitionBy("part").orderBy(*order)
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    met = spread.join(offsets, "part")
    place = F.row_number().over(within) - 1 + F.col("off_n")
    before = [(F.coalesce(F.sum(c).over(earlier), F.lit(0)) + F.col(f"off_sum_{c}")).alias(f"before_{c}") for c in sums]
    return met.select(*rows.columns, place.alias("place"), *before)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """sizes (source, size) -> (source, source_size, n_docs, target). In the
    order in which a rising level meets the caps, the level is that of the
    first source that stays below its cap."""
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_name = _running(each, [F.col("source").asc_nulls_last()], [])
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    each = by_name.withColumn("weight", F.element_at(cycle, (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))).drop("place")
    each = written(_running(each, [(F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last()], ["source_size", "weight"]), "levels")
    whole = each.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))
    level = (share * F.col("all_size") - most * F.col("before_source_size")) / (F.col("all_weight") - F.col("before_weight"))
    free = each.crossJoin(whole).withColumn("level", level).where(F.col("level") * F.col("weight") <= most * F.col("source_size"))  # whole is one row
    final = free.agg(F.min_by("level", "place").alias("level"))
    target = F.least(most * F.col("source_size"), F.coalesce(F.col("level") * F.col("weight"), most * F.col("source_size")))
    return each.crossJoin(final).select("source", "source_size", "n_docs", target.cast("double").alias("target"))


#: log2 of the fan-in of the reduction tree.
FAN_BITS = 6


def _draw(*cols: Column) -> Column:
    """Uniform in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _with_p(item: Column, p: Column) -> Column:
    return item.withField("p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))


def _step(state: Column, item: Column) -> Column:
    """One pair: mass moves to the held document (it takes) or from it."""
    held, done = state["held"], state["done"]
    room, has = held["size"] * (1 - held["p"]), held["size"] * held["p"]
    gives, fits = item["size"] * item["p"], item["size"] * (1 - item["p"])
    up, down = F.least(room, gives), F.least(has, fits)
    lot = _draw(held["id"], held["n"], held["size"], item["id"], item["n"], item["size"])
    takes = F.when(up + down > 0, lot * (up + down) < down).otherwise(held["p"] > 0.5)

    def move(takes: Column) -> Column:
        ends = F.when(takes, room <= gives).otherwise(has <= fits)  # the held one becomes integral

        def settle(ends: Column) -> Column:
            moved = F.when(takes, up).otherwise(-down)
            held_p = F.when(ends, takes.cast("double")).otherwise(held["p"] + moved / held["size"])
            item_p = F.when(ends, item["p"] - moved / item["size"]).otherwise((~takes).cast("double"))
            a, b = _with_p(held, held_p), _with_p(item, item_p)
            return F.struct(F.when(ends, b).otherwise(a).alias("held"), F.concat(done, F.array(F.when(ends, a).otherwise(b))).alias("done"))

        return _let(ends, settle)

    return _let(takes, move)


def _fold(items: Column) -> Column:
    """Items in order -> struct(held, done): the last undecided, the decided."""
    start = F.struct(F.element_at(items, 1).alias("held"), F.filter(items, lambda x: F.lit(False)).alias("done"))
    return F.aggregate(F.slice(items, 2, F.size(items)), start, _step)


def pivotal(items: DataFrame, change: int = 256) -> DataFrame:
    """items (source, n_docs, item struct(size, id, n, base, p, ...)) with
    0 < p < 1 and size > 0 -> the same with p of 0 or 1, on average the
    former p."""
    lot = F.xxhash64("item.id", "item.n")
    last_of_all = F.pmod(F.xxhash64(lot), F.ceil(F.col("n_docs") / change)) == 0
    dealt = written(items.select("source", F.floor(4 * F.log2("item.size")).alias("like"), lot.alias("lot"), "item", last_of_all.alias("late")), "mix")
    live, late = dealt.where("not late").drop("late"), dealt.where("late").select("source", "item")
    n, levels = live.count(), 0
    while n > 1 << FAN_BITS * (levels + 1):
        levels += 1
    done = []
    for level in range(levels, -1, -1):
        block = F.pmod("lot", F.lit(1 << FAN_BITS * level))
        folded = live.groupBy("source", "like", block.alias("lot")).agg(_fold(F.sort_array(F.collect_list("item"), asc=False)).alias("f"))
        table = written(folded, "mix")
        done.append(table.select("source", F.explode("f.done").alias("item")))
        live = table.select("source", "like", "lot", F.col("f.held").alias("item"))
        if level:
            live = written(live, "mix")
    last = live.select("source", "item").unionByName(late).groupBy("source").agg(_fold(F.sort_array(F.collect_list("item"), asc=False)).alias("f"))
    end = F.col("f.held")
    rounded = _with_p(end, (_draw(end["size"], end["id"], end["n"]) < end["p"]).cast("double"))
    done.append(last.select("source", F.explode(F.concat("f.done", F.array(rounded))).alias("item")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def mixture(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(id, th, n, source, size, source_size, target, copies) of every row;
    n numbers the rows that repeat id and text hash."""
    sized = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("th"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    alike = Window.partitionBy("id", "th").orderBy("source", "size")
    sized = written(sized.withColumn("n", F.row_number().over(alike).cast("long")), "sized")
    targets = source_targets(sized, weights, share, most).withColumnRenamed("source", "of")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    each = sized.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("f", copies)
    base = F.floor("f")
    item = F.struct("size", "id", "n", "th", base.alias("base"), (F.col("f") - base).alias("p"), "source_size", "target")
    each = each.select("source", "n_docs", item.alias("item"))
    drawn = (F.col("item.p") > 0) & (F.col("item.size") > 0)
    ended = pivotal(each.where(drawn)).unionByName(each.where(~drawn).drop("n_docs"))
    whole = F.col("item.base") + F.when(F.col("item.p") >= 1, 1).otherwise(0)
    return ended.select("item.id", "item.th", "item.n", "source", "item.size", "item.source_size", "item.target", whole.cast("long").alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of docs that the mix takes, with their number of copies in
    the column mix_copies and the words taken in mix_words, which take the
    place of columns of docs so named."""
    docs = docs.drop("mix_copies", "mix_words")
    found = mixture(docs, id_col, source_col, text_col, weights, share, most).where("copies > 0").select(F.col("id").alias("a"), F.col("th").alias("b"), F.col("n").alias("c"), "copies", "size")
    rows = packed(docs).select("row", F.col("row")[id_col].alias("id"), text_hash(F.col("row")[text_col]).alias("th"))
    alike = Window.partitionBy("id", "th").orderBy(F.col("row")[source_col])
    rows = rows.withColumn("n", F.row_number().over(alike).cast("long"))
    met = rows.join(found, F.col("id").eqNullSafe(F.col("a")) & (F.col("th") == F.col("b")) & (F.col("n") == F.col("c")))
    return unpacked(met, F.col("copies").alias("mix_copies"), (F.col("copies") * F.col("size")).alias("mix_words"))
