"""Conversation prefix trie by family-first merging (operator 11).

Conversations of a family (ids with the same c - c % span) share the start of
the family's base, the conversation whose id is that value: conversation c is
rebuilt as the base's first h turns, h = crc32(c in decimals) % heads, then
its own turns after its first h. Every distinct start of d rebuilt turns (role
and text) is a node of depth d; the root is the empty start.

Turns are put in order by turn (null first), then role and text, and cut down
to hashes and a length. Families are cogrouped: the first turns of their base
on one side, the turns of all members on the other. One call rebuilds a family
and makes its trie, with members, children, leaves and tokens saved. Only
these family nodes are shuffled, and merged by key. A node of one family alone
has its whole subtree there, so its figures are final. Nodes of several
families form the top of the trie: there the final figures of children below
it are added once, and what is left is summed over subtrees by pointer
doubling, in as many rounds as the depth has binary digits.

The key of a node is the pair of XORs of 64-bit hashes of (place, turn) over
its start. XOR can be taken in any order, so a family of more than family_rows
turns isn't built in one task: its turns are numbered and its keys summed over
written ranges, its nodes of one conversation each go to the merge, and the
doubling does the rest.

ends: the ids that end at a node come as one text per family; a task hashes
the texts of a node one after the other and never holds more than a batch.

Defined results: null role or text is the empty text; rows that repeat are
turns of their own; rows with a null conv_id belong to no conversation and
make no node; conversations that are left without turns end at the root; an
empty table has no node, not even a root; other columns aren't looked at.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sent_if_small, written

SPAN, HEADS = 100, 6
#: Turns that a family is built of in one task at most (some 50 bytes each).
FAMILY_ROWS = 100_000
#: Fixed value: the seed of Spark's xxhash64.
_SEED = 42
_NODE = (
    "k1 long, k2 long, depth long, p1 long, p2 long, at long, conv_id long, parent_conv_id long, n_convs long,"
    " n_children long, n_leaves long, saved long, size long, ends string, loose boolean"
)
_ARROW = pa.schema([(x.split()[0], {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[x.split()[1]]) for x in _NODE.split(", ")])


def turns_of(convs: DataFrame, span: int = SPAN, heads: int = HEADS, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(base, conv_id, h, turn, role, text) of the turns of conversations."""
    c = F.col(conv_col).cast("long")
    return convs.where(c.isNotNull()).select(
        (c - c % span).alias("base"), c.alias("conv_id"), (F.crc32(c.cast("string").cast("binary")) % heads).alias("h"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _hashes() -> list[Column]:
    return [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "role", "text").alias("h2"), F.length("text").cast("long").alias("size")]


def rebuilt(placed: DataFrame, *content: str) -> DataFrame:
    """(base, conv_id, h, pos from 1, content) -> (base, conv_id, at from 1,
    content) of the rebuilt conversations."""
    head = placed.where("conv_id = base").select("base", "pos", *content)
    n_head = head.groupBy("base").agg(F.max("pos").alias("n"))
    own = placed.where("pos > h").join(n_head, "base", "left")
    own = own.select("base", "conv_id", (F.col("pos") - F.col("h") + F.least("h", F.coalesce("n", F.lit(0)))).alias("at"), *content)
    members = placed.select("base", "conv_id", "h").distinct()
    taken = members.join(head, "base").where("pos <= h").select("base", "conv_id", F.col("pos").alias("at"), *content)
    return own.unionByName(taken)


def rebuilt_turns(convs: DataFrame, span: int = SPAN, heads: int = HEADS) -> DataFrame:
    """(conv_id, at, role, text) of every rebuilt conversation; a
    conversation that is left without turns has no row."""
    placed = turns_of(convs, span, heads).withColumn("pos", F.row_number().over(Window.partitionBy("base", "conv_id").orderBy(*_order())).cast("long"))
    return rebuilt(placed, "role", "text").select("conv_id", "at", "role", "text")


def _mark(place: int, h: int) -> int:
    """xxhash64(place, h) of Spark, unsigned."""
    return xxhash.xxh64_intdigest(struct.pack("<q", h), xxhash.xxh64_intdigest(struct.pack("<q", place), _SEED))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def build_family(at: int, head: list[tuple[int, int, int]], members: dict[int, tuple[int, list[tuple[int, int, int]]]]) -> list[tuple]:
    """head: (h1, h2, size) of the base's first turns; members: by id h and
    the turns -> the rows of _NODE."""
    keys, place, size, parent, first, count, kids, ends = [(0, 0)], {(0, 0, 0): 0}, [0], [-1], [min(members)], [0], [0], [[]]
    depth = [0]
    for c in sorted(members):
        h, own = members[c]
        now, k1, k2 = 0, 0, 0
        count[0] += 1
        for d, (a, b, n) in enumerate([*head[:h], *own[h:]], 1):
            k1, k2 = k1 ^ _mark(d, a), k2 ^ _mark(d, b)
            at_node = place.get((k1, k2, d))
            if at_node is None:
                at_node = place[k1, k2, d] = len(keys)
                keys.append((k1, k2))
                for rows, x in ((size, n), (parent, now), (first, c), (count, 0), (kids, 0), (ends, []), (depth, d)):
                    rows.append(x)
                kids[now] += 1
            count[at_node] += 1
            now = at_node
        ends[now].append(str(c))
    leaves, saved = [int(not k) for k in kids], [(n - 1) * s for n, s in zip(count, size)]
    for i in range(len(keys) - 1, 0, -1):  # children come after their parents
        leaves[parent[i]] += leaves[i]
        saved[parent[i]] += saved[i]
    out = []
    for i, (a, b) in enumerate(keys):
        up = parent[i]
        over = (None, None, None) if up < 0 else (_signed(keys[up][0]), _signed(keys[up][1]), first[up])
        out.append((_signed(a), _signed(b), depth[i], over[0], over[1], at, first[i], over[2], count[i], kids[i], leaves[i], saved[i], size[i], ",".join(ends[i]), False))
    return out


def _family(head: pa.Table, turns: pa.Table) -> pa.Table:
    if not turns.num_rows:
        return _ARROW.empty_table()
    members: dict[int, tuple[int, list]] = {}
    for c, h, *turn in zip(*[turns.sort_by([("conv_id", "ascending"), ("pos", "ascending")])[x].to_pylist() for x in ("conv_id", "h", "h1", "h2", "size")]):
        members.setdefault(c, (h, []))[1].append(tuple(turn))
    start = list(zip(*[head.sort_by("pos")[x].to_pylist() for x in ("h1", "h2", "size")]))
    rows = build_family(turns["base"][0].as_py(), start, members)
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _small_families(turns: DataFrame, heads: int) -> DataFrame:
    near = turns.repartition("base")  # one exchange for the order and the families
    placed = near.withColumn("pos", F.row_number().over(Window.partitionBy("base", "conv_id").orderBy(*_order())).cast("long"))
    narrow = placed.select("base", "conv_id", "h", "pos", *_hashes())
    head = narrow.where(F.col("conv_id") == F.col("base")).where(F.col("pos") < heads).select(*[F.col(c).alias(c) for c in ("base", "pos", "h1", "h2", "size")])
    return head.groupBy("base").cogroup(narrow.groupBy("base")).applyInArrow(_family, _NODE)


def _along(rows: DataFrame, order: list[Column], **running: Column) -> DataFrame:
    """rows with aggregates over the rows of a conversation up to each, without
    a task that takes a conversation: written ranges, and their totals before."""
    spread = written(rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "ranges")
    within = Window.partitionBy("conv_id", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = spread.groupBy("conv_id", "part").agg(*[f.alias(f"_{k}") for k, f in running.items()])
    over = {"n": lambda c: F.sum(c), "k1": lambda c: F.bit_xor(c), "k2": lambda c: F.bit_xor(c)}
    before = totals.select("conv_id", "part", *[F.coalesce(over[k](f"_{k}").over(ahead), F.lit(0)).alias(f"_{k}") for k in running])
    met = spread.withColumns({k: f.over(within) for k, f in running.items()}).join(before, ["conv_id", "part"])
    both = {k: F.col(k) + F.col(f"_{k}") if k == "n" else F.col(k).bitwiseXOR(F.col(f"_{k}")) for k in running}
    return met.withColumns(both).drop("part", *[f"_{k}" for k in running])


def _large_families(turns: DataFrame) -> DataFrame:
    """A node row for every start of every conversation."""
    content = ["h1", "h2", "size"]
    placed = _along(turns, _order(), n=F.count("*")).select("base", "conv_id", "h", F.col("n").alias("pos"), *_hashes())
    placed = written(placed, "placed")
    again = rebuilt(placed, *content).select("conv_id", "at", F.xxhash64("at", "h1").alias("x1"), F.xxhash64("at", "h2").alias("x2"), "size")
    summed = _along(again, [F.col("at")], k1=F.bit_xor("x1"), k2=F.bit_xor("x2"))
    lengths = placed.select("conv_id").distinct().join(again.groupBy("conv_id").agg(F.max("at").alias("last")), "conv_id", "left")
    lengths = lengths.select("conv_id", F.coalesce("last", F.lit(0)).alias("last"))
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")

    def rows(df: DataFrame, k1: Column, k2: Column, depth: Column, p1: Column, p2: Column, size: Column) -> DataFrame:
        ends = F.when(F.col("last") == depth, F.col("conv_id").cast("string")).otherwise("")
        return df.select(
            k1.alias("k1"), k2.alias("k2"), depth.cast("long").alias("depth"), p1.alias("p1"), p2.alias("p2"), F.col("conv_id").alias("at"), "conv_id", none.alias("parent_conv_id"),
            F.lit(1).cast("long").alias("n_convs"), zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved"), size.alias("size"), ends.alias("ends"), F.lit(True).alias("loose"),
        )

    deep = rows(summed.join(lengths, "conv_id"), F.col("k1"), F.col("k2"), F.col("at"), F.col("k1").bitwiseXOR(F.col("x1")), F.col("k2").bitwiseXOR(F.col("x2")), F.col("size"))
    return deep.unionByName(rows(lengths, zero, zero, zero, none, none, zero))


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in the order of their node and place -> a hash for each node."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("sha", pa.string())])
    last, sha = None, None
    for batch in batches:
        done = []
        for k1, k2, text in zip(*[batch.column(x).to_pylist() for x in ("k1", "k2", "ends")]):
            if (k1, k2) != last:
                if last:
                    done.append((*last, sha.hexdigest()))
                last, sha = (k1, k2), hashlib.sha256(text.encode())
            else:
                sha.update(b"," + text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done), schema)], schema=schema)
    if last:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*last, sha.hexdigest()), schema)], schema=schema)


def merge(nodes: DataFrame) -> DataFrame:
    """Written family nodes -> the nodes of the whole trie."""
    single = [F.max(c).alias(c) for c in ("n_children", "n_leaves", "saved", "parent_conv_id", "ends")]  # these count where there is one row
    same = [F.max(c).alias(c) for c in ("depth", "p1", "p2", "size")]
    shared = ((F.count("*") > 1) | F.max("loose")).alias("shared")
    merged = written(nodes.groupBy("k1", "k2").agg(*same, F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), shared, *single), "merged")
    top = merged.where("shared").select("k1", "k2", "depth", "p1", "p2", "size", "conv_id", "n_convs")
    below = [F.sum(F.when(~F.col("shared"), F.col(c))).alias(f"below_{c}") for c in ("n_leaves", "saved")]
    kids = merged.where("p1 is not null").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"), *below)
    own_leaves = F.when(F.col("n_children").isNull(), 1).otherwise(F.coalesce("below_n_leaves", F.lit(0)))
    own_saved = (F.col("n_convs") - 1) * F.col("size") + F.coalesce("below_saved", F.lit(0))
    top = top.join(kids, ["k1", "k2"], "left").select(
        *top.columns, F.coalesce("n_children", F.lit(0)).alias("n_children"), own_leaves.cast("long").alias("n_leaves"), own_saved.alias("saved")
    )
    top = written(top, "top")
    state = top.select("k1", "k2", F.col("p1").alias("a1"), F.col("p2").alias("a2"), "n_leaves", "saved")
    deepest, reach = top.agg(F.max("depth")).first()[0] or 0, 1
    while reach <= deepest:  # a row has the sums of its descendants nearer than reach, and its ancestor at reach
        more = state.where("a1 is not null").groupBy(F.col("a1").alias("k1"), F.col("a2").alias("k2")).agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        up = state.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2"))
        met = state.join(more, ["k1", "k2"], "left").join(up, ["a1", "a2"], "left")
        sums = [(F.col(c) + F.coalesce(x, F.lit(0))).alias(c) for c, x in (("n_leaves", "l"), ("saved", "s"))]
        state, reach = written(met.select("k1", "k2", F.col("b1").alias("a1"), F.col("b2").alias("a2"), *sums), "reach"), 2 * reach
    keys = top.select("k1", "k2")
    texts = nodes.where("ends <> ''").select("k1", "k2", "at", "ends").join(keys, ["k1", "k2"], "left_semi")
    hashed = texts.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "at").mapInArrow(_hash_ends, "k1 long, k2 long, sha string")
    out = ["conv_id", "depth", "p1", "p2", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "sha"]
    top = top.drop("n_leaves", "saved").join(state.drop("a1", "a2"), ["k1", "k2"]).join(hashed, ["k1", "k2"], "left")
    top = top.withColumn("parent_conv_id", F.lit(None).cast("long")).withColumn("sha", F.coalesce("sha", F.sha2(F.lit(b""), 256)))
    rest = merged.where("not shared").withColumn("sha", F.sha2(F.col("ends").cast("binary"), 256))
    over = merged.where("shared").select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("over"))
    found = top.select("k1", "k2", *out).unionByName(rest.select("k1", "k2", *out)).join(over, ["p1", "p2"], "left")
    return found.select(
        "k1", "k2", "p1", "p2", "conv_id", "depth", F.coalesce("over", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256"),
    )


def conversation_trie(convs: DataFrame, span: int = SPAN, heads: int = HEADS, family_rows: int = FAMILY_ROWS) -> DataFrame:
    """A row per node: its key (k1, k2) and its parent's (p1, p2; null for the
    root), conv_id (its least member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = turns_of(convs, span, heads)
    large = written(turns.groupBy("base").agg(F.count("*").alias("n")).where(F.col("n") > family_rows).select("base"), "large")
    if large.isEmpty():
        nodes = _small_families(turns, heads)
    else:
        large = sent_if_small(large)
        nodes = _small_families(turns.join(large, "base", "left_anti"), heads).unionByName(_large_families(turns.join(large, "base", "left_semi")))
    return merge(written(nodes, "family-nodes"))
