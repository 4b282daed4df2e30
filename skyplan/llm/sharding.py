"""Sharding by fixed virtual slots (operator 13).

A record's slot is a hash of its id and text, modulo n_slots (some thousands);
of records that repeat both, the number of the copy is hashed too, so that no
key, however common, fills a slot. Bytes (UTF-8 length of the text plus 8) are
added up by slot, and a map deals slots to shards so that the shards' bytes are
near equal: the heaviest slot first, each to the lightest shard. The law is
`bytes`. Slots are many times more than shards and their number doesn't grow
with the data, so the map is made on the driver.

A map is a table (slot, shard) in a folder of versions. Rebalancing edits it:
slots of shards that are gone, and as few slots of shards that are too heavy
as will do, move to the lightest shards, and the result is a new version; all
other slots, and with them their records, stay where they are. Records never
change their slot.

A record's place in its shard is that within its slot, in the order of id and
text hash, plus the records of the shard's slots before it; tasks hold slots,
not shards.

Defined results: null text has no bytes, so size 8 and crc32 0; null ids are
ids like others; rows that repeat are records of their own; an empty table
gives an empty result and a map that deals the slots round; other columns pass
through untouched.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path, packed, text_hash, unpacked, utf8, written
from .numbers import copy_numbers

N_SLOTS, N_SHARDS = 8192, 24
#: Bytes that a record has besides its text.
OVERHEAD = 8
LAW = "bytes"


def record_slot(id_col: Column | str, th: Column | str, copy: Column | str, n_slots: int = N_SLOTS) -> Column:
    id_col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.xxhash64(id_col.isNull(), id_col, th, copy), F.lit(n_slots)).cast("int")


def records(docs: DataFrame, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, size, text_crc32, copy, virtual) of every row, written."""
    data = utf8(text_col)
    size = (F.coalesce(F.octet_length(data), F.lit(0)) + OVERHEAD).cast("long")
    narrow = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("th"), size.alias("size"), F.coalesce(F.crc32(data), F.lit(0)).cast("long").alias("text_crc32"))
    numbered = copy_numbers(narrow, ["id", "th", "text_crc32"], "copy")
    return written(numbered.withColumn("virtual", record_slot("id", "th", "copy", n_slots)), "records")


def slot_bytes(rows: DataFrame, n_slots: int = N_SLOTS) -> list[int]:
    """Bytes by slot: a number for each of the fixed slots."""
    out = [0] * n_slots
    for slot, n in rows.groupBy("virtual").agg(F.sum("size").alias("n")).collect():
        out[slot] = n
    return out


def balanced(sizes: list[int], n_shards: int = N_SHARDS) -> list[int]:
    """A shard for each slot: the heaviest slot first, to the lightest shard
    (of equals the one with fewer slots, then the first)."""
    loads, shard_of = [(0, 0, k) for k in range(n_shards)], [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, n, k = loads[0]
        shard_of[slot] = k
        heapq.heapreplace(loads, (load + sizes[slot], n + 1, k))
    return shard_of


def rebalanced(shard_of: list[int], sizes: list[int], n_shards: int, tolerance: float = 0.01) -> list[int]:
    """The map edited for n_shards and the slots' present sizes. Slots of
    shards that are gone move first; then, while the heaviest shard is above
    the mean by more than the tolerance, its largest slot moves that brings
    the lightest shard nearer to the mean. A shard that has no such slot, for
    one of its slots alone is too large, is left out of the mean from then."""
    out, members = list(shard_of), [set() for _ in range(n_shards)]
    loads = [0] * n_shards
    for slot, k in enumerate(out):
        if k < n_shards:
            members[k].add(slot)
            loads[k] += sizes[slot]
    least = lambda: min(range(n_shards), key=lambda k: (loads[k], len(members[k]), k))

    def move(slot: int, k: int) -> None:
        if out[slot] < n_shards and slot in members[out[slot]]:
            members[out[slot]].remove(slot)
            loads[out[slot]] -= sizes[slot]
        out[slot] = k
        members[k].add(slot)
        loads[k] += sizes[slot]

    for slot in sorted((s for s, k in enumerate(shard_of) if k >= n_shards), key=lambda s: (-sizes[s], s)):
        move(slot, least())
    able = set(range(n_shards))  # a shard that no slot can leave with profit is out
    while able:
        mean = sum(loads[k] for k in able) / len(able)
        top, low = max(able, key=lambda k: (loads[k], -k)), min(able, key=lambda k: (loads[k], len(members[k]), k))
        if loads[top] <= mean * (1 + tolerance):
            break
        # of those that don't overshoot the mean by more than they mend, the largest
        fit = [s for s in members[top] if sizes[s] and loads[low] + sizes[s] < loads[top] and (loads[low] + sizes[s] <= mean or loads[low] + sizes[s] - mean < mean - loads[low])]
        if fit:
            move(max(fit, key=lambda s: (sizes[s], -s)), low)
        else:
            able.remove(top)
    return out


def save_map(spark: SparkSession, path: str, version: int, shard_of: list[int]) -> None:
    """A version is written once and never changed."""
    rows = spark.createDataFrame(list(enumerate(shard_of)), "virtual int, shard int")
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")


def versions(spark: SparkSession, path: str) -> list[int]:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")) or []
    return sorted(int(x.getPath().getParent().getName().split("=")[1]) for x in found)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(virtual, shard) of a version, of the newest unless one is given."""
    if version is None:
        version = versions(spark, path)[-1]
    return spark.read.schema("virtual int, shard int").parquet(f"{path}/version={version}")


def rebalance(spark: SparkSession, path: str, sizes: list[int], n_shards: int = N_SHARDS, tolerance: float = 0.01) -> int:
    """The newest map edited for these sizes; returns the version that holds,
    a new one if a slot has moved."""
    version = versions(spark, path)[-1]
    old = [k for _, k in sorted(map(tuple, load_map(spark, path, version).collect()))]
    new = rebalanced(old, sizes, n_shards, tolerance)
    if new != old:
        version += 1
        save_map(spark, path, version, new)
    return version


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """records() with shard and slot, the place in the shard from 0. The map
    has a row for each of the fixed slots, which is why it may be sent to all
    tasks."""
    within = Window.partitionBy("virtual").orderBy(F.col("id").asc_nulls_last(), "th", "text_crc32", "copy")
    counts = rows.groupBy("virtual").agg(F.count("*").alias("n")).join(F.broadcast(slot_map), "virtual")
    ahead = Window.partitionBy("shard").orderBy("virtual").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("virtual", "shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    ranked = rows.withColumn("place", F.row_number().over(within) - 1)
    return ranked.join(F.broadcast(before), "virtual").withColumn("slot", (F.col("place") + F.col("before")).cast("long")).drop("place", "before")


def shard(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, size, text_crc32, copy, virtual, shard, slot) of every row by
    the newest map in path, which is edited for n_shards and for the sizes
    now; without one a first version is made."""
    spark = docs.sparkSession
    path, rows = path or new_path(spark, "slot-map"), records(docs, n_slots, id_col, text_col)
    sizes = slot_bytes(rows, n_slots)
    if versions(spark, path):
        version = rebalance(spark, path, sizes, n_shards)
    else:
        version = 1
        save_map(spark, path, version, balanced(sizes, n_shards))
    return placed(rows, load_map(spark, path, version))


def write_shards(docs: DataFrame, out: str, slot_map: DataFrame, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text", files: int = 1) -> None:
    """The rows of docs as Parquet in a folder for each shard, in at most
    `files` files each, of whole slots. Only rows that repeat are numbered."""
    rows = packed(docs).withColumns({"id": F.col("row")[id_col], "th": text_hash(F.col("row")[text_col]), "text_crc32": F.coalesce(F.crc32(utf8(F.col("row")[text_col])), F.lit(0))})
    key = F.xxhash64(F.col("id").isNull(), "id", "th", "text_crc32")
    rows = rows.withColumn("key", key)
    many = written(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "many")
    once = rows.join(many, "key", "left_anti").withColumn("copy", F.lit(0).cast("long"))
    again = copy_numbers(rows.join(many, "key", "left_semi"), ["id", "th", "text_crc32"], "copy")
    both = once.select("row", "id", "th", "copy").unionByName(again.select("row", "id", "th", "copy"))
    met = both.withColumn("virtual", record_slot("id", "th", "copy", n_slots)).join(F.broadcast(slot_map), "virtual").withColumn("file", F.pmod("virtual", F.lit(files)))
    dealt = unpacked(met.repartition("shard", "file"), F.col("shard").alias("__shard"))
    dealt.write.partitionBy("__shard").parquet(out)
