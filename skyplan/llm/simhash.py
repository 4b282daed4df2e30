"""SimHash near-duplicates by Golay-code fuzzy hashing (operator 10).

Fingerprint: A-Z lower-cased, words outside space and TAB..CR, shingles of
four words (fewer words: all of them), each shingle's XXH64 with seed 42; a
bit is set if more than half of the hashes, repeats counted, have it.

Links of at most 4 differing bits among the distinct fingerprints: the 64
bits are cut into segments of 22, 21 and 21 bits. Of 4 errors, either one
segment has none and another at most 2, or the three have 1, 1 and at most 2.
  - the first case: key = (segment i exactly, a Golay name of segment j);
  - the second: key = one Golay name of each segment; two of a row's names
    may be those of its own codewords only, if its partner gives all names.
Rows of equal key meet in sorted order and are verified bit by bit. Of each
run only a spanning forest of its true links leaves the task, so a run of m
near copies gives at most m - 1 links. A run of more than max_run rows is not
compared pair by pair: its members go to a second step, in which fingerprints
meet at the points within 2 bits of both, which is the case exactly if they
differ in at most 4 bits, and link to the least member of each point.

Defined results: null or wordless text has fingerprint 0, linked like any
other; repeated rows get equal results; a component's id is the least doc_id
that is not null (null if it has none); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, packed, text_hash, unpacked, utf8, written
from .components import components
from .golay import NAMES, fuzzy

SEED, SHINGLE, MAX_BITS = 42, 4, 4
#: Shift and width of each segment.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
_ONES = np.uint64(0x0101010101010101)


def fingerprint(data: bytes | None) -> int:
    """The 64-bit fingerprint of one text, as an unsigned number."""
    words = (data or b"").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(
        b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist())]), ">u8"
    ).astype(np.uint64)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; eight counters to a 64-bit lane."""
    n = len(hashes)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, 255 * 4096):
        part = hashes[start : start + 255 * 4096]
        rows = -(-len(part) // 255)
        if rows * 255 != len(part):
            part = np.concatenate((part, np.zeros(rows * 255 - len(part), np.uint64)))
        part = part.reshape(255, rows)
        for bit in range(8):
            lanes = ((part >> np.uint64(bit)) & _ONES).sum(axis=0, dtype=np.uint64)
            counts[bit::8] += lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(sum(1 << bit for bit in np.flatnonzero(2 * counts > n).tolist()))


def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array(np.array([fingerprint(x.as_py()) for x in texts], np.uint64).view(np.int64))



def link_keys(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, index of the fingerprint) for both kinds of key. The low bit of
    a key of the second kind says that the row only looks for others."""
    n = len(fps)
    at = np.arange(n)
    parts = [(fps >> np.uint64(s)) & np.uint64((1 << w) - 1) for s, w in SEGMENTS]
    named = [fuzzy(p) for p in parts]
    names = [x[0].astype(np.uint64) for x in named]
    valid = [np.arange(NAMES)[None, :] < x[1][:, None] for x in named]
    kind = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                kind += 1
                for k in range(NAMES):
                    ok = valid[j][:, k]
                    key = (np.uint64(kind) << np.uint64(40)) | (parts[i] << np.uint64(12)) | names[j][:, k]
                    yield key[ok] << np.uint64(1), at[ok]
    for a in range(NAMES):
        for b in range(NAMES):
            for c in range(NAMES):
                ok = valid[0][:, a] & valid[1][:, b] & valid[2][:, c]
                key = (names[0][:, a] << np.uint64(24)) | (names[1][:, b] << np.uint64(12)) | names[2][:, c]
                seeks = (a > 0) + (b > 0) + (c > 0) >= 2  # else at least two are its own codewords
                yield (key[ok] << np.uint64(1)) | np.uint64(seeks), at[ok]


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        for start in range(0, len(fps), 2000):
            part = fps[start : start + 2000]
            keys, at = zip(*link_keys(part))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(part[np.concatenate(at)].view(np.int64))], names=["k", "fp"])


def _forest(keys: np.ndarray, fps: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the links among the rows of one key."""
    indexed = fps[keys & 1 == 0]
    if not len(indexed):
        return []
    n = len(fps)
    close = np.bitwise_count(indexed.view(np.uint64)[:, None] ^ fps.view(np.uint64)[None, :]) <= MAX_BITS
    own = np.flatnonzero(keys & 1 == 0)
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(*np.nonzero(close)):
        x, y = find(int(own[a])), find(int(b))
        if x != y:
            root[x] = y
            out.append((int(fps[own[a]]), int(fps[b])))
    return out


def verify_runs(max_run: int):
    """Over rows sorted by key: links (over = false) of runs of up to max_run
    rows; the members of longer runs, each with itself (over = true)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k = held_f = np.empty(0, np.int64)
        out: list[tuple[int, int, bool]] = []
        over = None  # the key of a run known to be too long

        def flush() -> pa.RecordBatch:
            rows = list(zip(*out)) or [(), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.bool_())], names=["u", "v", "over"])

        def close(k: np.ndarray, f: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
            nonlocal over
            group = k >> 1
            cut = np.flatnonzero(group[1:] != group[:-1]) + 1
            starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(k)]))
            if not last:
                tail = starts[-1]
                starts, ends = starts[:-1], ends[:-1]
            two = ends - starts == 2
            a, b = starts[two], ends[two] - 1
            near = (np.bitwise_count((f[a] ^ f[b]).view(np.uint64)) <= MAX_BITS) & ((k[a] & 1 == 0) | (k[b] & 1 == 0)) & (group[a] != (-1 if over is None else over))
            out.extend((x, y, False) for x, y in zip(f[a][near].tolist(), f[b][near].tolist()))
            for s, e in zip(starts[(ends - starts > 2) | (group[starts] == over)].tolist(), ends[(ends - starts > 2) | (group[starts] == over)].tolist()):
                if e - s > max_run or group[s] == over:
                    out.extend((x, x, True) for x in f[s:e].tolist())
                else:
                    out.extend((x, y, False) for x, y in _forest(k[s:e], f[s:e]))
            if last:
                return k[:0], f[:0]
            if len(k) - tail > max_run or group[tail] == over:  # too long already: give its members away
                over = int(group[tail])
                out.extend((x, x, True) for x in f[tail:].tolist())
                return k[:0], f[:0]
            return k[tail:], f[tail:]

        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.concatenate((held_k, batch.column(0).to_numpy()))
            f = np.concatenate((held_f, batch.column(1).to_numpy()))
            held_k, held_f = close(k, f, False)
            yield flush()
        if len(held_k):
            close(held_k, held_f, True)
            yield flush()

    return run


def _ball(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All points within 2 bits of each fingerprint."""
    one = [np.uint64(1) << np.uint64(i) for i in range(64)]
    masks = np.array([np.uint64(0), *one, *(one[i] | one[j] for i in range(64) for j in range(i))], np.uint64)
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        for start in range(0, len(fps), 64):
            part = fps[start : start + 64]
            points = (part[:, None] ^ masks[None, :]).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(points.view(np.int64)), pa.array(np.repeat(part, len(masks)).view(np.int64))], names=["z", "fp"])


def near_links(nodes: DataFrame, max_run: int = 1024) -> DataFrame:
    """nodes (fp) distinct -> links (u, v) whose components are those of all
    pairs of at most 4 differing bits."""
    # a fingerprint becomes some 190 keys: spread by number of tasks, not by size, and
    # by an expression, as an exchange by fp is dropped where the rows are so dealt already
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = nodes.select("fp").repartition(tasks, F.xxhash64("fp")).mapInArrow(_emit_keys, "k long, fp long")
    runs = keys.repartition(F.shiftright("k", 1)).sortWithinPartitions("k")
    found = written(runs.mapInArrow(verify_runs(max_run), "u long, v long, over boolean"), "links")
    links = found.where("not over").select("u", "v").distinct()
    crowd = found.where("over").select(F.col("u").alias("fp")).distinct()
    if crowd.isEmpty():
        return links
    points = crowd.mapInArrow(_ball, "z long, fp long")
    least = points.groupBy("z").agg(F.min("fp").alias("v"), F.max("fp").alias("x")).where("v <> x").select("z", "v")
    return links.unionByName(points.join(least, "z").where("fp <> v").select(F.col("fp").alias("u"), "v").distinct())


def _grouped(docs: DataFrame, id_col: str, text_col: str, max_run: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, th, fp), and for each fp the least (id, th) of its component.
    Both sides of the joins by root and by fp are written tables, so that a
    large component or a common fingerprint can be split over tasks."""
    fps = written(docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("th"), F.arrow_udf(_fingerprints, "long")(utf8(text_col)).alias("fp")), "fps")
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "th")  # ids first, nulls last
    nodes = written(fps.groupBy("fp").agg(F.min(first).alias("least")), "nodes")
    roots = components(near_links(nodes, max_run))
    with_root = written(nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    of_root = written(with_root.groupBy("root").agg(F.min("least").alias("least")), "least")
    named = with_root.select("fp", "root").join(of_root, "root").select("fp", "root", "least")
    return fps, written(named, "named")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_run: int = 1024) -> DataFrame:
    """(id, fp, component_id) for each row of docs."""
    fps, named = _grouped(docs, id_col, text_col, max_run)
    return fps.join(named, "fp", "left").select("id", "fp", F.col("least.id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_run: int = 1024) -> DataFrame:
    """docs with one row of each component: that of the least id (null last),
    of equal ids that of the least text hash, of equal texts any one."""
    chosen = _grouped(docs, id_col, text_col, max_run)[1].select(F.col("least.id").alias("a"), F.col("least.th").alias("b")).distinct()
    rows = packed(docs).select("row", F.col("row")[id_col].alias("id"), text_hash(F.col("row")[text_col]).alias("th"))
    kept = rows.join(chosen, rows.id.eqNullSafe(chosen.a) & (rows.th == chosen.b), "left_semi")
    one = Window.partitionBy("id", "th").orderBy("th")
    return unpacked(kept.withColumn("n", F.row_number().over(one)).where("n = 1"))
