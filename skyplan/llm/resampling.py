"""Target-distribution importance resampling with overlap chunks (operator 12).

Words are runs of digits, letters (A-Z lower-cased) and bytes over 0x7F. The
features of a text are its runs of 1 to max_n consecutive words, joined by a
blank, repeats counted; a feature's bucket is the crc32 of its bytes modulo
n_buckets. With the bucket counts s of all documents (S in all) and t of the
target texts (T), a bucket's gain is floor(1000 ln((t+1)(S+B)/((s+1)(T+B))))
for B buckets, and a document's weight is the sum of the gains of its
features. The draw is that of Gumbel noise on log weights: score = weight +
floor(-1000 ln(-ln u)), u from a hash of the seed and the document's id, so
the highest scores are a sample without replacement in proportion to the
weights, and reruns agree.

Overlap chunks: a text of more than chunk_bytes is cut at word boundaries. A
chunk owns the words that start in its stretch of chunk_bytes and carries the
max_n - 1 words that follow, so it counts the features that start at its own
words and no feature is lost or counted twice. Chunks are dealt over all tasks
by document and number; their counts and weights are added by document. Shorter
texts are counted where they are read. What a task gives of the counts is a
row per bucket, and the table of gains has n_buckets numbers.

Ranks are places within written ranges of the order plus the rows before.

Defined results: null or wordless text has no feature and weight 0; a null id
hashes as the empty text and comes last among ties; rows that repeat are
documents of their own, ranked one after the other; without targets the gains
come from T = 0; an empty table gives an empty result; other columns pass
through untouched.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import _SEPARATE, packed, slices, text_hash, unpacked, utf8, written
from .mixing import _running
from .numbers import copy_numbers

N_BUCKETS, MAX_N = 10_000, 3
CHUNK_BYTES = 1 << 15
#: Bytes up to which the crc32 of a word is computed beside all others'.
_SHORT = 48
_BLANK = 0x20


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (t & np.uint32(1)))
    return t


_CRC = _crc_table()


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text with blanks for separators, and its words' begins and ends."""
    text = np.frombuffer(data.translate(_SEPARATE), np.uint8)
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = text != _BLANK
    edge = np.diff(inside)
    return text, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _fed(state: np.ndarray, text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 registers after the words text[begin:end]: one byte of all words
    a step, the longer words first; very long words by themselves."""
    state, size = state.copy(), end - begin
    for i in np.flatnonzero(size > _SHORT).tolist():
        state[i] = zlib.crc32(text[begin[i] : end[i]], int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    order = np.argsort(np.where(size > _SHORT, 0, -size), kind="stable")
    lengths, reg, at = np.where(size > _SHORT, 0, size)[order], state[order], begin[order]
    left = np.searchsorted(-lengths, -np.arange(_SHORT + 1), side="left")  # words longer than k bytes
    for k in range(int(lengths[0]) if len(lengths) else 0):
        n = left[k]
        reg[:n] = _CRC[(reg[:n] ^ text[at[:n] + k]) & 255] ^ (reg[:n] >> 8)
    state[order] = reg
    return state


def buckets(text: np.ndarray, begin: np.ndarray, end: np.ndarray, row: np.ndarray, own: np.ndarray, max_n: int = MAX_N, n_buckets: int = N_BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Of the features that start at own words and stay in one row: the place
    of the word, and the bucket."""
    state, at, found = np.full(len(begin), 0xFFFFFFFF, np.uint32), np.arange(len(begin)), []
    for n in range(max_n):
        if n:  # a blank and the next word of the same row
            ok = at + n < len(begin)
            ok[ok] = row[at[ok] + n] == row[at[ok]]
            at, state = at[ok], state[ok]
            state = _CRC[(state ^ _BLANK) & 255] ^ (state >> 8)
        state = _fed(state, text, begin[at + n], end[at + n])
        mine = own[at]
        found.append((at[mine], (state[mine] ^ np.uint32(0xFFFFFFFF)) % n_buckets))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]).astype(np.int64)


def _batch_buckets(texts: pa.Array, owned: list[int | None], max_n: int, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a batch of texts of which the first `owned` words count (None: all):
    each feature's row and bucket, and the number of own words of each row."""
    parts = [x or b"" for x in texts.to_pylist()]
    text, begin, end = word_bounds(b" ".join(parts))
    starts = np.cumsum([0] + [len(x) + 1 for x in parts])
    row = np.searchsorted(starts, begin, side="right") - 1
    n_words = np.bincount(row, minlength=len(parts))
    most = np.array([len(text) + 1 if x is None else x for x in owned], np.int64)
    place = np.arange(len(begin)) - (np.cumsum(n_words) - n_words)[row]
    own = place < most[row]
    at, bucket = buckets(text, begin, end, row, own, max_n, n_buckets)
    return row[at], bucket, np.minimum(n_words, most)


def chunks_of(data: bytes, chunk_bytes: int = CHUNK_BYTES, max_n: int = MAX_N) -> Iterator[tuple[bytes, int]]:
    """(bytes, own words) of the chunks of a text."""
    _, begin, end = word_bounds(data)
    cuts = np.searchsorted(begin, np.arange(0, len(data) + chunk_bytes, chunk_bytes))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b > a:
            yield data[begin[a] : end[min(b + max_n - 1, len(end)) - 1]], b - a


def _cut(schema: pa.Schema, chunk_bytes: int, max_n: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, texts = batch.select(["at", "id", "th"]), batch.column("text")
            for i in range(batch.num_rows):
                for k, (piece, own) in enumerate(chunks_of(texts[i].as_py(), chunk_bytes, max_n)):
                    yield pa.RecordBatch.from_arrays([*keys.slice(i, 1).columns, *[pa.array([x], t) for x, t in ((k, pa.int32()), (piece, pa.binary()), (own, pa.int64()))]], schema=schema)

    return cut


def _pieces(keyed: DataFrame, chunk_bytes: int, max_n: int) -> tuple[DataFrame, DataFrame]:
    """keyed (id, th, text as bytes) -> short texts (at, id, th, text, own),
    own and at null, and the chunks of the longer ones, dealt to all tasks; at
    tells which chunks are of one row."""
    size, none = F.octet_length("text"), F.lit(None).cast("long")
    short = keyed.where(size <= chunk_bytes).select(none.alias("at"), "id", "th", "text", none.alias("own"))
    long = keyed.where(size > chunk_bytes).select(F.monotonically_increasing_id().alias("at"), "id", "th", "text")
    out = T.StructType([*long.schema.fields[:3], T.StructField("chunk", T.IntegerType()), T.StructField("text", T.BinaryType()), T.StructField("own", T.LongType())])
    cut = long.mapInArrow(_cut(to_arrow_schema(out), chunk_bytes, max_n), out)
    return short, written(cut.repartition("at", "chunk"), "chunks").drop("chunk")


def bucket_counts(pieces: DataFrame, max_n: int = MAX_N, n_buckets: int = N_BUCKETS) -> np.ndarray:
    """How often each bucket occurs: n_buckets numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in slices(batches, 4 << 20):
            total += np.bincount(_batch_buckets(batch.column("text"), batch.column("own").to_pylist(), max_n, n_buckets)[1], minlength=n_buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(n_buckets, np.int64)
    rows = pieces.select("text", "own").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    n, s_all, t_all = float(len(corpus)), float(corpus.sum()), float(target.sum())
    pairs = zip(corpus.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in pairs], np.int64)


def _weighed(pieces: DataFrame, gains: np.ndarray, max_n: int) -> DataFrame:
    """(at, id, th, n_words, n_features, weight) of every piece."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4 << 20):
            row, bucket, n_words = _batch_buckets(batch.column("text"), batch.column("own").to_pylist(), max_n, len(gains))
            weight = np.zeros(batch.num_rows, np.int64)
            np.add.at(weight, row, gains[bucket])
            sums = (n_words, np.bincount(row, minlength=batch.num_rows), weight)
            yield pa.RecordBatch.from_arrays([*batch.select(["at", "id", "th"]).columns, *[pa.array(x.astype(np.int64)) for x in sums]], names=names)

    names = ["at", "id", "th", "n_words", "n_features", "weight"]
    out = T.StructType([*pieces.schema.fields[:3], *[T.StructField(c, T.LongType()) for c in names[3:]]])
    return pieces.mapInArrow(weigh, out)


def noise(id_col: Column, seed: int = 42) -> Column:
    """Gumbel noise in thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(u))).cast("long")


def scored(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = 5, min_words: int = 20,
           max_n: int = MAX_N, n_buckets: int = N_BUCKETS, chunk_bytes: int = CHUNK_BYTES, seed: int = 42) -> DataFrame:
    """(id, th, n_words, n_features, weight, score, rank) of every row of
    docs; th is the text's hash, rank null for what isn't drawn. Of the N rows
    with min_words words or more, floor(percent * N / 100) are drawn."""
    def keyed(df: DataFrame, id: Column, text: str) -> DataFrame:
        return df.select(id.alias("id"), text_hash(text).alias("th"), F.coalesce(utf8(text), F.lit(b"")).alias("text"))

    short, long = _pieces(keyed(docs, F.col(id_col), text_col), chunk_bytes, max_n)
    aim, long_aim = _pieces(keyed(target, F.lit(0), target_col), chunk_bytes, max_n)
    gains = gains_of(bucket_counts(short.unionByName(long), max_n, n_buckets), bucket_counts(aim.unionByName(long_aim), max_n, n_buckets))
    sums = [F.sum(c).alias(c) for c in ("n_words", "n_features", "weight")]
    whole = _weighed(long, gains, max_n).groupBy("at", "id", "th").agg(*sums)
    each = _weighed(short, gains, max_n).unionByName(whole).drop("at")
    each = written(each.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "weighed")
    may = each.where(F.col("n_words") >= min_words)
    draws = percent * may.count() // 100
    # rows that repeat are equal in all but their place in the written table, by which ranges can part them
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("th"), F.col("salt")]
    ranked = _running(may.withColumn("salt", F.monotonically_increasing_id()), order, [])
    rank = F.when(F.col("place") < draws, F.col("place") + 1).cast("long")
    rest = each.where(~F.coalesce(F.col("n_words") >= min_words, F.lit(False)))
    return ranked.select(*each.columns, rank.alias("rank")).unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: object) -> DataFrame:
    """The rows of docs that are drawn, with resample_weight, resample_score
    and resample_rank, which take the place of columns so named. Of rows that
    repeat id and text, as many stay as were drawn."""
    docs = docs.drop("resample_weight", "resample_score", "resample_rank")
    drawn = scored(docs, target, id_col, text_col, **how).where("rank is not null")
    drawn = copy_numbers(drawn.select(F.col("id").alias("a"), F.col("th").alias("b"), "weight", "score", "rank"), ["a", "b"], "c", [F.col("rank")])
    rows = packed(docs).withColumns({"id": F.col("row")[id_col], "th": text_hash(F.col("row")[text_col])})
    # whole rows move only if they are drawn: first the rows whose key is, then the numbers of those
    hit = rows.join(drawn.select("a", "b").distinct(), F.col("id").eqNullSafe(F.col("a")) & (F.col("th") == F.col("b")), "left_semi").select(*rows.columns)
    numbered = copy_numbers(hit, ["id", "th"], "n")
    met = numbered.join(drawn, F.col("id").eqNullSafe(F.col("a")) & (F.col("th") == F.col("b")) & (F.col("n") == F.col("c")))
    return unpacked(met, F.col("weight").alias("resample_weight"), F.col("score").alias("resample_score"), F.col("rank").alias("resample_rank"))
