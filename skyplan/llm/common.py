"""Helpers shared by the training-data operators.

Rows are kept whole by packing every input column into one struct, so an
extra column of any name can't clash with a working column.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workers import let_workers_import

#: A-Z to a-z on UTF-8 bytes; other bytes stay.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

#: A-Z to a-z, and blanks for what is no digit, letter or byte over 0x7F.
_SEPARATE = bytes(
    x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 0x80 else 0x20 for x in range(256)
)

_FOLDERS: dict[str, SparkSession] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    Taken from spark.checkpoint.dir; only where that is unset (tests, local
    mode) a local temporary folder stands in for it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = next(iter(_FOLDERS), None) or f"file://{tempfile.mkdtemp(prefix='shared-')}"
        _FOLDERS.setdefault(folder, spark)
    return folder.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


_WRITTEN: list[tuple[SparkSession, str]] = []


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder made by new_path through Hadoop's file system."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _drop_all() -> None:
    for spark, path in _WRITTEN:
        try:
            if spark.sparkContext._jsc is not None:
                drop(spark, path)
        except Exception:  # noqa: BLE001  the JVM may be gone at exit
            return


def written(df: DataFrame, what: str = "stage") -> DataFrame:
    """Write df to the shared folder and read it back: a cut in the lineage
    that survives the loss of an executor."""
    spark = df.sparkSession
    path = new_path(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.skyplan_path = path
    return out


#: Rows of a narrow table that are sent to every task at most.
SMALL_ROWS = 100_000


def sent_if_small(table: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A written table, marked for broadcast if it has few rows; else it is
    joined by its keys, on which adaptive execution can split a common one."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def scratch_mark() -> int:
    """Where scratch_drop() is to begin."""
    return len(_WRITTEN)


def scratch_drop(mark: int, keep: DataFrame) -> None:
    """Delete what was written since the mark, but for one table: for callers
    that have used up everything else that they made."""
    for spark, path in _WRITTEN[mark:]:
        if path != keep.skyplan_path:
            drop(spark, path)
    _WRITTEN[mark:] = [x for x in _WRITTEN[mark:] if x[1] == keep.skyplan_path]


def release(df: DataFrame) -> None:
    """Delete the files of a table made by written() that is no longer read."""
    drop(df.sparkSession, df.skyplan_path)


def utf8(col: Column | str) -> Column:
    """Text as bytes, so that Python workers need not decode it."""
    return (F.col(col) if isinstance(col, str) else col).cast("string").cast("binary")


def text_hash(col: Column | str) -> Column:
    return F.xxhash64(F.col(col) if isinstance(col, str) else col)


def packed(df: DataFrame) -> DataFrame:
    """One struct column `row` that holds all columns of df."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, *more: Column) -> DataFrame:
    return df.select("row.*", *more)


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about max_bytes, or one row."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, int(n * max_bytes / max(batch.nbytes, 1)))
        for start in range(0, n, step):
            yield batch.slice(start, step)


def splitmix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of the splitmix generator."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


@cache
def _codes() -> np.ndarray:
    return splitmix(np.arange(0x110000, dtype=np.uint64))


@cache
def _powers(base: int, bits: int) -> np.ndarray:
    out = np.full(1 << bits, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Points:
    """Characters (or bytes) with the sums that give the hash of any run of them."""

    def __init__(self, points: np.ndarray):
        self.points, self.bits = points, max(10, len(points).bit_length())
        self.sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(_codes()[points] * _powers(_ODD, self.bits)[: len(points)], out=self.sums[1:])

    @classmethod
    def of(cls, text: str) -> Points:
        return cls(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        run = (self.sums[end] - self.sums[begin]) * _powers(_INVERSE, self.bits)[begin]
        return splitmix(run + (end - begin).astype(np.uint64))


def expand(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of the given sizes: each member's group, and its number in it."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def words_of(data: bytes | None) -> list[bytes]:
    """Runs of digits, letters (A-Z lower-cased) and bytes over 0x7F."""
    return (data or b"").translate(_SEPARATE).split()
