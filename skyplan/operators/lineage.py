"""Written tables between the rounds of iterative steps."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_ROUNDS: list[tuple[SparkSession, str]] = []


@atexit.register
def _drop_rounds() -> None:
    for spark, path in _ROUNDS:
        try:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001  the session may have ended
            return


def written_folder(spark: SparkSession, name: str) -> str:
    """A new path in the session's shared checkpoint folder, deleted when the
    driver ends. Where that is unset, in local mode only, a temporary folder
    stands in for it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = _local_folder()
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _ROUNDS.append((spark, path))
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """A written copy in the shared folder: a cache would keep the plan, which
    loops whose rounds read a table more than once would double each time."""
    spark = df.sparkSession
    path = written_folder(spark, "round")
    df.write.option("compression", "zstd").parquet(path)  # rounds are written once and read a few times: bytes count
    return spark.read.schema(df.schema).parquet(path)


@cache
def _local_folder() -> str:
    return f"file://{tempfile.mkdtemp(prefix='rounds-')}"
