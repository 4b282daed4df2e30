"""What Python workers need."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def let_workers_import(spark: SparkSession) -> None:
    """Put the folder of the package on the path of Python workers, wherever
    the driver was started. A cluster whose executors don't see that folder
    gets the package by --py-files."""
    environment = spark.sparkContext.environment
    have = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in have:
        environment["PYTHONPATH"] = os.pathsep.join([x for x in have if x] + [ROOT])
