"""What a session needs before its Python workers run the functions of this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


BATCH_BYTES = 8 * 2**20


def reach(spark: SparkSession) -> None:
    """Put the package's folder on the workers' path, and bound the batches they get.

    The path serves a checkout that workers can read, as in local mode; elsewhere the package is
    installed on the cluster or sent with ``--py-files``.  A worker holds a few copies of a batch at a time,
    as Arrow data, as Python strings and as results, and keeps that memory; texts make batches large.
    """
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(size) in ("67108864", "67108864b", "64m"):  # Spark's own value; another one is the user's
        spark.conf.set(size, str(BATCH_BYTES))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
