"""Intermediate tables in the folder that the cluster shares.

``spark.checkpoint.dir`` names the folder.  Where it is unset (tests, a notebook) the session's
warehouse folder serves, which Spark itself treats as shared.  A table written here cuts
lineage and survives the loss of executors.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    return (base or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch").rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{folder(spark)}/{label}-{uuid.uuid4().hex}"


#: Spark's own switch: shuffle files go when the query that made them ends, not at some later garbage collection.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Parquet looks at sizes every 100 rows at first; these look at each row, and close a row group at 4 MB.
_LARGE = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(4 * 2**20)}


def large_rows(df: DataFrame) -> DataFrame:
    """Mark ``df`` for ``materialize``: its rows are of some MB, and a task shall not hold all of them in one page and one row group, neither here nor where they are read."""
    df._scratch_options = _LARGE
    return df


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: what follows starts from these files, and the shuffles that led here are dropped."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**getattr(df, "_scratch_options", {})).option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``materialize`` that no later DataFrame reads."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that nobody holds any more."""
    gc.collect()
    spark._jvm.System.gc()
