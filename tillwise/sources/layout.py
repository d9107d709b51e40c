"""Physical layout for tables that are queried again and again.

Month partitions serve date ranges and calendar keys, sorting inside a file gives
the row-group min/max that prune point filters, and buckets by the join key let
session joins run without a shuffle.  Two-valued columns (device, repeat flag) are
not worth a partition: a columnar scan of half the table is already right.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_by_month(
    df: DataFrame, path: str, ts: str, sort_by: tuple[str, ...] = (), partitions: int | None = None
) -> None:
    """Write Parquet partitioned by year and month of ``ts``.

    ``partitions`` is the number of range partitions (the session's shuffle partitions if
    not given).

    Range partitioning on the timestamp keeps a month in few files yet still splits
    a month that holds most of the rows, because the timestamp itself is the range key.
    """
    keyed = df.withColumn("year_", F.year(ts)).withColumn("month_", F.month(ts))
    order = [F.col("year_"), F.col("month_"), *[F.col(c) for c in (sort_by or (ts,))]]
    ranges = [F.col(ts), *[F.col(c) for c in sort_by if c != ts]]
    (
        keyed.repartitionByRange(*([partitions] if partitions else []), *ranges)
        .sortWithinPartitions(*order)
        .write.mode("errorifexists")
        .partitionBy("year_", "month_")
        .parquet(path)
    )


#: Bytes of a table that one bucket should hold, and one task write.
BUCKET_BYTES = 1024 * 2**20
TASK_BYTES = 256 * 2**20


def buckets_for(table_bytes: int, least: int = 1, most: int = 65_536) -> int:
    """Buckets for a table of that many bytes: a power of two, so that tables of different sizes still join bucket to bucket."""
    wanted = max(least, min(most, -(-table_bytes // BUCKET_BYTES)))
    return 1 << (wanted - 1).bit_length()


def staged_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a folder of files, as its file system counts them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def _dealt(df: DataFrame, key: str, buckets: int, files: int) -> DataFrame:
    """Rows shuffled for a bucketed write: each bucket to ``files`` tasks, by the rest of the row, so that a hot key is written by several.

    Spark lets a bucket have several files.  The bucket number is Spark's own, so a task holds whole shares of buckets.
    """
    if files == 1:
        return df.repartition(buckets, key)
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    share = F.pmod(F.xxhash64(*df.columns), F.lit(files))
    return df.repartition(buckets * files, bucket, share)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, sort_by: tuple[str, ...] = (), files: int = 1) -> None:
    """Save a table bucketed by ``key``, in ``files`` files per bucket at most."""
    (
        _dealt(df, key, buckets, files)
        .write.mode("errorifexists")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key, *sort_by)
        .saveAsTable(table)
    )


def write_bucketed_by_month(
    df: DataFrame, table: str, path: str, key: str, buckets: int, ts: str | None = None, sort_by: tuple[str, ...] = (), files: int = 1
) -> None:
    """Save files under ``path``, and a catalogue entry ``table`` for them, in buckets of ``key``.

    With ``ts`` each bucket is also cut by month.  A join or fold on ``key`` then needs no shuffle and a date
    or calendar filter still prunes.  ``files`` tasks write a bucket, and share its hot keys; a bucketed scan still reads a bucket in
    one task, so ``buckets`` has to grow with the table (``buckets_for``), and a query over one hot key is better read without buckets.
    """
    months = ["year_", "month_"] if ts else []
    keyed = df.withColumn("year_", F.year(ts)).withColumn("month_", F.month(ts)) if ts else df
    writer = _dealt(keyed, key, buckets, files).write.mode("errorifexists").format("parquet").option("path", path)
    writer = writer.bucketBy(buckets, key).sortBy(key, *[c for c in sort_by if c != key])
    (writer.partitionBy(*months) if months else writer).saveAsTable(table)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Where that is unset the session's warehouse serves: Spark itself takes it to be shared.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
