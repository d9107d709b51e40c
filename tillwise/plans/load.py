"""From raw CSV files to verified, laid-out tables."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality
from ..sources import csv, layout
from ..sources.schemas import SCHEMAS

# The key of each table's buckets, its time axis, and what its files are sorted by.
_LAYOUT: dict[str, tuple[str, str | None, tuple[str, ...]]] = {
    "website_sessions": ("website_session_id", "created_at", ("created_at",)),
    "website_pageviews": ("website_session_id", "created_at", ("pageview_url",)),
    "orders": ("website_session_id", "created_at", ("created_at",)),
    "order_items": ("order_id", "created_at", ("order_item_id",)),
    "order_item_refunds": ("order_id", "created_at", ("order_item_id",)),
}
#: Buckets of tables that were not staged, whose size is not known.
BUCKETS = 64


def read_shop(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six tables from ``<folder>/<table>.csv``.  No load order matters: keys are checked, not enforced."""
    return {name: csv.read_table(spark, name, f"{folder}/{name}.csv") for name in SCHEMAS}


def verify(tables: Mapping[str, DataFrame], expected_counts: Mapping[str, int] | None = None) -> DataFrame:
    """All load checks as rows; the load is sound when no row has ok = 0."""
    return quality.run(tables, expected_counts)


def stage(tables: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """The raw tables as typed Parquet, parsed once: checks and layout read these instead of the text."""
    out = {}
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{folder}/{name}")
        out[name] = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
    return out


def _entry(folder: str, name: str) -> str:
    """The catalogue name of a laid-out table: one per folder."""
    return f"tillwise_{hashlib.md5(folder.rstrip('/').encode()).hexdigest()[:12]}_{name}"


def bucket_counts(spark: SparkSession, staged: str) -> tuple[int, int]:
    """(buckets, files per bucket) for tables staged under that folder: as the largest of them needs, since tables that join share buckets."""
    largest = max(layout.staged_bytes(spark, f"{staged}/{name}") for name in _LAYOUT)
    buckets = layout.buckets_for(largest)
    return buckets, max(1, -(-largest // (buckets * layout.TASK_BYTES)))


def lay_out(tables: Mapping[str, DataFrame], folder: str, buckets: int = BUCKETS, files: int = 1) -> None:
    """Write the tables once, after verification, in the layout that the reports scan.

    Sessions, pageviews and orders share buckets of the session, items and refunds those of the order.  ``bucket_counts`` says how
    many buckets, and files in each, staged tables need.
    """
    for name, df in tables.items():
        if name in _LAYOUT:
            key, ts, sort_by = _LAYOUT[name]
            layout.write_bucketed_by_month(df, _entry(folder, name), f"{folder}/{name}", key, buckets, ts, sort_by, files)
        else:
            df.write.mode("errorifexists").parquet(f"{folder}/{name}")


def by_month(df: DataFrame, ts: str, sort_by: tuple[str, ...]) -> DataFrame:
    """A load step: ``df`` written by month to the shared scratch folder and opened again."""
    path = layout.scratch_path(df.sparkSession, "by-month")
    layout.write_by_month(df, path, ts, sort_by)
    return df.sparkSession.read.parquet(path)


def by_bucket(tables: Sequence[DataFrame], key: str, buckets: int) -> list[DataFrame]:
    """A load step: each table written in buckets of ``key`` to the shared scratch folder and opened again."""
    out = []
    for df in tables:
        path = layout.scratch_path(df.sparkSession, "by-bucket")
        layout.write_bucketed_by_month(df, _entry(path, "t"), path, key, buckets)
        out.append(df.sparkSession.table(_entry(path, "t")))
    return out


def open_shop(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The laid-out tables.  ``year_`` and ``month_`` are partition columns where a table has a time axis.

    Buckets are known from the catalogue; where that has no entry, the same files are read without them.
    """
    return {
        name: spark.table(_entry(folder, name)) if spark.catalog.tableExists(_entry(folder, name)) else spark.read.parquet(f"{folder}/{name}")
        for name in SCHEMAS
    }
