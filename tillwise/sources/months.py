"""Tables by month that can be loaded again, a month or several at a time.

A load writes its months beside what is there, under a folder of its own, and then publishes a manifest: which load
each month is read from.  Manifests are numbered and a number is taken once, by a rename.  Until then readers see the table as it
was, so a load that fails, whenever that is, leaves the old months; a load that is run again gives the same table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "_manifest"


class LoadConflict(RuntimeError):
    """Another load has published meanwhile."""


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)


def _latest(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """Number of the newest manifest and what it says; (0, {}) before the first load."""
    fs, at = _fs(spark, path)
    folder = f"{path.rstrip('/')}/{_MANIFEST}"
    if not fs.exists(at(folder)):
        return 0, {}
    numbers = [int(s.getPath().getName().split(".")[0]) for s in fs.listStatus(at(folder)) if s.getPath().getName().endswith(".json")]
    if not numbers:
        return 0, {}
    text = "".join(r["value"] for r in spark.read.option("wholetext", True).text(f"{folder}/{max(numbers):08d}.json").collect())  # a line per month
    return max(numbers), json.loads(text)


def _publish(spark: SparkSession, path: str, number: int, months: dict[str, str]) -> None:
    fs, at = _fs(spark, path)
    folder = f"{path.rstrip('/')}/{_MANIFEST}"
    fs.mkdirs(at(folder))
    draft = at(f"{folder}/{uuid.uuid4().hex}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(months, sort_keys=True).encode()))
    finally:
        out.close()
    final = at(f"{folder}/{number:08d}.json")
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise LoadConflict(f"manifest {number} of {path} is taken")


def load_months(df: DataFrame, path: str, ts: str, sort_by: tuple[str, ...] = (), before_publish: Callable[[], None] | None = None) -> list[str]:
    """Write the months that ``df`` has rows of and let them replace those of the table; returns the months, as ``2013-05``.

    ``df`` holds these months whole: what the table had of them is no longer read.  Rows without a time are their own month,
    ``none``.  Other months' files are not touched.  ``before_publish`` runs when the files are there and nobody reads them yet: a check that
    raises stops the load.
    """
    spark = df.sparkSession
    number, months = _latest(spark, path)
    load = uuid.uuid4().hex
    keyed = df.withColumn("year_", F.year(ts)).withColumn("month_", F.month(ts))
    order = [F.col("year_"), F.col("month_"), *[F.col(c) for c in (sort_by or (ts,))]]
    folder = f"{path.rstrip('/')}/load_={load}"
    (
        keyed.repartitionByRange(F.col(ts), *[F.col(c) for c in sort_by if c != ts])
        .sortWithinPartitions(*order)
        .write.mode("errorifexists")
        .partitionBy("year_", "month_")
        .parquet(folder)
    )
    found = _month_folders(spark, folder)
    if before_publish:
        before_publish()
    _publish(spark, path, number + 1, months | dict.fromkeys(found, load))
    return sorted(found)


def _month_folders(spark: SparkSession, folder: str) -> list[str]:
    """Months of a load, from its folders: no data is read."""
    fs, at = _fs(spark, folder)
    found = []
    for y in fs.listStatus(at(folder)):
        if y.isDirectory() and y.getPath().getName().startswith("year_="):
            for m in fs.listStatus(y.getPath()):
                year, month = y.getPath().getName()[6:], m.getPath().getName()[7:]
                found.append("none" if not year.isdigit() else f"{year}-{int(month):02d}")
    return found


def _folder(month: str) -> str:
    if month == "none":
        return "year_=__HIVE_DEFAULT_PARTITION__/month_=__HIVE_DEFAULT_PARTITION__"
    year, number = month.split("-")
    return f"year_={year}/month_={int(number)}"


def open_months(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """The table as the newest manifest gives it, or some of its months; ``year_`` and ``month_`` are partition columns."""
    _, current = _latest(spark, path)
    wanted = {m: load for m, load in current.items() if months is None or m in months}
    if not wanted:
        raise FileNotFoundError(f"no month of {path} is loaded" if not current else f"{path} has none of the months asked for")
    folders = [f"{path.rstrip('/')}/load_={load}/{_folder(m)}" for m, load in sorted(wanted.items())]
    return spark.read.option("basePath", path).parquet(*folders).drop("load_")


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete month folders that the newest manifest does not name, and loads that were never published; returns how many.

    For a quiet moment: a query that began under an older manifest, or a load that is under way, would miss its files.
    """
    fs, at = _fs(spark, path)
    _, current = _latest(spark, path)
    kept = {(load, _folder(m)) for m, load in current.items()}
    gone = 0
    for s in fs.listStatus(at(path)):
        name = s.getPath().getName()
        if name.startswith("load_="):
            for month in _month_folders(spark, f"{path.rstrip('/')}/{name}"):
                if (name[6:], _folder(month)) not in kept:
                    gone += bool(fs.delete(at(f"{path.rstrip('/')}/{name}/{_folder(month)}"), True))
    return gone
