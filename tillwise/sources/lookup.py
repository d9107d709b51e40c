"""Files for point lookups by several columns, none of which is the only sort key.

Rows are ordered along a Morton curve over the chosen columns, so each row group covers a small range of every one of them
and its minima and maxima prune a filter on any of them alone.  Columns of many values in no order, such as user ids, get
Parquet bloom filters instead.

Spark 4.1 does not hand filters on TIMESTAMP_NTZ to Parquet, so a time without a zone is laid out, and asked for, by its date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.joins import null_safe_join

BITS = 16
#: Distinct texts of a Morton column at most; each gets its place in the order of all of them.
MAX_TEXTS = 65_536
GROUP_BYTES = 32 * 2**20


def morton(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the ranks (0 to 2**bits - 1) in turns, the highest first."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for i, rank in enumerate(ranks):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(ranks) + len(ranks) - 1 - i))
    return out


def _with_rank(df: DataFrame, column: str, rank: str) -> DataFrame:
    """A column from 0 to 2**BITS - 1 that rises with ``column``; NULL is 0."""
    top = 2**BITS - 1
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        texts = df.select(column).where(F.col(column).isNotNull()).distinct()
        n = texts.limit(MAX_TEXTS + 1).count()
        if n > MAX_TEXTS:
            raise ValueError(f"{column} has more than {MAX_TEXTS} texts: give it a bloom filter")
        place = F.row_number().over(Window.orderBy(column)) - 1  # of at most MAX_TEXTS rows
        placed = texts.select(column, F.floor(place * F.lit(top) / F.lit(max(1, n - 1))).alias(rank))
        return null_safe_join(df, placed, [column], "left").withColumn(rank, F.coalesce(rank, F.lit(0)).cast("long"))
    value = F.unix_micros(F.col(column).cast("timestamp")) if isinstance(kind, (T.TimestampType, T.DateType)) else F.col(column)
    ends = df.agg(F.struct(F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high"))).scalar()
    span = F.greatest(ends["high"] - ends["low"], F.lit(1e-9))
    return df.withColumn(rank, F.coalesce(F.floor((value.cast("double") - ends["low"]) / span * F.lit(top)), F.lit(0)).cast("long"))


def write_for_lookups(df: DataFrame, path: str, along: Sequence[str], bloom: Mapping[str, int] | None = None, group_bytes: int = GROUP_BYTES, partitions: int | None = None) -> None:
    """Write ``df`` ordered along ``along`` (2 to 3 columns: numbers, times, or texts of few values), with bloom filters for ``bloom``.

    ``bloom`` gives a column's expected distinct values in a row group.  Range partitions on the curve and a hash of the row deal the rows evenly,
    however many share a place.
    """
    if any(isinstance(df.schema[c].dataType, T.TimestampNTZType) for c in along):
        raise ValueError("filters on TIMESTAMP_NTZ do not reach Parquet: add the date as a column and order by that")
    if not 2 <= len(along) <= 3:
        raise ValueError("a Morton order is over two or three columns")
    t, ranks = df, []
    for i, c in enumerate(along):
        ranks.append(f"__rank{i}")
        t = _with_rank(t, c, ranks[-1])
    t = t.select(*df.columns, morton([F.col(r) for r in ranks]).alias("__at")).withColumn("__spread", F.xxhash64(*df.columns))
    ordered = t.repartitionByRange(*([partitions] if partitions else []), "__at", "__spread").sortWithinPartitions("__at", *along)
    writer = ordered.select(*df.columns).write.mode("errorifexists").option("parquet.block.size", group_bytes)
    for c, values in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", values)
    writer.parquet(path)


def rows_read(df: DataFrame) -> int:
    """Rows that the scan of ``df`` (one table, filters only) hands on once row groups and pages are skipped: runs it."""
    df.collect()
    scans = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(scans.apply(i).metrics().apply("numOutputRows").value() for i in range(scans.size()))
