"""CSV in and out, with the load traps handled.

Spark's reader accepts CRLF and LF line ends alike, so a file with the "wrong"
terminator neither loads empty nor keeps a carriage return on its last column.
Malformed rows fail the read instead of loading quietly.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import NULL_TEXT_COLUMNS, SCHEMAS

TIMESTAMPS = "yyyy-MM-dd HH:mm:ss"
NULL_TEXT = "NULL"


def read(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """A typed scan of one file, or of several files as one table."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("mode", "FAILFAST")
        .option("timestampNTZFormat", TIMESTAMPS)
        .csv(paths if isinstance(paths, str) else list(paths))
    )


def null_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn the text ``NULL`` into a real NULL in the named columns only."""
    wanted = set(columns)
    return df.select(
        *[
            F.nullif(F.col(c), F.lit(NULL_TEXT)).alias(c) if c in wanted else F.col(c)
            for c in df.columns
        ]
    )


def read_table(spark: SparkSession, name: str, paths: str | Sequence[str]) -> DataFrame:
    """Read one of the shop's tables under its declared schema."""
    return null_text(read(spark, paths, SCHEMAS[name]), NULL_TEXT_COLUMNS.get(name, ()))


def write_result(df: DataFrame, path: str, line_end: str = "\n") -> None:
    """Export a query result: header row, NULL written as text."""
    (
        df.write.mode("errorifexists")
        .option("header", True)
        .option("nullValue", NULL_TEXT)
        .option("lineSep", line_end)
        .option("timestampNTZFormat", TIMESTAMPS)
        .csv(path)
    )
