"""A CSV load that sets bad lines aside instead of ending at the first.

Files are read as lines, and each line is parsed under the declared schema.  A line that does not fit is kept as it is, with its file
and the reason; good and bad rows are written together in one pass, apart by folder, so every line of every file is in
exactly one of the two.  A load with more bad lines than allowed ends, with the bad lines there to look at.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .csv import NULL_TEXT, TIMESTAMPS

_BAD = "__bad_line"


class TooManyBadLines(RuntimeError):
    """The load has ended: more lines are bad than the limit allows."""


def _reason(fields: Column, parsed: Column, raw: Column, schema: T.StructType, null_text: set[str]) -> Column:
    """Why a line is bad, as text; NULL if it is good.  The first column that does not fit is named."""
    why = F.lit(None).cast("string")
    for f in reversed(schema.fields):
        text, value = fields[f.name], parsed[f.name]
        if not f.nullable:
            why = F.when(value.isNull(), F.lit(f"no value in {f.name}")).otherwise(why)
        kind = f.dataType.simpleString()
        unfit = text.isNotNull() & (text != F.lit("")) & (~text.eqNullSafe(F.lit(NULL_TEXT)) if f.name in null_text else F.lit(True)) & value.isNull()
        why = F.when(unfit, F.lit(f"{f.name} is not {kind}")).otherwise(why)
    n = F.size(F.regexp_extract_all(F.regexp_replace(raw, r'"(?:[^"\\]|\\.)*"', "q"), F.lit(","), F.lit(0))) + 1
    width = len(schema.fields)
    why = F.when(n < width, F.lit("too few columns")).when(n > width, F.lit("too many columns")).otherwise(why)
    return F.when(parsed[_BAD].isNotNull() & why.isNull(), F.lit("malformed")).otherwise(why)


def parse(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, null_text: Iterable[str] = ()) -> DataFrame:
    """One row per line of the files but their headers: the schema's columns, ``file``, ``line`` and ``reason`` (both NULL for good rows).

    A header is a line that spells the schema's column names in order; a file with another header has a bad line.  Blank lines are no rows.  In the
    columns ``null_text`` the text NULL is a missing value; a missing value in a column declared NOT NULL makes a bad line.
    """
    special = set(null_text)
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.regexp_replace("value", "\r$", "").alias("line"), F.col("_metadata.file_path").alias("file")
    )
    header = ",".join(schema.fieldNames())
    lines = lines.where((F.trim("line") != "") & (F.replace(F.lower("line"), F.lit('"'), F.lit("")) != F.lit(header.lower())))
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields] + [T.StructField(_BAD, T.StringType(), True)])
    texts = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    options = {"sep": ",", "quote": '"', "mode": "PERMISSIVE", "timestampNTZFormat": TIMESTAMPS, "timestampFormat": TIMESTAMPS}
    typed = F.from_csv("line", F.lit(loose.toDDL()), options | {"columnNameOfCorruptRecord": _BAD})
    t = lines.withColumn("__row", typed).withColumn("__text", F.from_csv("line", F.lit(texts.toDDL()), options))
    row = F.col("__row")
    values = {f.name: F.nullif(row[f.name], F.lit(NULL_TEXT)) if f.name in special else row[f.name] for f in schema.fields}
    t = t.withColumn("__row", F.struct(*[v.alias(n) for n, v in values.items()], row[_BAD].alias(_BAD)))
    why = _reason(F.col("__text"), F.col("__row"), F.col("line"), schema, special)
    t = t.withColumn("reason", why)
    bad = F.col("reason").isNotNull()
    columns = [F.when(~bad, F.col("__row")[f.name]).alias(f.name) for f in schema.fields]
    return t.select(*columns, "file", F.when(bad, F.col("line")).alias("line"), "reason")


def load(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    folder: str,
    null_text: Iterable[str] = (),
    max_bad: int | None = None,
    max_bad_share: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of the files, written to ``folder`` in one pass and read from there.

    ``good`` has the schema's columns; ``bad`` has file, line and reason.  With more than ``max_bad`` bad lines, or more than
    ``max_bad_share`` of all lines, ``TooManyBadLines`` is raised and the bad lines stay under ``folder``.
    """
    parsed = parse(spark, paths, schema, null_text).withColumn("bad", F.col("reason").isNotNull().cast("int"))
    parsed.write.mode("errorifexists").partitionBy("bad").parquet(folder)
    whole = spark.read.schema(parsed.schema).parquet(folder)
    n = whole.groupBy("bad").count().collect()  # two rows
    counts = {r["bad"]: r["count"] for r in n}
    bad, total = counts.get(1, 0), sum(counts.values())
    if (max_bad is not None and bad > max_bad) or (max_bad_share is not None and bad > max_bad_share * total):
        raise TooManyBadLines(f"{bad} of {total} lines are bad; see {folder}/bad=1")
    return whole.where("bad = 0").select(*schema.fieldNames()), whole.where("bad = 1").select("file", "line", "reason")


def per_file(spark: SparkSession, folder: str) -> DataFrame:
    """(file, lines, good, bad) of a load."""
    t = spark.read.parquet(folder).groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("bad") == 0).alias("good"), F.count_if(F.col("bad") == 1).alias("bad"))
    return t
