"""A query is a function of the role tables; its oracle is the same question in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .roles import Roles


@dataclass(frozen=True)
class Query:
    build: Callable[[Roles], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return plain_types(self.build(Roles(spark, folder)))


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    def register(build: Callable[[Roles], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(build, oracle)
        return build

    return register


def plain_types(df: DataFrame) -> DataFrame:
    """Results for comparison: decimals as doubles, dates and timestamps as text to the second."""
    columns = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.substring(c.cast("string"), 1, 19)
        columns.append(c.alias(field.name))
    return df.select(*columns)
