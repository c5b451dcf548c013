"""Registry of check queries: a Spark function and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Types that compare the same from any engine: text dates, bigint, double."""
    def plain(field: T.StructField):
        kind, column = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return column.cast("string").alias(field.name)
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            return column.cast("double").alias(field.name)
        if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            return column.cast("bigint").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under ``name`` with its SQL counterpart."""
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, folder: portable(fn(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
