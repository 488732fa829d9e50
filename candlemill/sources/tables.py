"""The stored tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from candlemill.schema import FACTOR_TABLE, KLINE_TABLE, SNAPSHOT_TABLE
from candlemill.sources.paths import exists

INGESTED = T.StructType([T.StructField("name", T.StringType())])


def kline_table(spark: SparkSession, path: str) -> DataFrame:
    return stored_table(spark, path, KLINE_TABLE)


def factor_table(spark: SparkSession, path: str) -> DataFrame:
    return stored_table(spark, path, FACTOR_TABLE)


def snapshot_table(spark: SparkSession, path: str) -> DataFrame:
    return stored_table(spark, path, SNAPSHOT_TABLE)


def ingested_markers(spark: SparkSession, path: str) -> DataFrame:
    return stored_table(spark, path, INGESTED)


def stored_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table nothing was written to yet is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)
