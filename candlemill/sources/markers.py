"""Success markers: empty files whose name says which batch has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.sources.paths import entry_names
from candlemill.sources.tables import ingested_markers

_NAMES = T.StructType([T.StructField("name", T.StringType())])


def marker_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the marker files directly in a folder (one per date, market and interval)."""
    names = entry_names(spark, folder, "_SUCCESS__")
    return spark.createDataFrame([(name,) for name in names], _NAMES)


def is_ingested(spark: SparkSession, state: str, name: str) -> bool:
    return not ingested_markers(spark, state).filter(F.col("name") == name).isEmpty()
