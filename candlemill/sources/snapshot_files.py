"""Landed market snapshots: one JSON document per file, ``<market>/<name>.json``.

What is known of a pull may lie beside it as ``<market>/<name>.pull``, a JSON object with any of
``pulled_at`` (ISO text), ``source_url``, ``status_code``, ``latency_ms`` and ``err_msg``. A failed pull
has such a file and perhaps no document.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.functions.names import stem
from candlemill.functions.times import from_iso_text
from candlemill.operators.snapshots import is_json, with_envelope
from candlemill.schema import MARKETS
from candlemill.sources.paths import require_folder

_PATH = "_metadata.file_path"
_PULL = "pulled_at string, source_url string, status_code int, latency_ms long, err_msg string"


def landed_snapshots(
    spark: SparkSession,
    folder: str,
    markets: list[str] | None = None,
    pulled_at: datetime | None = None,
) -> DataFrame:
    """Pulls with their documents and envelopes.

    The market is the folder a file lies in. The pull time is that of the envelope, or the file's modification
    time, unless the caller knows better. An envelope that is no JSON object ends the read in an error.
    """
    root = require_folder(spark, folder)
    documents = _texts(spark, root, "*.json", markets).select(
        "market", "name", "pulled_at", F.col("path").alias("source_url"), F.col("value").alias("payload")
    )
    known = F.from_json("value", _PULL)
    envelopes = _texts(spark, root, "*.pull", markets).withColumn("known", F.when(_readable(), known)).select(
        "market", "name", F.coalesce(from_iso_text(F.col("known.pulled_at")), "pulled_at").alias("pulled_at"),
        "known.source_url", "known.status_code", "known.latency_ms", "known.err_msg",
    )
    pulls = with_envelope(documents, envelopes)
    taken = F.lit(pulled_at).cast("timestamp") if pulled_at is not None else F.col("pulled_at")
    return pulls.withColumn("pulled_at", F.timestamp_millis(F.unix_millis(taken)))


def _readable() -> Column:
    unread = F.raise_error(F.concat(F.lit("no JSON object in "), F.col("path"))).cast("boolean")
    return F.when(is_json(F.col("value")) & F.col("value").rlike(r"^\s*\{"), F.lit(True)).otherwise(unread)


def _texts(spark: SparkSession, root: str, pattern: str, markets: list[str] | None) -> DataFrame:
    """Whole files as (market, name, path, pulled_at, value)."""
    files = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
    )
    return files.select(
        F.element_at(F.split(_PATH, "/"), -2).alias("market"), stem(F.col(_PATH)).alias("name"),
        F.col(_PATH).alias("path"), F.col("_metadata.file_modification_time").alias("pulled_at"), "value",
    ).filter(F.col("market").isin(list(markets or MARKETS)))
