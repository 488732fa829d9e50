"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def use_utc(spark: SparkSession) -> SparkSession:
    """All stored and returned times are UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only where it names none (a local session) a local folder takes its place.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="candlemill-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


class Staging:
    """Intermediate tables of one run, written once and read back from the shared folder."""

    def __init__(self, spark: SparkSession, what: str):
        self._spark = spark
        self.folder = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode(mode).parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        from candlemill.sources.paths import remove_folder

        remove_folder(self._spark, self.folder)
