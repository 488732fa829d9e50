"""Staged tables in the folder all machines share, and Arrow passes over texts."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; an own one only in a local session that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="candlemill-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def staged(df: DataFrame, what: str) -> DataFrame:
    """The frame written once to the shared folder and read back: cuts lineage, survives executors."""
    path = new_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def text_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only id and text, whatever other columns there are."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def map_rows(
    df: DataFrame, function: Callable[..., Iterator[tuple]], schema: T.StructType, *args,
    rows: int = 2048, most_chars: int = 8 << 20,
) -> DataFrame:
    """Pass batches of column lists to a function that yields result rows.

    ``function(columns, *args)`` gets a dict of Python lists and yields tuples of the schema. A batch
    is cut into pieces of about ``most_chars`` characters, so long texts never pile up in memory.
    """
    arrow = _arrow_schema(schema)

    def batches(source):
        for batch in source:
            for part in _pieces(batch, most_chars):
                columns = {name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)}
                out: list[tuple] = []
                for row in function(columns, *args):
                    out.append(row)
                    if len(out) >= rows:
                        yield _to_batch(out, arrow)
                        out = []
                if out:
                    yield _to_batch(out, arrow)
        give_back()

    _ship(df.sparkSession)
    return df.mapInArrow(batches, schema)


def give_back() -> None:
    """What the allocators of a worker keep beyond its task goes back to the machine; workers are used again."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # Not the C library that has it.


def _pieces(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    step = max(1, min(batch.num_rows, int(batch.num_rows * most / max(batch.nbytes, 1))))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def _to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _ship(spark: SparkSession) -> None:
    """Python workers of a local session find the package wherever the driver was started."""
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(
            p for p in (environment.get("PYTHONPATH"), ROOT) if p
        )


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
    "binary": T.BinaryType(), "boolean": T.BooleanType(), "longs": T.ArrayType(T.LongType()),
    "ints": T.ArrayType(T.IntegerType()), "doubles": T.ArrayType(T.DoubleType()),
    "strings": T.ArrayType(T.StringType()),
}


def fields(text: str) -> T.StructType:
    """A schema out of ``name type`` pairs; a plural type stands for an array."""
    pairs = [pair.split() for pair in text.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


def map_parts(
    df: DataFrame, function: Callable[..., Iterator[tuple]], schema: T.StructType, *args, rows: int = 4096,
) -> DataFrame:
    """Pass whole partitions, as a stream of column lists, to a function that keeps state between them.

    ``function(parts, *args)`` gets an iterator of dicts of Python lists, in the partition's order.
    """
    arrow = _arrow_schema(schema)

    def batches(source):
        parts = (
            {name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)}
            for batch in source for part in _pieces(batch, 8 << 20)
        )
        out: list[tuple] = []
        for row in function(parts, *args):
            out.append(row)
            if len(out) >= rows:
                yield _to_batch(out, arrow)
                out = []
        if out:
            yield _to_batch(out, arrow)
        give_back()

    _ship(df.sparkSession)
    return df.mapInArrow(batches, schema)


def parts_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
