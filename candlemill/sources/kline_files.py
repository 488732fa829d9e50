"""Zipped kline CSVs: list, unzip, split, type.

Only unzipping runs in Python, one archive at a time and block by block; cutting into lines and everything
after it is column work. Executors reach archives through Spark alone (``binaryFile``), so they may lie
wherever Spark can read.
"""

from __future__ import annotations

import codecs
import re
import zipfile
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlemill.functions.numbers import NUMBER
from candlemill.operators.existing import described_files, filter_files
from candlemill.schema import CSV_FIELDS, KLINE, LONG_FIELDS, MISSING_TEXT
from candlemill.sources.paths import below_regex, exists, last_segment, require_folder

BLOCKS = "src_path string, symbol string, interval string, first_no long, text string, error string"
# Bytes of a CSV handed to Spark at a time.
BLOCK_BYTES = 1 << 20
_FILLED_LINE = re.compile(rb"[^\n]*\S[^\n]*")


# -------------------------------------------------------------------- listing

def archive_files(spark: SparkSession, folder: str, pattern: str = "**/*.zip") -> DataFrame:
    """Archives below a folder that match a pattern, as (src_path, content).

    ``src_path`` comes from file metadata: a condition on it, or on anything made from
    it, decides which files Spark opens, and without ``content`` none is opened.
    """
    root = require_folder(spark, folder)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", last_segment(pattern))
        .load(root)
        .select(F.col("_metadata.file_path").alias("src_path"), "content")
        .filter(F.col("src_path").rlike(below_regex(root, pattern)))
    )


def archives_at(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The archives at these paths, with the fields their names carry."""
    files = spark.read.format("binaryFile").load(paths)
    return described_files(files.select(F.col("_metadata.file_path").alias("src_path"), "content"))


def list_archives(
    spark: SparkSession,
    folder: str,
    symbols: list[str] | None = None,
    intervals: list[str] | None = None,
    pattern: str = "**/*.zip",
) -> DataFrame:
    """Archives with the fields their names carry, filtered by symbol and interval."""
    archives = archive_files(spark, folder, pattern)
    return filter_files(described_files(archives), symbols, intervals)


# ------------------------------------------------------------------- unzipping

def unzip_lines(archives: DataFrame) -> DataFrame:
    """Non-blank lines of the first CSV member of each archive, numbered from 0.

    An archive that cannot be read to its end gives a row with ``error``; one without a
    CSV member gives nothing. Python hands on blocks of text that end with a line; they are cut into
    lines here.
    """
    blocks = archives.select("src_path", "symbol", "interval", "content").mapInArrow(_unzipped, BLOCKS)
    # Blank lines leave before the others are counted, as they did in the block's first number.
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"\S"))
    each = F.when(F.col("error").isNull(), lines).otherwise(F.array(F.lit(None).cast("string")))
    return blocks.select(
        "src_path", "symbol", "interval", "first_no", "error", F.posexplode(each).alias("_place", "line")
    ).select(
        "src_path", "symbol", "interval", (F.col("first_no") + F.col("_place")).alias("line_no"), "line", "error"
    )


def _unzipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for place in range(batch.num_rows):
            path, symbol, interval, content = (column[place] for column in batch.columns)
            own = [path.as_py(), symbol.as_py(), interval.as_py()]
            try:
                for number, text in text_blocks(content.as_buffer()):
                    yield _block([*own, number, text, None])
            except Exception as problem:  # noqa: BLE001 - one bad archive must not end the scan
                yield _block([*own, -1, None, f"{type(problem).__name__}: {problem}"])


def _block(values: list) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
    names = ("src_path", "symbol", "interval", "first_no", "text", "error")
    return pa.RecordBatch.from_arrays(
        [pa.array([value], kind) for value, kind in zip(values, kinds, strict=True)], names=list(names)
    )


def text_blocks(content) -> Iterator[tuple[int, str]]:
    """(number of the first non-blank line, text) of a zip's first CSV, in blocks of whole lines."""
    with zipfile.ZipFile(pa.BufferReader(content)) as archive:
        wanted = next((info for info in archive.infolist() if info.filename.endswith(".csv")), None)
        if wanted is None:
            return
        with archive.open(wanted) as member:
            number, rest = 0, member.read(BLOCK_BYTES).removeprefix(codecs.BOM_UTF8)
            while rest:
                more = member.read(BLOCK_BYTES)
                end = rest.rfind(b"\n") + 1 if more else len(rest)
                if end:
                    block = rest[:end].replace(b"\r\n", b"\n").replace(b"\r", b"\n")
                    yield number, block.decode("utf-8")
                    number += sum(1 for _ in _FILLED_LINE.finditer(block))
                rest = rest[end:] + more


# ---------------------------------------------------------------------- typing

_MISSING = "|".join(re.escape(text) for text in MISSING_TEXT)
_NUMBER_OR_MISSING = f"(?:{NUMBER}|{_MISSING})"


def _line_pattern() -> str:
    """A whole line with a number in every long cell, and a number or nothing in the doubles.

    Cells behind the last long one may be absent; the twelfth may hold anything.
    """
    pattern, tail = "", ""
    needed = max(CSV_FIELDS.index(name) for name in LONG_FIELDS)
    for place, name in enumerate(CSV_FIELDS):
        if name == "ignore":
            cell = "[^,]*"
        else:
            cell = NUMBER if name in LONG_FIELDS else _NUMBER_OR_MISSING
        if place <= needed:
            pattern += cell if place == 0 else f",{cell}"
        else:
            pattern, tail = f"{pattern}(?:,{cell}", tail + ")?"
    return f"^{pattern}{tail}$"


KLINE_LINE = _line_pattern()
# A first line that does not start like this is a header.
_NUMBER_FIRST = f'^"?{_NUMBER_OR_MISSING}"?(?:,|$)'


def typed_lines(lines: DataFrame) -> DataFrame:
    """Twelve fields by position, typed, with ``bad`` for a line that spoils its file.

    A leading header line is left out. Empty or NA-like cells are missing: NaN in the
    double columns, bad in the long ones, and so is a number that fits no long; a fraction is
    cut off. One pattern judges the line as a whole. Other columns pass through.
    """
    line = F.regexp_replace("line", '"', "")
    readable = F.col("error").isNull() & F.coalesce(F.col("_line").rlike(KLINE_LINE), F.lit(False))
    values, unfit = [], []
    for field in KLINE.fields:
        if field.name not in CSV_FIELDS:
            continue
        text = F.get(F.col("_cells"), F.lit(CSV_FIELDS.index(field.name)))
        number = text.try_cast("double")
        if field.name in LONG_FIELDS:
            value = F.coalesce(text.try_cast("long"), number.try_cast("long"))
            unfit.append(value.isNull())
        else:
            value = F.coalesce(number, F.lit(float("nan")))
        values.append(value.alias(field.name))
    kept = [c for c in lines.columns if c != "line"]
    header = (F.col("line_no") == 0) & ~F.col("line").rlike(_NUMBER_FIRST)
    return (
        lines.filter(~F.coalesce(header, F.lit(False)))
        .select(*kept, line.alias("_line"))
        .select(*kept, F.split("_line", ",").alias("_cells"), (~readable).alias("bad"))
        .select(*kept, *values, reduce(Column.__or__, unfit, F.col("bad")).alias("bad"))
    )


def good_rows(typed: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """Rows of files without a single bad line, in the kline layout with their origin.

    A run that has stored its ``rejected`` files hands them in. Otherwise lines are judged and read in one
    pass: a file's lines meet in one task, as they did when it was unzipped, and spill where they must.
    """
    if rejected is None:
        file = Window.partitionBy("src_path")
        judged = typed.withColumn("_spoiled", F.max("bad").over(file)).filter("NOT _spoiled")
        return judged.select(*KLINE.names, "src_path", "line_no")
    spoiled = rejected.select("src_path").distinct()
    return typed.join(spoiled, "src_path", "left_anti").select(*KLINE.names, "src_path", "line_no")


def rejected_files(typed: DataFrame) -> DataFrame:
    """Each spoiled file with the reason it was rejected."""
    reason = F.coalesce(
        F.max("error"), F.concat(F.lit("not numeric at line "), F.min("line_no").cast("string"))
    )
    return typed.filter("bad").groupBy("src_path").agg(reason.alias("reason"))


def read_klines(
    spark: SparkSession,
    folder: str,
    symbols: list[str] | None = None,
    intervals: list[str] | None = None,
    pattern: str = "**/*.zip",
    with_path: bool = True,
) -> DataFrame:
    """Rows of all readable archives, each unzipped once; unreadable and non-numeric files are left out.

    ``with_path=False`` gives the candles alone, without file and line.
    """
    rows = good_rows(typed_lines(unzip_lines(list_archives(spark, folder, symbols, intervals, pattern))))
    return rows if with_path else rows.select(*KLINE.names)


def read_archive(
    spark: SparkSession, path: str, symbol: str, interval: str | None = None
) -> DataFrame:
    """Rows of one archive; a missing, damaged or non-numeric one is an error.

    ``interval`` overrides the one in the name.
    """
    if not exists(spark, path):
        raise FileNotFoundError(f"there is no archive {path}")
    archive = described_files(
        spark.read.format("binaryFile").load(path).select(F.col("path").alias("src_path"), "content")
    ).withColumn("symbol", F.lit(symbol))
    if interval is not None:
        archive = archive.withColumn("interval", F.lit(interval))
    elif archive.filter(F.col("interval").isNotNull()).select("src_path").isEmpty():
        raise ValueError(f"the name {path} holds no known interval, and none is given")
    typed = typed_lines(unzip_lines(archive))
    problem = rejected_files(typed).first()
    if problem is not None:
        raise ValueError(f"{path} cannot be used: {problem['reason']}")
    return typed.select(*KLINE.names, "src_path", "line_no")
