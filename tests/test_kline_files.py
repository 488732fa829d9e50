import re

import pyarrow as pa
import pytest
from conftest import HEADER, LINE_1, LINE_2

from candlemill.schema import INTERVALS, KLINE
from candlemill.sources import kline_files as files
from candlemill.sources.paths import below_regex


def read(spark, folder, **options):
    return files.read_klines(spark, str(folder), **options)


def test_plain_archive(spark, tmp_path, zipped):
    zipped(tmp_path, "BTCUSDT-1m-2024-01-01", [LINE_1, LINE_2])
    rows = read(spark, tmp_path).orderBy("line_no").collect()
    assert [r["open_time"] for r in rows] == [1704067200000, 1704067260000]
    assert rows[0].asDict() | {"src_path": ""} == {
        "symbol": "BTCUSDT", "open_time": 1704067200000, "close_time": 1704067259999,
        "open_price": 42000.0, "high_price": 42100.0, "low_price": 41900.0, "close_price": 42050.0,
        "volume": 1000.5, "quote_volume": 42050000.0, "trades_count": 1500,
        "taker_buy_volume": 500.25, "taker_buy_quote_volume": 21000000.0, "interval": "1m",
        "src_path": "", "line_no": 0,
    }
    assert read(spark, tmp_path).columns[:13] == KLINE.names


def test_header_line_is_skipped(spark, tmp_path, zipped):
    zipped(tmp_path, "BTCUSDT-1m-2024-01-01", [HEADER, LINE_1])
    assert [r["line_no"] for r in read(spark, tmp_path).collect()] == [1]


def test_blank_lines_bom_carriage_returns_and_quotes(spark, tmp_path, zipped):
    quoted = ",".join(f'"{cell}"' for cell in LINE_2.split(","))
    zipped(tmp_path, "BTCUSDT-1m-2024-01-01", ["﻿" + LINE_1 + "\r", "", "  ", quoted])
    rows = read(spark, tmp_path).orderBy("line_no").collect()
    assert [(r["line_no"], r["open_time"]) for r in rows] == [(0, 1704067200000), (1, 1704067260000)]


def test_empty_archives_give_nothing(spark, tmp_path, zipped):
    zipped(tmp_path, "BTCUSDT-1m-2024-01-01", None)
    zipped(tmp_path, "BTCUSDT-1m-2024-01-02", [LINE_1], member="readme.txt")
    assert read(spark, tmp_path).count() == 0


BAD_LINES = {
    "A": LINE_1.replace("42100.00", "x1"),
    "B": LINE_1.replace(",1500,", ",,"),
    "C": LINE_1.replace("1704067259999", "NA"),
    "D": LINE_1.replace("42100.00", "1.5d"),
    "E": LINE_1 + ",7",
    "F": "1704067200000,1,2",
    "G": LINE_1.replace("42100.00", " "),
    "H": LINE_1.replace("1704067259999", "99999999999999999999"),
}


def test_bad_cell_rejects_the_whole_file(spark, tmp_path, zipped):
    for symbol, line in BAD_LINES.items():
        zipped(tmp_path, f"{symbol}-1m-2024-01-01", [LINE_2, line])
    zipped(tmp_path, "ETHUSDT-1m-2024-01-01", [LINE_1])
    assert {r["symbol"] for r in read(spark, tmp_path).collect()} == {"ETHUSDT"}
    typed = files.typed_lines(files.unzip_lines(files.list_archives(spark, str(tmp_path))))
    rejected = files.rejected_files(typed).collect()
    assert {r["src_path"].split("/")[-1][0] for r in rejected} == set(BAD_LINES)
    assert {r["reason"] for r in rejected} == {"not numeric at line 1"}


def test_missing_doubles_are_kept_as_nan(spark, tmp_path, zipped):
    line = LINE_1.replace("42050000.00", "").replace("500.25", "null")
    short = ",".join(LINE_2.split(",")[:9])
    zipped(tmp_path, "BTCUSDT-1m-2024-01-01", [line, short])
    first, second = read(spark, tmp_path).orderBy("line_no").collect()
    assert first["quote_volume"] != first["quote_volume"]
    assert first["taker_buy_volume"] != first["taker_buy_volume"]
    assert second["trades_count"] == 1800 and second["taker_buy_volume"] != second["taker_buy_volume"]


def test_number_spellings(spark, tmp_path, zipped):
    line = LINE_1.replace("42100.00", "4.21e4").replace("1500", "1500.0").replace("42000.00", "+42000.")
    zipped(tmp_path, "BTCUSDT-1m-2024-01-01", [line, LINE_2.replace("50430000.00", "inf")])
    first, second = read(spark, tmp_path).orderBy("line_no").collect()
    assert (first["high_price"], first["trades_count"], first["open_price"]) == (42100.0, 1500, 42000.0)
    assert second["quote_volume"] == float("inf")


def test_corrupt_archive_is_skipped_in_a_scan_and_an_error_alone(spark, tmp_path, zipped):
    zipped(tmp_path, "ETHUSDT-1m-2024-01-01", [LINE_1])
    broken = tmp_path / "BTCUSDT-1m-2024-01-01.zip"
    broken.write_text("not a zip")
    assert {r["symbol"] for r in read(spark, tmp_path).collect()} == {"ETHUSDT"}
    with pytest.raises(ValueError, match="cannot be used"):
        files.read_archive(spark, str(broken), "BTCUSDT")
    with pytest.raises(FileNotFoundError):
        files.read_archive(spark, str(tmp_path / "none-1m-2024-01-01.zip"), "BTCUSDT")


def test_damaged_member_rejects_the_file(spark, tmp_path, zipped):
    path = zipped(tmp_path, "BTCUSDT-1m-2024-01-01", [LINE_1] * 3)
    content = bytearray(open(path, "rb").read())
    content[content.index(b"42100.00")] ^= 1
    open(path, "wb").write(bytes(content))
    assert read(spark, tmp_path).count() == 0


def test_single_archive_with_interval_override(spark, tmp_path, zipped):
    path = zipped(tmp_path, "BTCUSDT-1m-2024-01-01", [LINE_1])
    assert files.read_archive(spark, path, "X", interval="5m").first()["interval"] == "5m"
    assert files.read_archive(spark, path, "X").first()["symbol"] == "X"
    odd = zipped(tmp_path, "BTCUSDT", [LINE_1])
    with pytest.raises(ValueError, match="interval"):
        files.read_archive(spark, odd, "BTCUSDT")


def test_filters_and_unknown_intervals(spark, tmp_path, zipped):
    for name in ("BTCUSDT-1m-2024-01-01", "BTCUSDT-1h-2024-01-01", "ETHUSDT-1d-2024-01-01",
                 "BTCUSDT-2m-2024-01-01", "BTCUSDT", "-1m-2024-01-01"):
        zipped(tmp_path / "deep" / "er", name, [LINE_1])

    def found(**options):
        rows = read(spark, tmp_path, **options).select("symbol", "interval").collect()
        return sorted((r["symbol"], r["interval"]) for r in rows)

    assert found() == [("BTCUSDT", "1h"), ("BTCUSDT", "1m"), ("ETHUSDT", "1d"), ("UNKNOWN", "1m")]
    assert found(symbols=["BTCUSDT"]) == [("BTCUSDT", "1h"), ("BTCUSDT", "1m")]
    assert found(symbols=[""]) == [("", "1m")]
    assert found(intervals=["1m", "1h"], symbols=["BTCUSDT", "ETHUSDT"]) == [
        ("BTCUSDT", "1h"), ("BTCUSDT", "1m")]
    assert found(symbols=[]) == []
    assert found(pattern="**/*-1d-2024-01-01.zip") == [("ETHUSDT", "1d")]
    assert found(pattern="*.zip") == []
    assert len(found(pattern="deep/*/*.zip")) == 4


def test_folder_errors(spark, tmp_path, zipped):
    with pytest.raises(FileNotFoundError):
        read(spark, tmp_path / "none")
    with pytest.raises(ValueError, match="a folder is needed"):
        read(spark, zipped(tmp_path, "BTCUSDT-1m-2024-01-01", [LINE_1]))


def test_excluded_files_are_not_opened(spark, tmp_path, zipped):
    zipped(tmp_path, "BTCUSDT-1m-2024-01-01", [LINE_1])
    (tmp_path / "ETHUSDT-1m-2024-01-01.zip").write_bytes(b"x" * 5000)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 1000)
    try:
        rows = read(spark, tmp_path, symbols=["BTCUSDT"]).collect()
        assert [r["symbol"] for r in rows] == ["BTCUSDT"]
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1 << 20])
def test_lines_keep_numbers_across_blocks(tmp_path, zipped, monkeypatch, size):
    monkeypatch.setattr(files, "BLOCK_BYTES", size)
    lines = ["a", "b\r", "", " \t", "ce", "d", "é", "f"]
    content = open(zipped(tmp_path, "A-1m-2024-01-01", lines), "rb").read()
    found = []
    for number, text in files.text_blocks(pa.py_buffer(content)):
        assert text.endswith("\n") or size > 100
        kept = [line for line in text.split("\n") if re.search(r"\S", line, re.ASCII)]
        found += list(enumerate(kept, number))
    assert found == list(enumerate(["a", "b", "ce", "d", "é", "f"]))


def test_archives_are_read_once(spark, tmp_path, zipped):
    zipped(tmp_path, "A-1m-2024-01-01", [LINE_1, LINE_2])
    zipped(tmp_path, "B-1m-2024-01-01", [LINE_1, "x,y"])
    rows = read(spark, tmp_path)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    assert rows.count() == 2
    assert files.read_klines(spark, str(tmp_path), with_path=False).columns == KLINE.names


NAMES = {
    "X-1h-2024-01-01.zip": ("X", "1h", "2024-01-01", False),
    "X-1h-2025-01.zip": ("X", "1h", "2025-01-01", True),
    "X-1h-2024-13-45.zip": ("X", "1h", None, False),
    "X-1h-2024-02-31.zip": ("X", "1h", "2024-02-01", False),
    "X-1h.zip": ("X", "1h", None, False),
    "X.zip": ("X", None, None, False),
    ".zip": (".zip", None, None, False),
    "random.txt": ("random", None, None, False),
    "X-1h-2024-01-01-extra.zip": ("X", "1h", "2024-01-01", False),
    "a.b-1h-2024-01.zip": ("a.b", "1h", "2024-01-01", True),
    "-1h-2024-01-01.zip": ("UNKNOWN", "1h", "2024-01-01", False),
    **{f"/p/X-{i}-2024-01-01.zip": ("X", i, "2024-01-01", False) for i in INTERVALS},
}


def test_fields_in_names(spark):
    from candlemill.operators.existing import described_files

    names = spark.createDataFrame([(name,) for name in NAMES], "src_path string")
    rows = described_files(names).collect()
    assert {r["src_path"]: (r["symbol"], r["interval"], r["date"], r["monthly"]) for r in rows} == NAMES


@pytest.mark.parametrize("pattern, path, matches", [
    ("**/*.zip", "a.zip", True), ("**/*.zip", "x/y/a.zip", True), ("*.zip", "x/a.zip", False),
    ("x/**/*.zip", "x/a.zip", True), ("**/*-1h-?.zip", "q/A-1h-1.zip", True),
    ("[!a]*.zip", "b.zip", True), ("[!a]*.zip", "a.zip", False),
])
def test_patterns(pattern, path, matches):
    expected = re.compile(below_regex("file:///data", pattern))
    assert bool(expected.search(f"file:/data/{path}")) is matches
    assert bool(expected.search(f"/data/{path}")) is matches
    assert not expected.search(f"/elsewhere/{path}")


def test_long_cells_of_any_length_are_judged_by_the_cast(spark, tmp_path, zipped):
    wide = LINE_1.replace(",1500,", ",1234567890123456789,")
    zipped(tmp_path, "BTCUSDT-1m-2024-01-01", [wide, LINE_2])
    zipped(tmp_path, "ETHUSDT-1m-2024-01-01", [LINE_1.replace(",1500,", ",12345678901234567890,")])
    rows = read(spark, tmp_path).collect()
    assert sorted(r["trades_count"] for r in rows) == [1800, 1234567890123456789]
