import csv
import io
import random
from datetime import datetime, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlemill import MarketStore
from candlemill.operators import factors
from candlemill.plans import factor_ingest
from candlemill.plans.factor_ingest import ingest_factors
from candlemill.sources import factor_files
from candlemill.sources.tables import factor_table

CSV = (
    "time,CapMrktEstUSD,ReferenceRate,Note\n"
    "2026-02-15,139059502.2038,0.6328712519,ok\n"
    "2026-02-16,,0.6522499227,bad\n"
    "2026-02-17,not-a-number,0.6492553905,test\n"
)


@pytest.fixture
def tree(tmp_path):
    def write(**texts):
        folder = tmp_path / "tree" / "csv" / "sub"
        folder.mkdir(parents=True, exist_ok=True)
        for name, text in texts.items():
            (folder / f"{name}.csv").write_text(text)
        return str(tmp_path / "tree")

    return write


def test_wide_file_to_rows(spark, tree):
    lines = factor_files.factor_lines(spark, tree(btc=CSV))
    coerced = factors.coerce_factors(factor_files.factor_cells(lines))
    rows = factors.factor_rows(coerced)
    assert rows.columns == ["symbol", "datetime", "factor_name", "factor_value", "source"]
    found = {(r["datetime"].day, r["factor_name"]): r["factor_value"] for r in rows.collect()}
    assert found == {
        (15, "CapMrktEstUSD"): 139059502.2038, (15, "ReferenceRate"): 0.6328712519,
        (16, "ReferenceRate"): 0.6522499227, (17, "ReferenceRate"): 0.6492553905,
    }
    assert {(r["symbol"], r["source"]) for r in rows.collect()} == {("btc", "coinmetrics")}
    assert factors.drop_stats(coerced).first().asDict() == {
        "symbol": "btc", "cells": 9, "rows_kept": 4, "dropped_non_numeric": 5
    }


def test_ingest_isolates_bad_files(spark, tree, tmp_path):
    folder = tree(
        btc=CSV, eth="﻿time,A,\"B, C\"\r\n2026-01-31T00:00:00Z,inf,\"2\"\r\n\r\nnever,1,2\r\n",
        bad="when,A\n2026-01-01,1\n", long="time,A\n2026-01-01,1,2\n", only="time\n2026-01-01\n",
        blank="\n \n", ETH="time,A\n2026-01-01,7\n",
    )
    path = str(tmp_path / "factors")
    dry = ingest_factors(spark, folder, path, dry_run=True)
    assert (dry.read, dry.stored, dry.refused) == (4, 0, 3)
    assert factor_table(spark, path).count() == 0
    done = ingest_factors(spark, folder, path)
    assert done == type(done)(
        read=4, refused=3, stored=7, left_out=7
    )
    stored = factor_table(spark, path)
    assert stored.select("update_time").distinct().count() == 1
    eth = {r["factor_name"]: r["factor_value"] for r in stored.filter("symbol = 'eth'").collect()}
    assert eth == {"A": float("inf"), "B, C": 2.0}
    one = ingest_factors(spark, folder, str(tmp_path / "one"), symbols=["BTC", "ETH"])
    assert one.read + one.refused == 2 and one.stored == 6


def test_unpivot_checks_its_columns(spark):
    frame = spark.createDataFrame([("x", 1.0)], "symbol string, a double")
    with pytest.raises(ValueError, match="time"):
        factors.unpivot_factors(frame, ["symbol"])
    bare = spark.createDataFrame([("x", "2024-01-01")], "symbol string, time string")
    assert factors.unpivot_factors(bare, ["symbol"]).count() == 0


WRITE = {
    "symbol": ["BTC"] * 4, "datetime": ["2024-01-01T00:00:00Z"] * 4, "factor_name": ["p"] * 4,
    "factor_value": [None, float("nan"), float("inf"), 42500.5],
}


def test_write_back(spark, tmp_path):
    store = MarketStore(spark, str(tmp_path))
    assert store.write_factors(pd.DataFrame(WRITE), source=" sdk-test ") == 1
    row = store.get_factors("BTC", "p").first()
    assert row.asDict() == {
        "symbol": "BTC", "datetime": datetime(2024, 1, 1), "factor_name": "p", "factor_value": 42500.5
    }
    stored = factor_table(spark, store.factors_path).first()
    assert stored["source"] == "sdk-test" and stored["update_time"] is not None
    dropped = spark.createDataFrame([("B", "soon", "p", "abc")], list(WRITE))
    assert store.write_factors(dropped) == 0


def test_write_back_errors_write_nothing(spark, tmp_path):
    store = MarketStore(spark, str(tmp_path))
    good = ("BTC", "2024-01-01", "p", "1")

    def frame(*rows):
        return spark.createDataFrame([good, *rows], "symbol string, datetime string, factor_name string, factor_value string")

    for data, source, text in [
        ([1], "sdk", "Spark or pandas frame"),
        (frame().filter("false"), "sdk", "no rows to write"),
        (frame(), " ", "named source"),
        (frame().drop("factor_value", "datetime"), "sdk", "absent: datetime, factor_value"),
        (frame((" ", "2024-01-01", "p", "1")), "sdk", "unusable symbol"),
        (frame((None, "2024-01-01", "p", "abc")), "sdk", "unusable symbol"),
        (frame(("B", "2024-01-01", "", "1")), "sdk", "unusable factor_name"),
        (frame(("B", "soon", "p", "1")), "sdk", "unusable datetime"),
        (frame(("B", None, "p", "1")), "sdk", "unusable datetime"),
    ]:
        with pytest.raises(ValueError, match=text):
            store.write_factors(data, source)
    assert factor_table(spark, store.factors_path).count() == 0


def test_number_and_time_spellings(spark):
    numbers = {
        "42.5": 42.5, "1_000": 1000.0, " 42 ": 42.0, ".5": 0.5, "5.": 5.0, "1e3": 1000.0,
        "1e5_0": 1e50, "-0.1E-2": -0.001,
        "1.5d": None, "0x1p3": None, "1e": None, "_1": None, "1__0": None, "1,000": None,
        "inf": None, "nan": None, "": None,
    }
    at = datetime(2024, 1, 1)
    moments = {
        "1704067200": at, "1704067200000": at, "20240101": datetime(1970, 8, 23, 6, 15, 1),
        "2024-01-01": at, "2024-01-01T00:00:00Z": at, "2024-01-01T08:00:00+08:00": at,
        "2024-01-01 00:00": at, "2024-01-01T00:00Z": at, "1704067200123": at.replace(microsecond=123000),
        "2024-01-01T00:00:00.123456": at.replace(microsecond=123000),
        "2024": datetime(1970, 1, 1, 0, 33, 44), "2024-01": None, "soon": None, "2024-02-31": None, "1.5": None, "99999999999999999": None,
    }
    frame = spark.createDataFrame(
        [(f"n{t}", "2024-01-01", "f", t) for t in numbers] + [(f"t{t}", t, "f", "1") for t in moments],
        list(WRITE),
    )
    judged = {r["symbol"]: r for r in factors.judged_write_rows(frame).collect()}
    assert {t: judged[f"n{t}"]["factor_value"] for t in numbers} == numbers
    assert {t: judged[f"t{t}"]["datetime"] for t in moments} == moments
    assert judged["n1,000"]["fault"] == "dropped" and judged["tsoon"]["fault"] == "datetime"


@pytest.mark.parametrize("value, kind, expected", [
    (1704067200, "long", datetime(2024, 1, 1)), (1704067200500, "long", datetime(2024, 1, 1, 0, 0, 0, 500000)),
    (1704067200.0, "double", None), (datetime(2024, 1, 1, 5), "timestamp", datetime(2024, 1, 1, 5)),
    (datetime(2024, 1, 1, 5), "timestamp_ntz", datetime(2024, 1, 1, 5)),
    (datetime(2024, 1, 1).date(), "date", datetime(2024, 1, 1)),
])
def test_typed_times(spark, value, kind, expected):
    frame = spark.createDataFrame(
        [("s", value, "f", 1.0)], f"symbol string, datetime {kind}, factor_name string, factor_value double"
    )
    assert factors.judged_write_rows(frame).first()["datetime"] == expected


@pytest.fixture(scope="module")
def versions(spark):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [
        ("BTCUSDT", at, "price_usd", 1.0, "old", at.replace(hour=1)),
        ("BTCUSDT", at, "price_usd", 42500.50, "new", at.replace(hour=2)),
        ("BTCUSDT", at, "volume", 1234567.89, "new", at),
        ("ETHUSDT", at, "price_usd", 2250.75, "new", at),
        ("ETHUSDT", at.replace(hour=10, microsecond=500_000), "price_usd", 3.0, "new", at),
    ]
    schema = "symbol string, datetime timestamp, factor_name string, factor_value double, source string, update_time timestamp"
    return spark.createDataFrame(rows, schema).cache()


def test_long_query_is_latest_ordered_and_inclusive(versions):
    names = ["price_usd", "volume"]
    rows = factors.query_factors(versions, ["ETHUSDT", "BTCUSDT"], names, 1704067200, "2024-01-01T10:00:00.900")
    assert [(r[0], r[2], r[3]) for r in rows.collect()] == [
        ("BTCUSDT", "price_usd", 42500.5), ("BTCUSDT", "volume", 1234567.89), ("ETHUSDT", "price_usd", 2250.75),
    ]
    assert factors.query_factors(versions, "ETHUSDT", "price_usd", "2024-01-01T10:00:00").count() == 1
    assert factors.query_factors(versions, "ETHUSDT", "price_usd", end="2024-01-01").count() == 1


def test_wide_query_has_the_requested_columns(versions):
    wide = factors.query_factors(
        versions, ["BTCUSDT", "ETHUSDT"], ["volume", "price_usd", "none"], end="2024-01-01", format="WIDE"
    )
    assert wide.columns == ["symbol", "datetime", "volume", "price_usd", "none"]
    assert [tuple(r)[2:] for r in wide.collect()] == [(1234567.89, 42500.5, None), (None, 2250.75, None)]
    back = wide.unpivot(["symbol", "datetime"], ["volume", "price_usd"], "factor_name", "factor_value")
    long = factors.query_factors(versions, ["BTCUSDT", "ETHUSDT"], ["volume", "price_usd"], end="2024-01-01")
    assert back.dropna().select(*long.columns).exceptAll(long).count() == 0


def test_query_argument_errors(versions):
    for symbols, names, form, text in [
        ([], "p", "long", "no symbols"), ("B", [], "long", "no factor names"), ("B", "p", "tall", "format 'tall'"),
    ]:
        with pytest.raises(ValueError, match=text):
            factors.query_factors(versions, symbols, names, format=form)


def test_coverage(versions):
    rows = {tuple(r)[:3] for r in factors.coverage(versions).collect()}
    assert rows == {("BTCUSDT", "new", 2), ("ETHUSDT", "new", 2)}


def test_month_is_pruned(spark, versions, tmp_path):
    from candlemill.sinks.tables import compact_factors, write_factors

    later = versions.withColumn("datetime", F.expr("datetime + interval 60 days"))
    write_factors(versions.unionByName(later), str(tmp_path / "f"))
    rows = factors.query_factors(
        factor_table(spark, str(tmp_path / "f")), "BTCUSDT", ["price_usd", "volume"], "2024-02-01"
    )
    assert rows.count() == 2
    compact_factors(spark, str(tmp_path / "f"))
    assert factor_table(spark, str(tmp_path / "f")).count() == 8
    assert "month" in rows._jdf.queryExecution().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_times_with_any_fraction_and_slashes(spark):
    from candlemill.functions.times import from_iso_text

    texts = {
        "2024-01-01T00:00:00.000000000Z": "2024-01-01 00:00:00", "2024/01/03": "2024-01-03 00:00:00",
        "2024-01-01 00:00:00.1234567": "2024-01-01 00:00:00.123456", "2024/01-03": None, "2024-1-3": None,
    }
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["m"] for r in frame.select("t", from_iso_text(F.col("t")).cast("string").alias("m")).collect()}
    assert got == texts


def test_truths_and_repeated_headers_of_a_file(spark, tree, tmp_path):
    folder = tree(
        a="time,A,A,B,C,A\n2024-01-01T00:00:00.000000000Z,1,2,True,True,3\n2024/01/02,4,5,,x,6\n"
          "2024-01-03,7,8,False,False,9\n"
    )
    path = str(tmp_path / "f")
    ingest_factors(spark, folder, path)
    got = {(r["datetime"].day, r["factor_name"]): r["factor_value"] for r in factor_table(spark, path).collect()}
    assert got == {
        (1, "A"): 1, (1, "A.1"): 2, (1, "A.2"): 3, (1, "B"): 1, (2, "A"): 4, (2, "A.1"): 5, (2, "A.2"): 6,
        (3, "A"): 7, (3, "A.1"): 8, (3, "A.2"): 9, (3, "B"): 0,
    }


def test_write_back_of_nanosecond_times_and_unicode_blanks(spark, tmp_path):
    import pandas as pd

    store = MarketStore(spark, str(tmp_path))
    times = pd.to_datetime(["2024-01-01T00:00:00.123456789", "2024-01-02"], format="ISO8601")
    frame = pd.DataFrame({"symbol": "B", "datetime": times, "factor_name": "p", "factor_value": [1.0, 2.0]})
    assert store.write_factors(frame) == 2
    assert factor_table(spark, store.factors_path).agg(F.min("datetime")).first()[0] == datetime(2024, 1, 1, 0, 0, 0, 123000)
    blank = spark.createDataFrame([(" ", "2024-01-01", "p", "1")], list(WRITE))
    with pytest.raises(ValueError, match="unusable symbol"):
        store.write_factors(blank)


def test_what_is_written_is_what_was_checked(spark, tmp_path):
    store = MarketStore(spark, str(tmp_path))
    frame = spark.range(400).select(
        F.lit("B").alias("symbol"), F.col("id").alias("datetime"), F.lit("p").alias("factor_name"),
        F.when(F.rand() < 0.5, F.lit("1")).otherwise("none").alias("factor_value"),
    )
    assert store.write_factors(frame) == factor_table(spark, store.factors_path).count()


def test_empty_files_count_and_unwanted_ones_stay_unopened(spark, tree, tmp_path):
    folder = tree(btc=CSV, eth=CSV, none="")
    done = ingest_factors(spark, folder, str(tmp_path / "f"))
    assert (done.read, done.refused) == (2, 1)
    plan = factor_files.factor_lines(spark, folder, ["btc"])._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in plan.split("DataFilters: [")[1].split("], Format")[0]


def quoted_file(source):
    """Random cells with commas, quotes and line breaks, some quotes in the middle of a cell."""
    pieces = ["a", "7", ",", "\n", '"', "", " ", "é", ",\n"]
    rows = []
    for _ in range(source.randint(1, 12)):
        cells = []
        for _ in range(3):
            text = "".join(source.choice(pieces) for _ in range(source.randint(0, 4)))
            if source.random() < 0.6:
                cells.append('"' + text.replace('"', '""') + '"')
            else:
                plain = text.replace(",", ";").replace("\n", "_")
                cells.append(plain if not plain.startswith('"') else "x" + plain)
        rows.append(",".join(cells))
    return "h1,h2,h3\n" + "\n".join(rows) + "\n"


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_records_are_those_of_a_csv_reader(spark, size):
    """Lines dealt over blocks of any size; held against the library's own reader."""
    source = random.Random(size)
    texts = {f"f{i}": quoted_file(source) for i in range(40)} | {
        "open": 'h1,h2,h3\n1,"2,3\n4,5,6\n', "plain": "h1,h2,h3\n1,2,3\n", "late": 'h1,h2,h3\n1,5" disk,3\n"4\n",5,6\n',
    }
    lines = [
        (path, path, i // size, i, line) for path, text in texts.items() for i, line in enumerate(text.split("\n"))
    ]
    frame = spark.createDataFrame(lines, "src_path string, symbol string, block long, line_no long, line string")
    read = factor_files.records(frame.repartition(5))
    found = {}
    for r in read.collect():
        found.setdefault(r["src_path"], []).append((r["block"], r["line_no"], r["cells"], r["unclosed"]))
    assert {p for p, rows in found.items() if any(r[3] for r in rows)} == {"open"}
    for path, text in texts.items():
        if path != "open":
            wanted = [row for row in csv.reader(io.StringIO(text, newline="")) if "".join(row).strip() or len(row) > 1]
            assert [r[2] for r in sorted(found[path])] == wanted, text
    assert [tuple(r) for r in factor_files.rejected_factor_files(frame.filter("src_path = 'open'")).collect()] == [
        ("open", factor_files.UNCLOSED)]


TIMES = {
    "iso": (["2024-01-03", "2024-1-3", "2024/01/03 10:30", "01/03/2024"], [3, 3, 3, None]),
    "month first": (["01/03/2024", "1/3/2024 9:05", "13/01/2024", "2024-01-03"], ["1-3", "1-3", None, None]),
    "day first": (["13/01/2024", "01/03/2024", "31-12-2023"], ["1-13", "3-1", "12-31"]),
    "names": (["Jan 3 2024", "February 29, 2024 10:00:00", "Feb 30 2024", "Foo 1 2024"], ["1-3", "2-29", None, None]),
    "day and name": (["3 Jan 2024", "03-Mar-2024", "1 Sept 2024"], ["1-3", "3-3", None]),
    "none": (["never", "2024-01-03", "01/03/2024", "3 Jan 2024"], [None, "1-3", "1-3", "1-3"]),
}


def test_a_file_has_one_form_of_time(spark, tree):
    """The first time cell that is not missing settles how all are read."""
    named = {kind.replace(" ", "_"): texts for kind, (texts, _) in TIMES.items()}
    folder = tree(**{
        name: "v,time\n0,NA\n" + "".join(f'{i},"{text}"\n' for i, text in enumerate(texts)) for name, texts in named.items()
    })
    cells = factor_files.factor_cells(factor_files.factor_lines(spark, folder)).collect()
    for kind, (texts, wanted) in TIMES.items():
        own = [r for r in cells if r["symbol"] == kind.replace(" ", "_")]
        got = {int(r["raw_value"]): r["datetime"] for r in sorted(own, key=lambda r: r["datetime"] is not None)}
        for i, (text, day) in enumerate(zip(texts, wanted, strict=True)):
            shown = got[i] and (got[i].day if isinstance(day, int) else f"{got[i].month}-{got[i].day}")
            assert shown == day, (kind, text)


def test_a_run_reads_its_files_once_and_whole_records(spark, tree, tmp_path, monkeypatch):
    folder = tree(btc='time,A,"no\nte"\n2024-01-01,1,"x\ny"\n2024-01-02,2,"5"\n', eth="time,A\nJan 3 2024,7\n")
    scans = []
    kept = factor_ingest.factor_lines

    def counted(*arguments):
        frame = kept(*arguments)
        scans.append(frame)
        return frame

    monkeypatch.setattr(factor_ingest, "factor_lines", counted)
    done = ingest_factors(spark, folder, str(tmp_path / "f"))
    assert (done.read, done.refused, done.stored, done.left_out) == (2, 0, 4, 1)
    rows = {(r["symbol"], r["factor_name"], r["datetime"].day): r["factor_value"]
            for r in factor_table(spark, str(tmp_path / "f")).collect()}
    assert rows == {("btc", "A", 1): 1.0, ("btc", "A", 2): 2.0, ("btc", "no\nte", 2): 5.0, ("eth", "A", 3): 7.0}
    assert len(scans) == 1 and scans[0]._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_only_files_with_an_open_line_are_walked(spark):
    """Quotes that close within their line need no state of lines; records stored on the way are the same."""
    texts = {
        "closed": 'time,A\n2024-01-01,"1,5"\n2024-01-02,"x, y"\n', "plain": 'time,A\n2024-01-01,5" disk\n',
        "open": 'time,A\n2024-01-01,"x\ny"\n2024-01-02,3\n2024-01-03,"z\n\n"\n2024-01-04,4\n',
    }
    lines = [(p, p, i // 2, i, line) for p, text in texts.items() for i, line in enumerate(text.split("\n"))]
    frame = spark.createDataFrame(lines, "src_path string, symbol string, block long, line_no long, line string")
    stored = {}
    read = factor_files.records(frame, lambda df, name: stored.setdefault(name, df.localCheckpoint()))
    assert {tuple(r) for r in stored["quoted"].collect()} == {("closed", False), ("plain", False), ("open", True)}
    assert {r["src_path"] for r in stored["pieces"].collect()} == {"open"}
    got = {p: [r["cells"] for r in sorted(read.filter(F.col("src_path") == p).collect(), key=lambda r: r["line_no"])]
           for p in texts}
    assert got == {p: list(csv.reader(io.StringIO(text, newline=""))) for p, text in texts.items()}


def test_records_and_cells_are_not_dealt_out_by_file(spark):
    """What is known of a file travels to its records; a large file would else be one key of a join."""
    rows = [("f", "f", 0, i, ["2024-01-01", "True", str(i)], False) for i in range(1, 4)]
    read = spark.createDataFrame(
        [("f", "f", 0, 0, ["time", "A", "B"], False), *rows],
        "src_path string, symbol string, block long, line_no long, cells array<string>, unclosed boolean",
    )
    stored = {}
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cells = factor_files.read_truths(factor_files.factor_cells(read))
        assert "SortMergeJoin" not in cells._jdf.queryExecution().executedPlan().toString()
        # Times are read and stored per record, not behind the explode.
        factor_files.factor_cells(read, materialise=lambda df, name: stored.setdefault(name, df.localCheckpoint()))
        assert stored["timed"].count() == 3 and "datetime" in stored["timed"].columns
        assert {(r["factor_name"], r["raw_value"]) for r in cells.collect()} == {
            ("A", "1"), ("B", "1"), ("B", "2"), ("B", "3")}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


@pytest.fixture
def orders_folder(spark, tmp_path):
    from datetime import timedelta

    rows = [
        (key, key % 7, "FOP"[key % 3], key * 1.5, datetime(1995, 1, 1) + timedelta(days=key), "1-URGENT")
        for key in range(5, 1205)
    ]
    spark.createDataFrame(
        rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(4).selectExpr("int(id) as n_nationkey").write.parquet(str(tmp_path / "nation.parquet"))
    return str(tmp_path)


def test_lines_of_the_check_are_built_without_a_window_per_file(spark, orders_folder):
    from checks import adapters

    lines = adapters.factor_lines(spark, orders_folder)
    assert "Window" not in lines._jdf.queryExecution().optimizedPlan().toString()
    eu = lines.filter("symbol = 'eu_F' and line like '31/12/1999%'").collect()
    assert [r["line_no"] for r in eu] == [(6 + 1) * 10]
    heads = lines.filter("line_no = 0").select("symbol").collect()
    assert sorted(r["symbol"] for r in heads) == sorted(
        [*"FOP", *(f"bad{i}" for i in range(4)), *(f"{kind}_{status}" for kind in ("us", "eu", "name") for status in "FOP")])


def test_rejects_read_stored_records(spark, orders_folder):
    from checks.queries import queries

    found = queries()["factor_rejects"](spark, orders_folder)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Window" not in plan and "Join" not in plan
    assert sorted(tuple(r) for r in found.collect()) == [
        (f"csv/bad{i}.csv", "a line has more cells than the header" if i % 2 else "missing required 'time' column")
        for i in range(4)
    ]
