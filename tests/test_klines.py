import re
from datetime import datetime, timedelta, timezone

import pytest
from conftest import kline_rows
from pyspark.sql import functions as F

from candlemill.functions import times
from candlemill.operators import klines
from candlemill.sinks.tables import write_klines
from candlemill.sources.tables import kline_table

COLUMNS = [
    "symbol", "open_time", "close_time", "open", "high", "low", "close", "volume",
    "quote_volume", "trades_count", "taker_buy_volume", "taker_buy_quote_volume",
]


@pytest.fixture(scope="module")
def table(spark):
    rows = kline_rows(spark, [
        dict(symbol=symbol, open_time=t * 60_000)
        for symbol in ("ETHUSDT", "BTCUSDT", "it's") for t in (3, 1, 2)
    ])
    old = rows.withColumn("close_price", F.lit(0.0)).withColumn("ingested_at", F.timestamp_seconds(F.lit(1)))
    new = rows.withColumn("ingested_at", F.timestamp_seconds(F.lit(2)))
    return old.unionByName(new).cache()


def keys(df):
    return [(r["symbol"], r["open_time"] // 60_000) for r in df.collect()]


def test_one_symbol_is_ordered_by_time_and_renamed(table):
    result = klines.query_klines(table, "BTCUSDT")
    assert result.columns == COLUMNS
    assert keys(result) == [("BTCUSDT", 1), ("BTCUSDT", 2), ("BTCUSDT", 3)]
    assert {r["close"] for r in result.collect()} == {50_050.0}


def test_several_symbols_bounds_and_limit(table):
    both = ["ETHUSDT", "BTCUSDT", "ETHUSDT"]
    assert keys(klines.query_klines(table, both)) == [
        ("BTCUSDT", 1), ("BTCUSDT", 2), ("BTCUSDT", 3), ("ETHUSDT", 1), ("ETHUSDT", 2), ("ETHUSDT", 3)
    ]
    assert keys(klines.query_klines(table, both, start=120_000, end="180000", limit=3)) == [
        ("BTCUSDT", 2), ("BTCUSDT", 3), ("ETHUSDT", 2)
    ]
    assert keys(klines.query_klines(table, "it's", limit=1)) == [("it's", 1)]
    assert keys(klines.query_klines(table, "BTCUSDT", limit=0)) == []


def test_limit_is_a_top_k_plan(table):
    plan = klines.query_klines(table, "BTCUSDT", limit=2)._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan


def test_argument_errors(table):
    for symbols in ([], None):
        with pytest.raises(ValueError, match="no symbols"):
            klines.query_klines(table, symbols)
    for interval in ("1h;DROP TABLE", "h1", "2m"):
        with pytest.raises(ValueError, match="interval"):
            klines.query_klines(table, "BTCUSDT", interval)
    with pytest.raises(ValueError, match="holds nothing"):
        klines.query_batches(table, "BTCUSDT", batch_size=0)
    stream = klines.stream_batches(table, "BTCUSDT", batch_size=0)
    with pytest.raises(ValueError, match="holds nothing"):
        next(stream)


def test_pages_follow_each_other(table):
    names, pages, after = ["BTCUSDT", "ETHUSDT", "it's"], [], None
    while page := keys(klines.page_after(table, names, after=after, page_size=4)):
        pages.append(page)
        after = (page[-1][0], page[-1][1] * 60_000)
    assert [len(p) for p in pages] == [4, 4, 1]
    assert sum(pages, []) == keys(klines.query_klines(table, names))


def test_batches_equal_the_ordered_query(table, monkeypatch):
    monkeypatch.setattr(klines, "STRETCH", 2)
    names = ["BTCUSDT", "ETHUSDT", "it's"]
    rows = klines.query_batches(table, names, batch_size=4).orderBy("batch_id", "symbol", "open_time")
    assert rows.columns == [*COLUMNS, "batch_id"]
    assert [r["batch_id"] for r in rows.collect()] == [0] * 4 + [1] * 4 + [2]
    assert keys(rows) == keys(klines.query_klines(table, names))


def test_stream_yields_local_frames(table):
    frames = list(klines.stream_batches(table, "BTCUSDT", batch_size=2))
    assert [len(f) for f in frames] == [2, 1]
    assert list(frames[0].columns) == COLUMNS and list(frames[0]["open_time"]) == [60_000, 120_000]
    assert list(klines.stream_batches(table, "NONE")) == []


def test_counts_by_symbol(table):
    counted = klines.count_by_symbol(klines.query_klines(table, ["it's", "BTCUSDT"])).collect()
    assert [tuple(r) for r in counted] == [("BTCUSDT", 3), ("it's", 3)]


def test_stored_table_prunes_partitions_and_pushes_filters(spark, tmp_path):
    start, day = 1704067200000, 86_400_000
    rows = kline_rows(spark, [dict(open_time=start + d * day, interval="1d") for d in range(0, 90, 5)])
    write_klines(rows, str(tmp_path / "k"))
    write_klines(rows.withColumn("interval", F.lit("1h")), str(tmp_path / "k"))
    stored = kline_table(spark, str(tmp_path / "k"))
    result = klines.query_klines(stored, "BTCUSDT", "1d", "2024-02-01", "2024-02-29T00:00:00Z")
    assert [r["open_time"] for r in result.collect()] == [
        start + d * day for d in range(35, 60, 5)
    ]
    plan = result._jdf.queryExecution().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "interval" in partition_filters and "month" in partition_filters
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "open_time" in pushed and "symbol" in pushed
    assert sorted(p.name for p in (tmp_path / "k" / "interval=1d").iterdir()) == [
        "month=202401", "month=202402", "month=202403"
    ]


def test_write_rejects_an_unknown_interval_and_ignores_no_rows(spark, tmp_path):
    with pytest.raises(Exception, match="Invalid interval"):
        write_klines(kline_rows(spark, [dict(open_time=0, interval="2m")]), str(tmp_path / "k"))


@pytest.mark.parametrize("value, ms, seconds", [
    ("1704067200000", 1704067200000, 1704067200),
    (1704067200000, 1704067200000, 1704067200),
    (1704067200, 1704067200, 1704067200),
    ("20240101", 20240101, 20240101),
    ("2024-01-01", 1704067200000, 1704067200),
    ("2024-01-01T00:00:00Z", 1704067200000, 1704067200),
    ("2024-01-01T08:00:00+08:00", 1704067200000, 1704067200),
    (datetime(2024, 1, 1), 1704067200000, 1704067200),
    (datetime(2024, 1, 1, 8, tzinfo=timezone(timedelta(hours=8))), 1704067200000, 1704067200),
    ("2024-01-01T10:00:00.900", 1704103200900, 1704103200),
])
def test_time_arguments(value, ms, seconds):
    assert times.kline_time_ms(value) == ms
    assert times.factor_time_s(value) == seconds


def test_bad_time_argument():
    with pytest.raises(ValueError):
        times.kline_time_ms("soon")


def test_period_bounds():
    from datetime import date

    assert times.day_bounds_ms(date(2024, 1, 1)) == (1704067200000, 1704153600000)
    assert times.month_bounds_ms(2024, 12) == (1733011200000, 1735689600000)
    assert times.month_of(1733011200000 - 1) == 202411
    assert times.month_or_edge(10**20) == 999912


def test_interval_table():
    from candlemill.schema import INTERVAL_MS, INTERVALS

    assert len(INTERVALS) == 12 and INTERVAL_MS["12h"] == 43_200_000
    assert None not in INTERVAL_MS and "2m" not in INTERVAL_MS


def test_compaction_keeps_rows_appended_meanwhile(spark, tmp_path, monkeypatch):
    from candlemill.sinks import tables
    from candlemill.sources.tables import kline_table

    path = str(tmp_path / "a b" / "k")
    row = dict(interval="1h", symbol="A")
    write_klines(kline_rows(spark, [dict(open_time=0, close_price=1.0, **row)]), path)
    write_klines(kline_rows(spark, [dict(open_time=0, close_price=2.0, **row)]), path)
    write = tables._write

    def late(rows, *where):
        monkeypatch.setattr(tables, "_write", write)
        write_klines(kline_rows(spark, [dict(open_time=3_600_000, **row)]), path)
        write(rows, *where)

    monkeypatch.setattr(tables, "_write", late)
    tables.compact_klines(spark, path)
    rows = kline_table(spark, path).orderBy("open_time").collect()
    assert [(r["open_time"], r["close_price"]) for r in rows] == [(0, 2.0), (3_600_000, 50_050.0)]


def stored_days_of(spark, path, days):
    """A stored table, one file per write: candles of two symbols on each day, each day written twice."""
    for day in days:
        rows = [
            {"symbol": s, "open_time": (day * 1440 + m) * 60_000, "line_no": m} for s in ("A", "B") for m in range(0, 1440, 60)
        ]
        for _ in range(2):
            write_klines(kline_rows(spark, rows), path)
    return kline_table(spark, path)


def test_a_page_is_bounded_on_both_sides(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    stored = stored_days_of(spark, str(tmp_path / "k"), (19_700, 19_740, 19_780))
    page = klines.page_after(stored, "A", after=("A", 19_700 * 86_400_000 + 20 * 3_600_000), page_size=5)
    assert [r["open_time"] // 3_600_000 for r in page.collect()] == [
        19_700 * 24 + h for h in (21, 22, 23)] + [19_740 * 24, 19_740 * 24 + 1]
    plan = page._jdf.queryExecution().sparkPlan().toString()
    scans = [scan.split("\n")[0] for scan in plan.split("FileScan")[1:]]
    wide = [scan for scan in scans if "open_price#" in scan.split("] Batched")[0]]
    narrow = [scan for scan in scans if scan not in wide]
    assert len(wide) == 1 and narrow
    assert all("GreaterThan(open_time" in scan or "open_time#" in scan for scan in scans)
    assert all(re.search(r"month#\d+ >= ", scan) for scan in scans)
    # The page's last key reaches the wide scan, as an upper bound and as the last month.
    filters = wide[0].split("DataFilters")[1]
    assert re.search(r"open_time#\d+L <= .*[Ss]ubquery", filters) and re.search(r"month#\d+ <= .*[Ss]ubquery", wide[0])
    both = klines.page_after(stored, ["A", "B"], after=("A", 19_780 * 86_400_000 + 22 * 3_600_000), page_size=3)
    assert [(r["symbol"], r["open_time"] // 3_600_000 % 24) for r in both.collect()] == [("A", 23), ("B", 0), ("B", 1)]
    assert klines.page_after(stored, "A", after=("A", 19_781 * 86_400_000), page_size=5).collect() == []


def test_batches_scan_whole_rows_once(spark, tmp_path):
    stored = stored_days_of(spark, str(tmp_path / "k"), (19_700, 19_740))
    batches = klines.query_batches(stored, ["A", "B"], batch_size=10)
    rows = batches.orderBy("batch_id", "symbol", "open_time").collect()
    assert [r["batch_id"] for r in rows] == [i // 10 for i in range(96)]
    plan = batches._jdf.queryExecution().sparkPlan().toString()
    schemas = [s.split("ReadSchema")[-1] for s in plan.split("FileScan")[1:]]
    assert sum("open_price" in s for s in schemas) == 1


def test_stream_cuts_frames_out_of_arrow_blocks(spark, tmp_path):
    stored = stored_days_of(spark, str(tmp_path / "k"), (19_700, 19_740))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        frames = list(klines.stream_batches(stored, ["A", "B"], batch_size=20))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [len(f) for f in frames] == [20] * 4 + [16]
    together = [(s, t) for f in frames for s, t in zip(f["symbol"], f["open_time"], strict=True)]
    assert together == sorted(together) and len(set(together)) == 96
    assert list(frames[0].columns) == COLUMNS
