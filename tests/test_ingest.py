import itertools
import random
import re
from datetime import date, timedelta

import pytest
from conftest import LINE_1, kline_rows, minute_lines
from pyspark.sql import functions as F

from candlemill import MarketStore
from candlemill.operators import existing
from candlemill.plans import ingest as ingest_plan
from candlemill.session import Staging
from candlemill.sinks.ledger import Ledger
from candlemill.sinks.tables import compact_klines, write_klines
from candlemill.sources.markers import is_ingested
from candlemill.sources.tables import kline_table

DAY = 86_400_000
JAN_1 = 1704067200000


def hours(day, count=24, skip=()):
    lines = minute_lines(JAN_1 + day * DAY, count, step=3_600_000)
    return [line for i, line in enumerate(lines) if i not in skip]


def test_ingest_cleans_writes_and_reports(spark, tmp_path, zipped):
    source = tmp_path / "source" / "um"
    lines = hours(0, 10, skip={4, 5})
    zipped(source, "BTCUSDT-1h-2024-01-01", [*lines, lines[0], lines[-1].replace(",50009,", ",-1,")])
    zipped(source, "ETHUSDT-1h-2024-01-01", hours(0, 3))
    zipped(source, "BADUSDT-1h-2024-01-01", ["x,y", "1,2"])
    (source / "ODDUSDT-1h-2024-01-01.zip").write_text("no zip")
    store = MarketStore(spark, str(tmp_path / "store"))
    dry = store.ingest_klines(str(tmp_path / "source"), dry_run=True)
    assert dry.records_written == 0 and kline_table(spark, store.klines_path).count() == 0
    stats = store.ingest_klines(str(tmp_path / "source"))
    assert stats == ingest_plan.IngestStats(
        symbols_processed=2, records_written=13, files_processed=2, files_skipped=0,
        files_rejected=2, duplicates_removed=2, gaps_filled=2, invalid_records_removed=0,
    )
    rows = store.get_klines("BTCUSDT", "1h").collect()
    assert [r["open_time"] for r in rows] == [JAN_1 + h * 3_600_000 for h in range(10)]
    assert rows[4]["volume"] == 0 and rows[4]["open"] == rows[3]["close"]

    stored = kline_table(spark, store.klines_path)
    assert existing.has_data_for_day(stored, "BTCUSDT", "1h", date(2024, 1, 1))
    assert not existing.has_data_for_day(stored, "BTCUSDT", "1h", date(2024, 1, 2))
    assert not existing.has_data_for_day(stored, "BTCUSDT", "1m", date(2024, 1, 1))
    assert not existing.has_data_for_day(stored, "BTCUSDT", "2m", date(2024, 1, 1))
    assert existing.has_data_for_month(stored, "ETHUSDT", "1h", 2024, 1)
    assert not existing.has_data_for_month(stored, "ETHUSDT", "1h", 2023, 12)

    again = store.ingest_klines(str(tmp_path / "source"))
    assert (again.records_written, again.files_skipped) == (0, 2)
    forced = store.ingest_klines(str(tmp_path / "source"), symbols=["ETHUSDT"], force=True)
    assert (forced.records_written, forced.files_skipped) == (3, 0)
    assert kline_table(spark, store.klines_path).count() == 16
    assert store.get_klines("ETHUSDT", "1h").count() == 3

    compact_klines(spark, store.klines_path, F.col("interval") == "1h")
    assert kline_table(spark, store.klines_path).count() == 13
    assert store.get_klines(["ETHUSDT", "BTCUSDT"], "1h").count() == 13


def test_month_file_is_skipped_for_one_stored_day(spark, tmp_path, zipped):
    daily, monthly = tmp_path / "s" / "daily", tmp_path / "s" / "monthly"
    zipped(daily, "A-1h-2024-01-02", hours(1))
    zipped(monthly, "A-1h-2024-01", hours(0, 72))
    zipped(monthly, "B-1h-2024-01", hours(0, 72))
    zipped(monthly, "B-1h-extra", hours(0, 2))
    store = MarketStore(spark, str(tmp_path / "store"))
    stats = store.ingest_klines(str(tmp_path / "s"))
    assert (stats.files_processed, stats.files_skipped, stats.records_written) == (4, 1, 24 + 72 + 2)
    assert store.get_klines("A", "1h").count() == 24


@pytest.mark.parametrize("at_once", [1, 2, 20_000])
def test_stored_archives_stay_unopened_however_many(spark, tmp_path, zipped, monkeypatch, at_once):
    """Wanted archives are read in groups; one that is stored could not be opened any more."""
    monkeypatch.setattr(ingest_plan, "PATHS_AT_ONCE", at_once)
    for day in (1, 2, 3, 4, 5):
        zipped(tmp_path / "s", f"A-1h-2024-01-0{day}", hours(day - 1))
    store = MarketStore(spark, str(tmp_path / "store"))
    assert store.ingest_klines(str(tmp_path / "s"), pattern="**/*-0[12].zip").records_written == 48
    (tmp_path / "s" / "A-1h-2024-01-01.zip").write_text("no archive")
    stats = store.ingest_klines(str(tmp_path / "s"))
    assert (stats.records_written, stats.files_skipped, stats.files_rejected) == (72, 2, 0)
    assert store.ingest_klines(str(tmp_path / "s")).files_skipped == 5


def test_an_archive_in_another_unit_is_rejected(spark, tmp_path, zipped):
    zipped(tmp_path / "s", "A-1h-2024-01-01", hours(0))
    fields = [line.split(",") for line in hours(0, 5)]
    micro = [",".join([f"{f[0]}000", *f[1:6], f"{f[6]}000", *f[7:]]) for f in fields]
    zipped(tmp_path / "s", "B-1h-2024-01-01", micro)
    zipped(tmp_path / "s", "C-1d-2024-01-01", minute_lines(JAN_1, 3, step=DAY))
    store = MarketStore(spark, str(tmp_path / "store"))
    stats = store.ingest_klines(str(tmp_path / "s"))
    assert (stats.records_written, stats.files_rejected) == (27, 1)
    assert store.get_klines("C", "1d").count() == 3


def sequential(files, days):
    """The skip rule as a loop over files in path order."""
    stored, skipped = set(), set()
    for path in sorted(files, key=lambda p: p.split("/")):
        key, period = files[path]
        taken = period is not None and any(
            k == key and d.isoformat().startswith(period) for k, d in stored
        )
        if taken:
            skipped.add(path)
        else:
            stored |= {(key, d) for d in days[path]}
    return skipped


@pytest.mark.parametrize("seed", [1, 2])
def test_skip_within_a_run_equals_a_sequential_pass(spark, seed):
    rng = random.Random(seed)
    first = date(2024, 1, 28)
    files, days = {}, {}
    for number in range(150):
        symbol, folder = rng.choice("AB"), rng.choice(["d", "d-x", "m", "m/n"])
        day = first + timedelta(days=rng.randrange(7))
        kind = rng.choice(["day", "day", "month", "none"])
        name = {"day": day.isoformat(), "month": day.isoformat()[:7], "none": f"x{number}"}[kind]
        path = f"{folder}/{symbol}-1h-{name}.zip" if kind == "none" else f"{folder}/{number % 9}/{symbol}-1h-{name}.zip"
        files[path] = (symbol, None if kind == "none" else name)
        span = 4 if kind == "month" else 1
        days[path] = {day + timedelta(days=rng.randrange(-1, span + 1)) for _ in range(rng.randrange(4))}
    described = existing.described_files(
        spark.createDataFrame([(p,) for p in files], "src_path string")
    ).withColumn("place", existing.path_order(F.col("src_path")))
    pairs = [(p, d) for p, ds in days.items() for d in ds]
    written = spark.createDataFrame(pairs, "src_path string, day date")
    staging = Staging(spark, "test")
    found = existing.skipped_in_run(described, written, staging)
    assert {r["src_path"] for r in found.collect()} == sequential(files, days)
    staging.drop()


def test_markers(spark, tmp_path, zipped):
    data = tmp_path / "data"
    zipped(data / "um", "A-1h-2024-01-01", hours(0))
    zipped(data / "um", "A-1h-2024-01-02", hours(1))
    zipped(data / "um", "A-1h-2024-01", hours(0, 72))
    zipped(data / "um", "A-1d-2024-01-01", [LINE_1])
    for name in ("_SUCCESS__2024-01-01__um__1h", "_SUCCESS__2024-01-01__cm__1h", "_success__2024-01-02__um__1h",
                 "_SUCCESS__2024-01-02__1h", "_SUCCESS__2024-1-02__um__1h", "_SUCCESS__2024-01-02__UM__1h"):
        (data / name).touch()
    store = MarketStore(spark, str(tmp_path / "store"))
    names, stats = store.ingest_pending(str(data))
    assert names == ["_SUCCESS__2024-01-01__cm__1h", "_SUCCESS__2024-01-01__um__1h"]
    assert (stats.records_written, stats.files_processed) == (24, 1)
    assert is_ingested(spark, store.ingested_path, names[0])
    assert not is_ingested(spark, store.ingested_path, "_SUCCESS__2024-01-02__um__1h")
    assert store.ingest_pending(str(data)) == ([], ingest_plan.IngestStats())
    (data / "_SUCCESS__2024-01-02__um__1h").touch()
    names, stats = store.ingest_pending(str(data))
    assert names == ["_SUCCESS__2024-01-02__um__1h"] and stats.records_written == 24


def test_pending_markers_are_ordered(spark):
    names = [f"_SUCCESS__{d}__{m}__{i}" for d, m, i in itertools.product(
        ["2024-01-02", "2024-01-01"], ["um", "cm"], ["1m", "1h"])]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    done = frame.filter("name = '_SUCCESS__2024-01-01__cm__1h'")
    pending = [r["name"] for r in existing.pending_markers(frame, done).collect()]
    assert pending == sorted(set(names) - {"_SUCCESS__2024-01-01__cm__1h"})


def test_stream_takes_each_file_once(spark, tmp_path, zipped):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    zipped(landing, "A-1h-2024-01-01", hours(0))
    zipped(landing / "deep er", "B-1h-2024-01-01", hours(0, 5, skip={2}))
    zipped(landing, "B-2m-2024-01-01", hours(0))
    store = MarketStore(spark, str(tmp_path / "store"))

    def run():
        query = store.stream_ingest(str(landing), checkpoint, files_per_batch=1)
        query.awaitTermination()
        assert query.exception() is None

    run()
    assert store.get_klines(["A", "B"], "1h").count() == 29
    zipped(landing, "A-1h-2024-01-02", hours(1))
    run()
    assert store.get_klines("A", "1h").count() == 48
    assert kline_table(spark, store.klines_path).count() == 53


def test_failed_batch_is_taken_again(spark, tmp_path, zipped, monkeypatch):
    from candlemill.streaming import landing as stream

    zipped(tmp_path / "landing", "A-1h-2024-01-01", hours(0))
    store = MarketStore(spark, str(tmp_path / "store"))
    checkpoint = str(tmp_path / "checkpoint")

    def fail(*_):
        raise RuntimeError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(stream, "ingest_archives", fail)
        with pytest.raises(Exception, match="disk full"):
            store.stream_ingest(str(tmp_path / "landing"), checkpoint).awaitTermination()
    store.stream_ingest(str(tmp_path / "landing"), checkpoint).awaitTermination()
    assert store.get_klines("A", "1h").count() == 24


def half_written(rows, path):
    """A write that dies when half of the day is visible."""
    write_klines(rows.filter("open_time % 7200000 = 0"), path)
    raise RuntimeError("executor lost")


def test_a_stream_batch_that_died_half_way_is_completed(spark, tmp_path, zipped, monkeypatch):
    zipped(tmp_path / "landing", "A-1h-2024-01-01", hours(0))
    store = MarketStore(spark, str(tmp_path / "store"))
    checkpoint = str(tmp_path / "checkpoint")
    with monkeypatch.context() as patch:
        patch.setattr(ingest_plan, "write_klines", half_written)
        with pytest.raises(Exception, match="executor lost"):
            store.stream_ingest(str(tmp_path / "landing"), checkpoint).awaitTermination()
    assert store.get_klines("A", "1h").count() == 12
    store.stream_ingest(str(tmp_path / "landing"), checkpoint).awaitTermination()
    assert store.get_klines("A", "1h").count() == 24


def test_pending_markers_whose_run_died_half_way_are_completed(spark, tmp_path, zipped, monkeypatch):
    data = tmp_path / "data"
    zipped(data, "A-1h-2024-01-01", hours(0))
    (data / "_SUCCESS__2024-01-01__um__1h").touch()
    store = MarketStore(spark, str(tmp_path / "store"))
    with monkeypatch.context() as patch:
        patch.setattr(ingest_plan, "write_klines", half_written)
        with pytest.raises(RuntimeError):
            store.ingest_pending(str(data))
    store.ingest_pending(str(data))
    assert store.get_klines("A", "1h").count() == 24
    assert store.ingest_pending(str(data))[0] == []


def test_a_directory_run_that_died_half_way_is_completed(spark, tmp_path, zipped, monkeypatch):
    """The half-written day counts as stored for nobody; a finished one still does."""
    source = tmp_path / "s"
    zipped(source, "A-1h-2024-01-01", hours(0))
    zipped(source, "B-1h-2024-01-01", hours(0))
    store = MarketStore(spark, str(tmp_path / "store"))
    store.ingest_klines(str(source), symbols=["B"])
    with monkeypatch.context() as patch:
        patch.setattr(ingest_plan, "write_klines", half_written)
        with pytest.raises(RuntimeError):
            store.ingest_klines(str(source))
    assert store.get_klines("A", "1h").count() == 12
    assert not store.has_day("A", "1h", date(2024, 1, 1)) and store.has_day("B", "1h", date(2024, 1, 1))
    assert [r["src_path"][-19:] for r in store.open_files().collect()] == ["A-1h-2024-01-01.zip"]
    stats = store.ingest_klines(str(source))
    assert (stats.records_written, stats.files_skipped) == (24, 1)
    assert store.get_klines("A", "1h").count() == 24
    assert store.has_month("A", "1h", 2024, 1) and not store.has_month("A", "1h", 2024, 2)
    assert not store.has_day("A", "2m", date(2024, 1, 1))
    assert store.open_files().isEmpty() and store.ingest_klines(str(source)).files_skipped == 2


def test_a_run_that_died_before_its_last_entry_is_taken_again(spark, tmp_path, zipped, monkeypatch):
    zipped(tmp_path / "s", "A-1h-2024-01-01", hours(0))
    store = MarketStore(spark, str(tmp_path / "store"))

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "commit", lost)
        with pytest.raises(RuntimeError):
            store.ingest_klines(str(tmp_path / "s"))
    assert store.ingest_klines(str(tmp_path / "s")).records_written == 24
    assert store.get_klines("A", "1h").count() == 24
    assert kline_table(spark, store.klines_path).count() == 48


def test_a_table_without_ledger_is_entered_once(spark, tmp_path, zipped):
    zipped(tmp_path / "s", "A-1h-2024-01-01", hours(0))
    store = MarketStore(spark, str(tmp_path / "store"))
    write_klines(kline_rows(spark, [{"symbol": "A", "interval": "1h", "open_time": JAN_1}]), store.klines_path)
    assert store.ingest_klines(str(tmp_path / "s")).files_skipped == 1
    assert store.has_day("A", "1h", date(2024, 1, 1))
    store.write_klines(kline_rows(spark, [{"symbol": "A", "interval": "1h", "open_time": JAN_1 + 40 * DAY}]))
    assert store.has_month("A", "1h", 2024, 2) and store.get_klines("A", "1h").count() == 2


def test_the_skip_rule_reads_no_candle(spark, tmp_path, zipped):
    zipped(tmp_path / "s", "A-1h-2024-01-01", hours(0))
    zipped(tmp_path / "s", "A-1h-2024-02-01", hours(31))
    store = MarketStore(spark, str(tmp_path / "store"))
    store.ingest_klines(str(tmp_path / "s"))
    ledger = Ledger(spark, store.klines_path)
    files = existing.described_files(spark.createDataFrame([("x/A-1h-2024-01-01.zip",)], "src_path string"))
    kept = existing.skip_existing(files, ledger.days(["1h"], [202401]))
    assert kept.isEmpty()
    assert any("/klines-ledger/days/" in f for f in kept.inputFiles())
    assert all("/klines-ledger/" in f for f in kept.inputFiles())
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*month#\d+ = 202401", plan)
