import hashlib
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from candlemill import MarketStore
from candlemill.operators import snapshots
from candlemill.schema import SNAPSHOT
from candlemill.sinks.tables import compact_snapshots
from candlemill.sources.tables import snapshot_table


def entry(symbol, **fields):
    base = {
        "symbol": symbol, "quoteAsset": "USDT", "baseAsset": symbol[:3], "onboardDate": 1569398400000,
        "deliveryDate": 4133404800000, "underlyingType": "COIN", "status": "TRADING",
    } | fields
    return {k: v for k, v in base.items() if v is not None}


NEWEST = {"symbols": [
    entry("BTCUSDT"), entry("ABCUSDT", onboardDate=None, status=None), entry("XYZUSDT", baseAsset=None),
    entry("USDCUSDT", baseAsset="USDC"), entry("BTCUSDC", quoteAsset="USDC"),
]}


@pytest.fixture(scope="module")
def table(spark):
    def row(day, payload, market="um", status=200, endpoint="exchangeInfo", version=1):
        text = json.dumps(payload)
        return (datetime(2024, 1, day, tzinfo=timezone.utc), market, endpoint, "u", status, 5, text,
                hashlib.sha256(text.encode()).hexdigest(), version, None)

    return spark.createDataFrame([
        row(1, {"symbols": [entry("OLDUSDT")]}), row(2, NEWEST), row(3, {"symbols": [entry("ERRUSDT")]}, status=500),
        row(4, {"symbols": [entry("TIMUSDT")]}, endpoint="time"), row(5, {"symbols": [entry("CMUSD")]}, market="cm"),
        row(6, {"symbols": [entry("BADUSDT")]}), row(6, {"symbols": [entry("BADUSDT")]}, status=500, version=2),
        row(1, {"other": []}, market="spot"),
    ], SNAPSHOT).cache()


def test_symbols_of_the_newest_good_snapshot(table):
    rows = snapshots.query_symbols(table, "um").collect()
    assert [r["symbol"] for r in rows] == ["ABCUSDT", "BTCUSDC", "BTCUSDT", "USDCUSDT", "XYZUSDT"]
    assert rows[2].asDict() == {
        "symbol": "BTCUSDT", "quoteAsset": "USDT", "onboardDate": 1569398400000,
        "deliveryDate": 4133404800000, "underlyingType": "COIN", "status": "TRADING",
    }
    assert rows[0]["onboardDate"] == 0 and rows[0]["status"] == ""
    assert [r["symbol"] for r in snapshots.query_symbols(table, "cm").collect()] == ["CMUSD"]
    assert snapshots.query_symbols(table, "spot").count() == 0


def test_symbol_filters(table):
    def found(**options):
        return [r["symbol"] for r in snapshots.query_symbols(table, "um", **options).collect()]

    assert found(quote_asset=" usdc ") == ["BTCUSDC"]
    assert found(quote_asset="USDT", exclude_stable_base=True) == ["ABCUSDT", "BTCUSDT", "XYZUSDT"]


def test_argument_errors(table):
    for market in ("UM", "futures", ""):
        with pytest.raises(ValueError, match="market"):
            snapshots.query_symbols(table, market)
    for quote in ("U", "US-DT", "USDT'; DROP", ""):
        with pytest.raises(ValueError, match="quote asset"):
            snapshots.query_symbols(table, "um", quote)


def test_only_one_payload_per_market_leaves_the_scan_side(table):
    plan = snapshots.query_symbols(table, "um")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_ingest_landed_documents(spark, tmp_path):
    for market, payload in [("um", NEWEST), ("cm", {"symbols": [], "assets": [1, 2]}), ("other", {})]:
        (tmp_path / "landed" / market).mkdir(parents=True)
        (tmp_path / "landed" / market / "1.json").write_text(json.dumps(payload, indent=1))
    store = MarketStore(spark, str(tmp_path / "store"))
    pulled = datetime(2024, 3, 1, 12, 0, 0, 123456, tzinfo=timezone.utc)
    assert store.ingest_snapshots(str(tmp_path / "landed"), dry_run=True).stored == 0
    assert snapshot_table(spark, store.snapshots_path).count() == 0
    stats = store.ingest_snapshots(str(tmp_path / "landed"), pulled_at=pulled)
    assert (stats.read, stats.refused, stats.stored) == (2, 0, 2)
    rows = {r["market"]: r for r in snapshot_table(spark, store.snapshots_path).collect()}
    text = json.dumps(NEWEST, indent=1)
    assert rows["um"]["payload"] == text
    assert rows["um"]["payload_hash"] == hashlib.sha256(text.encode()).hexdigest()
    assert rows["um"]["pulled_at"] == datetime(2024, 3, 1, 12, 0, 0, 123000)
    assert rows["um"]["err_msg"] is None and rows["um"]["month"] == 202403
    assert store.get_symbols("um").count() == 5
    sizes = {r["market"]: (r["symbols_count"], r["assets_count"]) for r in snapshots.payload_sizes(
        snapshot_table(spark, store.snapshots_path)).collect()}
    assert sizes == {"um": (5, 0), "cm": (0, 2)}

    store.ingest_snapshots(str(tmp_path / "landed"), markets=["um"], pulled_at=pulled)
    assert snapshot_table(spark, store.snapshots_path).count() == 3
    compact_snapshots(spark, store.snapshots_path)
    assert snapshot_table(spark, store.snapshots_path).count() == 2

    (tmp_path / "landed" / "um" / "2.json").write_text("{broken")
    with pytest.raises(ValueError, match="not valid JSON"):
        store.ingest_snapshots(str(tmp_path / "landed"), pulled_at=pulled)
    assert snapshot_table(spark, store.snapshots_path).count() == 2


def test_odd_entries_spoil_no_others(spark):
    payload = '{"symbols": [{"symbol": "A"}, 5, {"symbol": "B", "onboardDate": "soon"}, null]}'
    rows = snapshots.listed_symbols(spark.createDataFrame([(payload,)], "payload string")).collect()
    assert sorted(r["symbol"] for r in rows) == ["", "", "A", "B"]


def test_json_as_python_reads_it(spark):
    texts = {
        '{"a": 1, "a": 2}': True, "[1, 2]": True, "5": True, "{broken": False, "": False, '{"a":1}xyz': False,
        "{'a':1}": False, "NaN": True, '{"a":NaN}': True, "-Infinity": True, ' \t{"a": "é\\u00e9"}\n': True,
        '{"a": "tab\t"}': False, '{"a": 01}': False, '{"a": 1,}': False, "\ufeff{}": False, "[" * 200_000: False, "nul": False,
    }
    frame = spark.createDataFrame([(t,) for t in texts] + [(None,)], "payload string")
    got = {r["payload"]: r["ok"] for r in frame.select("payload", snapshots.is_json(F.col("payload")).alias("ok")).collect()}
    assert got == texts | {None: False}


def test_failed_pulls_are_kept_with_their_envelope(spark, tmp_path):
    for market in ("um", "cm"):
        (tmp_path / "landed" / market).mkdir(parents=True)
    um, cm = tmp_path / "landed" / "um", tmp_path / "landed" / "cm"
    (um / "1.json").write_text(json.dumps(NEWEST))
    (um / "1.pull").write_text(json.dumps({"pulled_at": "2024-03-01T12:00:00Z", "latency_ms": 41, "source_url": "https://um"}))
    (um / "2.pull").write_text(json.dumps({"pulled_at": "2024-03-02T12:00:00Z", "status_code": 503, "err_msg": "busy"}))
    (um / "3.json").write_text("<html>gone</html>")
    (um / "3.pull").write_text(json.dumps({"pulled_at": "2024-03-03 00:00:00", "status_code": 404}))
    (cm / "1.json").write_text('{"symbols": []}')
    store = MarketStore(spark, str(tmp_path / "store"))
    report = store.ingest_snapshots(str(tmp_path / "landed"))
    assert (report.read, report.refused, report.stored) == (2, 2, 4)
    rows = {(r["market"], r["status_code"]): r for r in snapshot_table(spark, store.snapshots_path).collect()}
    assert rows["um", 200]["latency_ms"] == 41 and rows["um", 200]["source_url"] == "https://um"
    assert rows["um", 200]["pulled_at"] == datetime(2024, 3, 1, 12)
    assert (rows["um", 503]["payload"], rows["um", 503]["err_msg"]) == ("", "busy")
    assert rows["um", 404]["payload"] == "<html>gone</html>" and rows["cm", 200]["latency_ms"] == 0
    assert store.get_symbols("um").count() == 5
    (um / "4.pull").write_text('{"status_code": 200}')
    with pytest.raises(ValueError, match="1 snapshot document"):
        store.ingest_snapshots(str(tmp_path / "landed"))
    (um / "4.pull").write_text("no envelope")
    with pytest.raises(Exception, match="no JSON object"):
        store.ingest_snapshots(str(tmp_path / "landed"))
    assert snapshot_table(spark, store.snapshots_path).count() == 4
