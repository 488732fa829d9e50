import math
import random

import pytest
from conftest import kline_rows
from pyspark.sql import functions as F

from candlemill.operators import clean, reports

NAN = float("nan")


def times(df):
    return sorted(r["open_time"] for r in df.select("open_time").collect())


def stats(df, step=1000):
    return clean.cleaning_stats(df, step).first()


def test_duplicates_keep_the_first(spark):
    rows = kline_rows(spark, [
        dict(open_time=1000, close_price=50_001.0), dict(open_time=1000, close_price=50_002.0),
        dict(open_time=2000),
    ])
    result = clean.clean(rows, 1000)
    assert times(result) == [1000, 2000]
    assert result.filter("open_time = 1000").first()["close_price"] == 50_001.0
    assert stats(rows)["duplicates_removed"] == 1


def test_first_duplicate_invalid_loses_both(spark):
    rows = kline_rows(spark, [
        dict(open_time=1000, high_price=-1.0), dict(open_time=1000), dict(open_time=2000),
    ])
    assert times(clean.clean(rows, 1000)) == [2000]


def test_invalid_rows_and_report(spark):
    rows = kline_rows(spark, [
        dict(open_time=1000),
        dict(open_time=2000, high_price=50_000.0, low_price=50_200.0),
        dict(open_time=3000, high_price=-100.0),
    ])
    assert times(clean.clean(rows, 1000)) == [1000]
    assert stats(rows)["invalid_removed"] == 2
    report = {r["open_time"]: r["reasons"] for r in clean.invalid_report(rows).collect()}
    assert report[2000] == [
        "high < max(open, close) at 2000", "low > min(open, close) at 2000", "high < low at 2000",
    ]
    assert report[3000][0] == "non-positive price at 3000"


def test_report_is_limited_per_file_in_line_order(spark):
    rows = kline_rows(spark, [dict(open_time=i, volume=-1.0) for i in range(30)])
    report = clean.invalid_report(rows).orderBy("line_no").collect()
    assert [r["line_no"] for r in report] == list(range(10))
    assert report[0]["reasons"] == ["negative volume at 0"]


def test_missing_checked_value_is_invalid(spark):
    checked = ("open_price", "high_price", "low_price", "close_price", "volume")
    rows = kline_rows(spark, [
        {"open_time": 1000 * i, name: value, "src_path": f"{name} {value}"}
        for i, (name, value) in enumerate((n, v) for n in checked for v in (NAN, None))
    ] + [dict(open_time=1)])
    assert times(clean.clean(rows, 1000)) == [1]
    assert [r["reasons"] for r in clean.invalid_report(rows).collect()] == [[]] * 10


def test_gap_is_a_flat_candle_with_zero_volume(spark):
    rows = kline_rows(spark, [dict(open_time=1000, volume=500.0), dict(open_time=3000)])
    result = clean.clean(rows, 1000)
    assert times(result) == [1000, 2000, 3000]
    gap = result.filter("open_time = 2000").first()
    assert {gap[c] for c in ("open_price", "high_price", "low_price", "close_price")} == {50_050.0}
    assert gap["volume"] == gap["quote_volume"] == gap["taker_buy_volume"] == 0
    assert gap["taker_buy_quote_volume"] == gap["trades_count"] == 0
    assert gap["close_time"] == 2999 and gap["symbol"] == "BTCUSDT" and gap["interval"] == "1m"
    assert stats(rows)["gaps_filled"] == 1 and stats(rows)["rows_out"] == 3


GRIDS = [
    ([0, 1500, 2000], [0, 1500, 2000], 0),
    ([0, 500, 3000], [0, 1000, 2000, 3000], 1),
    ([0, 100, 200, 1000], [0, 1000], -2),
    ([0, 2500], [0, 1000, 2000], 1),
    ([5000], [5000], 0),
    ([3000, 1000, 2000], [1000, 2000, 3000], 0),
]


def test_grid_cases(spark):
    rows = kline_rows(spark, [
        dict(open_time=t, src_path=str(i)) for i, (given, _, _) in enumerate(GRIDS) for t in given
    ])
    found = clean.clean(rows, 1000).groupBy("src_path").agg(F.sort_array(F.collect_list("open_time")))
    assert dict(map(tuple, found.collect())) == {str(i): g[1] for i, g in enumerate(GRIDS)}
    counted = clean.cleaning_stats(rows, 1000).select("src_path", "gaps_filled", "rows_out").collect()
    assert {r[0]: tuple(r[1:]) for r in counted} == {
        str(i): (g[2], len(g[1])) for i, g in enumerate(GRIDS)
    }


def test_missing_quote_volume_becomes_zero_only_beside_a_gap(spark):
    rows = kline_rows(spark, [
        dict(open_time=t, quote_volume=value, src_path=f"{end} {value}")
        for value in (NAN, None) for end in (1000, 2000) for t in (0, end)
    ])
    kept = dict(
        map(tuple, clean.clean(rows, 1000).filter("open_time = 0").select("src_path", "quote_volume").collect())
    )
    assert kept["2000 nan"] == kept["2000 None"] == 0
    assert kept["1000 None"] is None and math.isnan(kept["1000 nan"])


def test_empty_stays_empty(spark):
    rows = kline_rows(spark, [])
    assert clean.clean(rows, 1000).count() == 0
    assert clean.clean(rows, 1000).columns == rows.columns


def test_unknown_interval_is_an_error(spark):
    rows = kline_rows(spark, [dict(open_time=0), dict(open_time=2000)], interval="2m")
    with pytest.raises(Exception, match="unknown interval"):
        clean.clean(rows).collect()


def test_files_are_cleaned_apart_each_with_its_interval(spark):
    minute = kline_rows(spark, [dict(open_time=0), dict(open_time=180_000)], src_path="m")
    hour = kline_rows(
        spark, [dict(open_time=0), dict(open_time=7_200_000)], src_path="h", interval="1h"
    )
    result = clean.clean(minute.unionByName(hour))
    assert times(result.filter("src_path = 'm'")) == [0, 60_000, 120_000, 180_000]
    assert times(result.filter("src_path = 'h'")) == [0, 3_600_000, 7_200_000]


def test_gaps_across_many_stretches(spark, monkeypatch):
    """Stretches of 4 slots: rows, empty stretches and off-grid rows around their edges."""
    monkeypatch.setattr(clean, "STRETCH", 4)
    given = [3000, 4000, 7000, 8000, 8500, 9999, 31_000, 32_000, 47_000, -9000]
    rows = kline_rows(spark, [dict(open_time=t, close_price=50_000.0 + i) for i, t in enumerate(given)])
    result = clean.clean(rows, 1000)
    assert times(result) == list(range(-9000, 47_001, 1000))
    on_grid = sorted((t, 50_000.0 + i) for i, t in enumerate(given) if t % 1000 == 0)
    for row in result.select("open_time", "close_price").collect():
        assert row["close_price"] == [c for t, c in on_grid if t <= row["open_time"]][-1]
    assert stats(rows)["rows_out"] == result.count()


def test_cleaning_clean_rows_changes_nothing(spark):
    rows = kline_rows(spark, [dict(open_time=t) for t in (0, 1000, 5000, 9000)])
    once = clean.clean(rows, 1000)
    numbered = once.withColumn("line_no", F.col("open_time"))
    twice = clean.clean(numbered, 1000)
    assert numbered.exceptAll(twice).count() == 0 and twice.exceptAll(numbered).count() == 0


def test_plan_scans_rows_once_and_starts_no_job(spark, tmp_path):
    """Every consumer reads the same shuffle of the rows."""
    rows = kline_rows(spark, [dict(open_time=60_000 * t) for t in (0, 1, 5)])
    rows.write.parquet(str(tmp_path / "r"))
    spark.sparkContext.setJobGroup("planning", "no job is to start")
    result = clean.clean(spark.read.schema(rows.schema).parquet(str(tmp_path / "r")))
    clean.cleaning_stats(spark.read.schema(rows.schema).parquet(str(tmp_path / "r")))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("running", "")
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1
    assert plan.count("ReusedExchange") >= 1


def test_times_in_another_unit_are_told_and_long_spans_are_not(spark):
    start, day = 1_704_067_200_000, 86_400_000
    files = {
        "A-1d-2024-01-01.zip": [start, start + day, start + 2 * day], "B-1h-2024-01-01.zip": [start, start + 400 * day],
        "C-1m-2024-01-01.zip": [start * 1000, start * 1000 + 60_000_000], "D-1m.zip": [start, start * 1000],
        "E-1m-2024-01.zip": [start // 1000], "F.zip": [0, 40 * day],
    }
    rows = kline_rows(spark, [dict(open_time=t, src_path=p) for p, ts in files.items() for t in ts])
    found = {r["src_path"]: r["reason"] for r in clean.foreign_units(rows).collect()}
    assert found.keys() == {"C-1m-2024-01-01.zip", "D-1m.zip"}
    assert "not in milliseconds" in found["D-1m.zip"]


def test_time_range_is_first_and_last_line(spark):
    rows = kline_rows(spark, [dict(open_time=t) for t in (5, 1, 9, 3)])
    row = reports.file_time_range(rows).first()
    assert (row["first_time"], row["last_time"]) == (5, 3)


def cleaned_by_hand(rows, step):
    """The cleaning rules row by row over one file, for comparison."""
    seen, kept = set(), []
    for row in rows:
        if row["open_time"] in seen:
            continue
        seen.add(row["open_time"])
        o, h, l, c, v = (row[k] for k in ("open_price", "high_price", "low_price", "close_price", "volume"))
        if min(o, h, l, c) > 0 and h >= max(o, c) and l <= min(o, c) and v >= 0:
            kept.append(row)
    kept.sort(key=lambda r: r["open_time"])
    if len(kept) < 2:
        return [(r["open_time"], r["close_price"], r["volume"]) for r in kept]
    start, end = kept[0]["open_time"], kept[-1]["open_time"]
    if (end - start) // step + 1 == len(kept):
        return [(r["open_time"], r["close_price"], r["volume"]) for r in kept]
    by_time, out = {r["open_time"]: r for r in kept}, []
    for t in range(start, end + 1, step):
        row = by_time.get(t)
        out.append((t, row["close_price"], row["volume"]) if row else (t, out[-1][1], 0.0))
    return out


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_random_files_equal_a_row_by_row_pass(spark, monkeypatch, seed):
    """Files of every size; one of them holds a third of all rows, mostly copies."""
    monkeypatch.setattr(clean, "STRETCH", 8)
    rng = random.Random(seed)
    files = {}
    for number in range(40):
        size = 400 if number == 0 else rng.randrange(1, 20)
        grid = rng.choice([1, 1, 1, 2, 10])
        files[f"f{number}"] = [
            dict(
                open_time=rng.randrange(60 if number else 90) * 1000 + (rng.randrange(grid) * 100),
                open_price=float(rng.randrange(-1, 30)), high_price=float(rng.randrange(10, 60)),
                low_price=float(rng.randrange(0, 8)), close_price=float(rng.randrange(1, 40)),
                volume=float(rng.randrange(-1, 50)),
            )
            for _ in range(size)
        ]
    rows = kline_rows(spark, [
        {**row, "src_path": path, "line_no": i} for path, rs in files.items() for i, row in enumerate(rs)
    ])
    found = {}
    for r in clean.clean(rows, 1000).select("src_path", "open_time", "close_price", "volume").collect():
        found.setdefault(r[0], []).append(tuple(r)[1:])
    expected = {path: cleaned_by_hand(rs, 1000) for path, rs in files.items()}
    assert {p: sorted(v) for p, v in found.items()} == {p: v for p, v in expected.items() if v}
    out = clean.cleaning_stats(rows, 1000).select("src_path", "rows_out").collect()
    assert dict(map(tuple, out)) == {p: len(v) for p, v in expected.items()}
