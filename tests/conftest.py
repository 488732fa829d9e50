import zipfile

import pytest
from pyspark.sql import SparkSession

HEADER = (
    "open_time,open,high,low,close,volume,close_time,quote_volume,count,"
    "taker_buy_volume,taker_buy_quote_volume,ignore"
)
LINE_1 = (
    "1704067200000,42000.00,42100.00,41900.00,42050.00,1000.5,1704067259999,"
    "42050000.00,1500,500.25,21000000.00,0"
)
LINE_2 = (
    "1704067260000,42050.00,42200.00,42000.00,42150.00,1200.3,1704067319999,"
    "50430000.00,1800,600.15,25200000.00,0"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def zipped():
    """Write an archive with CSV lines and return its path."""

    def write(folder, name, lines, member=None):
        folder.mkdir(parents=True, exist_ok=True)
        path = folder / f"{name}.zip"
        with zipfile.ZipFile(path, "w") as archive:
            if lines is not None:
                archive.writestr(member or f"{name}.csv", "\n".join(lines) + "\n")
        return str(path)

    return write


def minute_lines(start_ms, count, step=60_000, price=50_000):
    """Valid candle lines, one per step."""
    return [
        ",".join(
            map(str, [start_ms + i * step, price + i, price + i + 100, price + i - 100,
                      price + i + 50, 100 + i, start_ms + (i + 1) * step - 1,
                      5_000_000 + 1000 * i, 1000 + i, 50, 2_500_000, 0])
        )
        for i in range(count)
    ]


def kline_rows(spark, rows, **fixed):
    """A kline frame from partial rows, other fields by default."""
    from candlemill.schema import KLINE, KLINE_ORIGIN

    default = dict(
        symbol="BTCUSDT", close_time=0, open_price=50_000.0, high_price=50_100.0,
        low_price=49_900.0, close_price=50_050.0, volume=100.0, quote_volume=5_000_000.0,
        trades_count=1000, taker_buy_volume=50.0, taker_buy_quote_volume=2_500_000.0,
        interval="1m", src_path="f",
    ) | fixed
    from pyspark.sql import types as T

    schema = T.StructType(KLINE.fields + KLINE_ORIGIN.fields)
    full = [{**default, "line_no": i, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(r[f] for f in schema.names) for r in full], schema)
