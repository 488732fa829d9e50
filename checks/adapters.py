"""The driver tables in the shape of the engine's inputs. All rows are used.

``checks.sql`` holds the same definitions for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.session import use_utc

_MS = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) div 1000"


_COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
              " props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
                " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
                " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table; naming its columns spares the job that would infer them."""
    return use_utc(spark).read.schema(_COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("ms", F.expr(_MS))


def kline_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Raw candles with duplicates, invalid rows, off-grid rows and gaps; one file a day."""
    return (
        _events(spark, folder)
        .withColumn("k", F.expr("cast(get_json_object(props, '$.k') as double)"))
        .withColumn("slot", F.expr("ms div 3600000 * 3600000 + if(event_id % 97 = 0, 1, 0)"))
        .selectExpr(
            "event_type as symbol",
            "slot as open_time",
            "slot + 3599999 as close_time",
            "value as open_price",
            "if(event_id % 29 = 0, 0.001D, greatest(value, k) + 1) as high_price",
            "if(event_id % 31 = 0, -1.0D, least(value, k)) as low_price",
            "k as close_price",
            "cast(1 + event_id % 7 as double) as volume",
            "if(event_id % 41 = 0, null, event_id % 1000 * 0.5D) as quote_volume",
            "event_id % 50 as trades_count",
            "cast(event_id % 11 as double) as taker_buy_volume",
            "cast(event_id % 13 as double) as taker_buy_quote_volume",
            "'1h' as interval",
            "concat(event_type, '-1h-', cast(cast(ts as date) as string)) as src_path",
            "event_id as line_no",
        )
    )


def _candles(interval: str, step: int) -> str:
    return f"""
        select event_type as symbol, ms div {step} * {step} as open_time,
          min_by(value, event_id) as open_price, max(value) as high_price,
          min(value) as low_price, max_by(value, event_id) as close_price,
          cast(count(*) as double) as volume,
          cast(sum(cast(value as decimal(18,2))) as double) as quote_volume,
          count(*) as trades_count,
          cast(count_if(user_id % 2 = 0) as double) as taker_buy_volume,
          cast(sum(if(user_id % 2 = 0, cast(value as decimal(18,2)), 0)) as double)
            as taker_buy_quote_volume,
          '{interval}' as interval, {step}L as step
        from {{events}} group by 1, 2"""


def klines(spark: SparkSession, folder: str) -> DataFrame:
    """A kline table with hourly and daily candles; some have an older version, too."""
    return spark.sql(
        f"""
        select symbol, open_time, open_time + step - 1 as close_time, open_price, high_price,
          low_price, if(version = 0, 0.0D, close_price) as close_price, volume, quote_volume,
          trades_count, taker_buy_volume, taker_buy_quote_volume, interval,
          timestamp_seconds(version) as ingested_at, concat(symbol, '-', interval) as src_path,
          open_time div step as line_no,
          year(date_from_unix_date(cast(open_time div 86400000 as int))) * 100
            + month(date_from_unix_date(cast(open_time div 86400000 as int))) as month
        from ({_candles("1h", 3_600_000)} union all {_candles("1d", 86_400_000)})
        lateral view explode(if(open_time div step % 3 = 0, array(0, 1), array(1))) as version""",
        events=_events(spark, folder),
    )


def file_names(spark: SparkSession, folder: str) -> DataFrame:
    """One archive path per event: daily and monthly, some of them malformed."""
    return (
        table(spark, folder, "events")
        .withColumn("day", F.expr("cast(cast(ts as date) as string)"))
        .withColumn("sym", F.expr("if(event_id % 23 = 0, '', concat('SYM', user_id % 20))"))
        .withColumn("itv", F.expr("element_at(array('1m', '1h', '2m', '1d'), int(event_id % 4) + 1)"))
        .selectExpr(
            "event_id",
            """concat('tree/', user_id % 3, '/', case
                 when event_id % 17 = 0 then sym
                 when event_id % 19 = 0 then concat(sym, '-', itv, '-2024-13-45')
                 when event_id div 4 % 2 = 0 then concat(sym, '-', itv, '-', day)
                 else concat(sym, '-', itv, '-', substring(day, 1, 7)) end, '.zip') as src_path""",
        )
    )


def stored_candles(spark: SparkSession, folder: str) -> DataFrame:
    """Candle keys already in a table: on each day, one interval of every symbol."""
    return _events(spark, folder).selectExpr(
        "concat('SYM', user_id % 20) as symbol",
        "element_at(array('1m', '1h', '4h', '1d'), day(ts) % 4 + 1) as interval",
        "ms as open_time",
    )


def ledger_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Days entered by runs: each run has the days of some users and one interval."""
    return stored_candles(spark, folder).withColumn("day", F.expr(
        "date_from_unix_date(cast(open_time div 86400000 as int))"
    )).selectExpr("concat('run-', cast(substring(symbol, 4) as int) % 7, '-', month(day)) as run", "symbol", "interval", "day")


def ledger_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Finished runs; every third was never finished."""
    return ledger_entries(spark, folder).select("run").distinct().filter(
        "substring(run, 5, 1) not in ('1', '4')"
    )


def ledger_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files taken by the runs, some by more than one."""
    return file_names(spark, folder).selectExpr(
        "concat('run-', event_id % 7, '-', event_id div 7 % 12 + 1) as run", "src_path"
    )


def csv_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of kline files of 100 lines each; headers, missing and bad cells included."""
    header = (
        "open_time,open,high,low,close,volume,close_time,quote_volume,count,"
        "taker_buy_volume,taker_buy_quote_volume,ignore"
    )
    return (
        _events(spark, folder)
        .withColumn("file", F.expr("event_id div 100"))
        .withColumn("line_no", F.expr("event_id % 100"))
        .selectExpr(
            "concat('tree/F', file, '-1h-2024-01-01.zip') as src_path",
            "concat('F', file) as symbol",
            "'1h' as interval",
            "line_no",
            f"""if(file % 2 = 0 and line_no = 0, '{header}', concat_ws(',',
                cast(ms as string),
                concat(user_id, '.25'), concat(user_id + 2, '.5'), concat(user_id, '.125'),
                concat(user_id + 1, '.0'),
                if(file % 11 = 0 and line_no = 57, 'x1', concat(event_id % 7, '.75')),
                cast(ms + 3599999 as string),
                if(event_id % 13 = 0, '', concat(event_id % 1000, 'e-1')),
                if(file % 23 = 5 and line_no = 30, '', cast(event_id % 50 as string)),
                if(event_id % 17 = 0, 'NA', concat(event_id % 11, '.5')),
                concat(event_id % 9, '.5'),
                '0')) as line""",
            "cast(null as string) as error",
        )
    )


def markers(spark: SparkSession, folder: str) -> DataFrame:
    """Names found in a data folder, one per event, some malformed."""
    return table(spark, folder, "events").selectExpr(
        """concat(if(user_id % 13 = 0, '_success__', '_SUCCESS__'),
                  cast(cast(ts as date) as string), '__',
                  if(user_id % 17 = 0, 'UM', if(user_id % 3 = 0, 'cm', 'um')), '__',
                  element_at(array('1m', '1h', '4h', '1d'), int(event_id % 4) + 1)) as name"""
    ).distinct()


def ingested(spark: SparkSession, folder: str) -> DataFrame:
    """Names of ingested markers: on each day, those of one interval."""
    return table(spark, folder, "events").selectExpr(
        """concat('_SUCCESS__', cast(cast(ts as date) as string), '__',
                  if(user_id % 3 = 0, 'cm', 'um'), '__',
                  element_at(array('1m', '1h', '4h', '1d'), day(ts) % 4 + 1)) as name"""
    ).distinct()


def factor_wide(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as symbol",
        "l_shipdate as time",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    )


_VALUE_TEXT = """case o_orderkey % 8
    when 0 then 'nan' when 1 then 'inf' when 2 then 'abc' when 3 then null
    when 4 then '1_000' when 5 then ' 42 '
    else cast(cast(o_totalprice as decimal(18,2)) as string) end"""


def factor_text(spark: SparkSession, folder: str) -> DataFrame:
    """Factor cells as text, readable or not."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderstatus as symbol",
        """case o_orderkey % 5
             when 0 then cast(cast(o_orderdate as date) as string)
             when 1 then concat(cast(cast(o_orderdate as date) as string), ' 10:30:00')
             when 2 then concat(cast(cast(o_orderdate as date) as string), 'T00:00:00Z')
             when 3 then 'not-a-date' else null end as time""",
        "if(o_orderkey % 2 = 0, 'price', 'cost') as factor_name",
        f"{_VALUE_TEXT} as raw_value",
    )


def factor_write_input(spark: SparkSession, folder: str) -> DataFrame:
    """Rows handed in for writing: every spelling of a time, faulty rows included."""
    return table(spark, folder, "orders").selectExpr(
        "if(o_orderkey % 101 = 0, ' ', o_orderstatus) as symbol",
        """case o_orderkey % 7
             when 0 then cast(cast(o_orderdate as date) as string)
             when 1 then concat(cast(cast(o_orderdate as date) as string), 'T10:30:00Z')
             when 2 then concat(cast(cast(o_orderdate as date) as string), ' 10:30:00.250+08:00')
             when 3 then cast(1704067200 + o_orderkey as string)
             when 4 then cast(1704067200123 + o_orderkey as string)
             when 5 then '20240101'
             else if(o_orderkey % 3 = 0, 'soon',
                     concat(cast(cast(o_orderdate as date) as string), ' 23:59')) end as datetime""",
        "if(o_orderkey % 103 = 0, null, o_orderpriority) as factor_name",
        f"{_VALUE_TEXT} as factor_value",
    )


def factor_versions(spark: SparkSession, folder: str) -> DataFrame:
    """A factor table in which each order replaces older ones of its status and day."""
    return (
        table(spark, folder, "orders")
        .selectExpr(
            "o_orderstatus as symbol",
            "cast(o_orderdate as timestamp) as datetime",
            "o_orderkey",
            "o_orderpriority as source",
            "stack(2, 'price', o_totalprice, 'cust', cast(o_custkey as double))"
            " as (factor_name, factor_value)",
        )
        .selectExpr(
            "symbol", "datetime", "factor_name", "factor_value", "source",
            "timestamp_seconds(o_orderkey) as update_time",
            "year(datetime) * 100 + month(datetime) as month",
        )
    )


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots of one market per event type, each of at most 200 consecutive events."""
    entry = """concat('{"symbol":"S', event_id,
        '","quoteAsset":"', element_at(array('USDT', 'USDC', 'BTC'), int(user_id % 3) + 1), '"',
        case when event_id % 11 = 0 then ''
             when event_id % 5 = 0 then ',"baseAsset":"USDC"'
             else concat(',"baseAsset":"B', user_id, '"') end,
        if(event_id % 3 = 0, concat(',"onboardDate":', ms), ''),
        ',"deliveryDate":4133404800000,"underlyingType":"COIN","status":"',
        if(event_id % 4 = 0, 'BREAK', 'TRADING'), '"}')"""
    return (
        _events(spark, folder)
        .selectExpr("event_type as market", "event_id div 200 as block", "event_id", "ms",
                    f"{entry} as entry")
        .groupBy("market", "block")
        .agg(
            F.max("ms").alias("ms"),
            F.array_sort(F.collect_list(F.struct("event_id", "entry"))).alias("entries"),
        )
        .selectExpr(
            "timestamp_millis(ms) as pulled_at",
            "market",
            "if(block % 9 = 8, 'time', 'exchangeInfo') as endpoint",
            "concat('file:/landed/', market, '/', block, '.json') as source_url",
            "if((block + length(market)) % 4 = 0, 500, 200) as status_code",
            "block % 100 as latency_ms",
            """concat('{"symbols":[', array_join(transform(entries, e -> e.entry), ','), ']',
                      if(block % 2 = 0, concat(',"assets":[', array_join(
                          transform(sequence(0, int(block % 5)), i -> cast(i as string)), ','),
                          ']'), ''), '}') as payload""",
            "block as ingest_version",
        )
        .withColumn("payload_hash", F.sha2("payload", 256))
        .withColumn("err_msg", F.lit(None).cast("string"))
    )


def factor_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of one wide factor file per order status, and of files that are to be rejected.

    Headers repeat a name; times have slashes, nanoseconds or nothing; one column says True and
    False, one has quoted commas.
    """
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderstatus as symbol", "o_orderkey + 1 as line_no",
        """concat_ws(',', case o_orderkey % 4
             when 0 then date_format(o_orderdate, 'yyyy-MM-dd')
             when 1 then date_format(o_orderdate, 'yyyy/MM/dd')
             when 2 then concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T00:00:00.000000000Z')
             else 'never' end,
           cast(cast(o_totalprice as decimal(18,2)) as string), cast(o_custkey as string),
           if(o_orderkey % 5 = 0, '"x, y"', concat('"', o_custkey, '"')),
           element_at(array('True', 'False', ''), int(o_orderkey % 3) + 1)) as line""",
    )
    heads = rows.select("symbol").distinct().selectExpr(
        "symbol", "0L as line_no", "'time,A,A,Note,Flag' as line"
    )
    odd = table(spark, folder, "nation").selectExpr(
        "concat('bad', n_nationkey) as symbol", "n_nationkey % 2 as kind"
    )
    odd_heads = odd.selectExpr("symbol", "0L as line_no", "if(kind = 0, 'when,A', 'time,A') as line")
    odd_rows = odd.selectExpr("symbol", "1L as line_no", "if(kind = 0, '2024-01-01,1', '2024-01-01,1,2') as line")
    placed = rows.unionByName(heads).unionByName(odd_heads).unionByName(odd_rows).selectExpr(
        "concat('csv/', symbol, '.csv') as src_path", "0L as block", "line_no", "line", "symbol"
    )
    return placed.unionByName(_torn_lines(spark, folder))


def _torn_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Files in blocks of 500 records with line breaks in quotes; one of each kind of time text per status."""
    orders = table(spark, folder, "orders")
    # The first record of a file shows the order of day and month.
    firsts = orders.groupBy(F.col("o_orderstatus").alias("status")).agg(F.min("o_orderkey").alias("first_key"))
    kinds = "explode(array('us', 'eu', 'name')) as kind"
    symbol = "concat(kind, '_', o_orderstatus) as symbol"
    records = orders.select("o_orderkey", "o_orderstatus").join(
        F.broadcast(firsts), F.col("o_orderstatus").eqNullSafe(F.col("status"))
    ).join(
        orders.select("o_orderkey", "o_orderdate", "o_custkey"), "o_orderkey"
    ).selectExpr("*", kinds).selectExpr(
        symbol, "o_orderkey", "o_orderkey = first_key as first", "kind", "o_orderdate", "o_custkey"
    ).selectExpr(
        "symbol", "o_orderkey",
        """concat_ws(',',
             case kind when 'us' then date_format(o_orderdate, 'MM/dd/yyyy')
               when 'eu' then if(first, '31/12/1999', date_format(o_orderdate, 'dd/MM/yyyy'))
               else date_format(o_orderdate, 'MMM d yyyy HH:mm') end,
             if(o_orderkey % 3 = 0, concat('"first, line\n\nof ""three"" ', o_custkey, '\n"'), cast(o_custkey as string)),
             if(o_orderkey % 5 = 0, concat('"', o_custkey, '\n"'), cast(o_custkey as string)),
             concat('5" disk'))  as record""",
    )
    lines = records.selectExpr(
        "symbol", "o_orderkey div 500 as block", "o_orderkey",
        "posexplode(split(record, '\n')) as (place, line)",
    ).selectExpr("symbol", "block", "(o_orderkey + 1) * 10 + place as line_no", "line")
    named = orders.filter("o_orderkey is not null").select("o_orderstatus").distinct()
    heads = named.selectExpr("*", kinds).selectExpr(symbol).distinct().selectExpr(
        "symbol", "0L as block", "explode(array(struct(0L as line_no, 'time,\"A' as line), struct(1L as line_no,"
        " 'long name\",B,Disk' as line))) as head",
    ).selectExpr("symbol", "block", "head.line_no", "head.line")
    return lines.unionByName(heads).selectExpr(
        "concat('csv/', symbol, '.csv') as src_path", "block", "line_no", "line", "symbol"
    )


def zipped_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The kline lines as archives: one zip with one CSV per file."""
    lines = csv_lines(spark, folder).groupBy("src_path", "symbol", "interval").agg(
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]
        ), "\n").alias("text")
    )
    return lines.mapInPandas(_zipped, "src_path string, symbol string, interval string, content binary")


def _zipped(frames):
    import io
    import zipfile

    for frame in frames:
        contents = []
        for text in frame.pop("text"):
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("lines.csv", text)
            contents.append(held.getvalue())
        yield frame.assign(content=contents)


def payload_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that are JSON and some that aren't, one per event."""
    return table(spark, folder, "events").selectExpr(
        "event_id",
        """case event_id % 10 when 0 then props when 1 then '{"a":1,"a":2}' when 2 then concat('[', event_id, ']')
           when 3 then concat('{"a":', event_id) when 4 then '' when 5 then cast(event_id as string)
           when 6 then concat('{"a":1}x', event_id) when 7 then concat("{'a':", event_id, '}')
           when 8 then 'NaN' else concat('{"a":[NaN,-Infinity,', event_id, ']}') end as payload""",
    )


def pull_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of pulls; every fifth pull of a market brought none."""
    return snapshots(spark, folder).filter("ingest_version % 5 <> 3").selectExpr(
        "market", "cast(ingest_version as string) as name", "pulled_at", "source_url",
        "if(ingest_version % 7 = 6, substring(payload, 2), payload) as payload",
    )


def pull_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """What is known of pulls: of all that brought nothing, and of every second of the others."""
    return snapshots(spark, folder).filter("ingest_version % 5 = 3 or ingest_version % 2 = 0").selectExpr(
        "market", "cast(ingest_version as string) as name",
        "if(ingest_version % 5 = 3, pulled_at, null) as pulled_at",
        "if(ingest_version % 4 = 0, concat('https://pull/', market), null) as source_url",
        "if(ingest_version % 5 = 3, if(ingest_version % 2 = 0, 503, null), 200) as status_code",
        "latency_ms",
        "if(ingest_version % 5 = 3, 'timed out', null) as err_msg",
    )


def spot_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshots, those of one event type as the spot market."""
    return snapshots(spark, folder).withColumn(
        "market", F.when(F.col("market") == "click", "spot").otherwise(F.col("market"))
    )
