"""The registered queries in DuckDB SQL, over the same adapters as ``checks.adapters``."""

from __future__ import annotations

_HOUR, _DAY = 3_600_000, 86_400_000

# ------------------------------------------------------------------- adapters

KLINE_FEED = """
ev AS (
  SELECT *, epoch_us(ts) // 1000 AS ms, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events),
feed AS (
  SELECT event_type AS symbol,
    ms // 3600000 * 3600000 + CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END AS open_time,
    ms // 3600000 * 3600000 + CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END + 3599999 AS close_time,
    value AS open_price,
    CASE WHEN event_id % 29 = 0 THEN 0.001::DOUBLE ELSE greatest(value, k) + 1 END AS high_price,
    CASE WHEN event_id % 31 = 0 THEN -1.0::DOUBLE ELSE least(value, k) END AS low_price,
    k AS close_price,
    CAST(1 + event_id % 7 AS DOUBLE) AS volume,
    CASE WHEN event_id % 41 = 0 THEN NULL ELSE (event_id % 1000) * 0.5::DOUBLE END AS quote_volume,
    event_id % 50 AS trades_count,
    CAST(event_id % 11 AS DOUBLE) AS taker_buy_volume,
    CAST(event_id % 13 AS DOUBLE) AS taker_buy_quote_volume,
    '1h' AS "interval",
    event_type || '-1h-' || strftime(ts, '%Y-%m-%d') AS src_path,
    event_id AS line_no
  FROM ev)"""

_IS_VALID = """coalesce(open_price > 0 AND high_price > 0 AND low_price > 0 AND close_price > 0
    AND NOT isnan(open_price) AND NOT isnan(high_price) AND NOT isnan(low_price)
    AND NOT isnan(close_price) AND NOT isnan(volume)
    AND high_price >= greatest(open_price, close_price)
    AND low_price <= least(open_price, close_price)
    AND high_price >= low_price AND volume >= 0, false)"""

DEDUP = f"""{KLINE_FEED},
dedup AS (
  SELECT * FROM feed
  QUALIFY row_number() OVER (PARTITION BY src_path, open_time ORDER BY line_no) = 1)"""

VALID = f"""{DEDUP},
valid AS (SELECT * FROM dedup WHERE {_IS_VALID})"""

GRID = f"""{VALID},
extent AS (
  SELECT src_path, min(open_time) AS t0, max(open_time) AS t1, count(*) AS n,
    (max(open_time) - min(open_time)) // {_HOUR} + 1 AS m
  FROM valid GROUP BY src_path),
grid AS (
  SELECT src_path, unnest(generate_series(t0, t1, {_HOUR})) AS open_time
  FROM extent WHERE n >= 2 AND n <> m),
carried AS (
  SELECT g.src_path, g.open_time, v.line_no, v.close_time, v.open_price, v.high_price, v.low_price,
    v.symbol IS NULL AS is_new,
    last_value(v.symbol IGNORE NULLS) OVER w AS symbol,
    last_value(v."interval" IGNORE NULLS) OVER w AS "interval",
    last_value(v.close_price IGNORE NULLS) OVER w AS close_price,
    coalesce(v.volume, 0) AS volume, coalesce(v.quote_volume, 0) AS quote_volume,
    coalesce(v.trades_count, 0) AS trades_count,
    coalesce(v.taker_buy_volume, 0) AS taker_buy_volume,
    coalesce(v.taker_buy_quote_volume, 0) AS taker_buy_quote_volume
  FROM grid g LEFT JOIN valid v USING (src_path, open_time)
  WINDOW w AS (PARTITION BY g.src_path ORDER BY g.open_time
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
filled AS (
  SELECT symbol, open_time,
    CASE WHEN is_new THEN open_time + {_HOUR} - 1 ELSE close_time END AS close_time,
    CASE WHEN is_new THEN close_price ELSE open_price END AS open_price,
    CASE WHEN is_new THEN close_price ELSE high_price END AS high_price,
    CASE WHEN is_new THEN close_price ELSE low_price END AS low_price,
    close_price, volume, quote_volume, trades_count, taker_buy_volume, taker_buy_quote_volume,
    "interval", src_path, line_no
  FROM carried
  UNION ALL BY NAME
  SELECT v.* FROM valid v JOIN extent e USING (src_path) WHERE e.n < 2 OR e.n = e.m)"""


def _candles(interval: str, step: int) -> str:
    return f"""
  SELECT event_type AS symbol, epoch_us(ts) // 1000 // {step} * {step} AS open_time,
    arg_min(value, event_id) AS open_price, max(value) AS high_price, min(value) AS low_price,
    arg_max(value, event_id) AS close_price, CAST(count(*) AS DOUBLE) AS volume,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS quote_volume, count(*) AS trades_count,
    CAST(count(*) FILTER (user_id % 2 = 0) AS DOUBLE) AS taker_buy_volume,
    CAST(sum(CASE WHEN user_id % 2 = 0 THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE)
      AS taker_buy_quote_volume,
    '{interval}' AS "interval", {step} AS step
  FROM events GROUP BY 1, 2"""


KLINES = f"""
candles AS ({_candles("1h", _HOUR)} UNION ALL {_candles("1d", _DAY)}),
versions AS (
  SELECT c.* REPLACE (CASE WHEN v.version = 0 THEN 0.0::DOUBLE ELSE close_price END AS close_price),
    open_time + step - 1 AS close_time, open_time // step AS line_no, version
  FROM candles c, (VALUES (0), (1)) v(version)
  WHERE v.version = 1 OR (open_time // step) % 3 = 0),
klines AS (
  SELECT * FROM versions
  QUALIFY row_number() OVER (PARTITION BY "interval", symbol, open_time ORDER BY version DESC) = 1)"""

_KLINE_COLUMNS = """symbol, open_time, close_time, open_price AS open, high_price AS high,
  low_price AS low, close_price AS close, volume, quote_volume, trades_count, taker_buy_volume,
  taker_buy_quote_volume"""

FILE_NAMES = """
named AS (
  SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, user_id,
    CASE WHEN event_id % 23 = 0 THEN '' ELSE 'SYM' || (user_id % 20) END AS sym,
    (['1m', '1h', '2m', '1d'])[event_id % 4 + 1] AS itv
  FROM events),
file_names AS (
  SELECT event_id, 'tree/' || (user_id % 3) || '/' || CASE
      WHEN event_id % 17 = 0 THEN sym
      WHEN event_id % 19 = 0 THEN sym || '-' || itv || '-2024-13-45'
      WHEN event_id // 4 % 2 = 0 THEN sym || '-' || itv || '-' || day
      ELSE sym || '-' || itv || '-' || substring(day, 1, 7) END || '.zip' AS src_path
  FROM named),
parts AS (
  SELECT event_id, src_path,
    string_split(regexp_replace(split_part(src_path, '/', -1), '^(.+)\\.zip$', '\\1'), '-') AS p
  FROM file_names),
described AS (
  SELECT event_id, src_path,
    CASE WHEN p[1] = '' THEN 'UNKNOWN' ELSE p[1] END AS symbol,
    p[1] AS own_symbol,
    CASE WHEN p[2] IN ('1m','3m','5m','15m','30m','1h','2h','4h','6h','8h','12h','1d')
      THEN p[2] END AS "interval",
    CASE WHEN len(p) >= 5 AND try_cast(concat_ws('-', p[3], p[4], p[5]) AS DATE) IS NOT NULL
           THEN concat_ws('-', p[3], p[4], p[5])
         WHEN len(p) >= 4 AND try_cast(concat_ws('-', p[3], p[4], '01') AS DATE) IS NOT NULL
           THEN concat_ws('-', p[3], p[4], '01') END AS date,
    len(p) = 4 AND try_cast(concat_ws('-', p[3], p[4], '01') AS DATE) IS NOT NULL AS monthly
  FROM parts)"""

STORED = f"""{FILE_NAMES},
stored AS (
  SELECT 'SYM' || (user_id % 20) AS symbol, (['1m', '1h', '4h', '1d'])[day(ts) % 4 + 1] AS "interval",
    epoch_us(ts) // 1000 AS open_time
  FROM events),
stored_days AS (
  SELECT DISTINCT symbol, "interval", open_time // {_DAY} AS day FROM stored),
stored_months AS (
  SELECT DISTINCT symbol, "interval", strftime(make_timestamp(open_time * 1000), '%Y-%m') AS month
  FROM stored),
files AS (
  SELECT DISTINCT src_path, symbol, "interval", date, monthly FROM described
  WHERE "interval" IS NOT NULL)"""

_STORED_DAY = """EXISTS (SELECT 1 FROM stored_days s WHERE s.symbol = f.symbol
  AND s."interval" = f."interval" AND s.day = date_diff('day', DATE '1970-01-01', CAST(f.date AS DATE)))"""
_STORED_MONTH = """EXISTS (SELECT 1 FROM stored_months s WHERE s.symbol = f.symbol
  AND s."interval" = f."interval" AND s.month = substring(f.date, 1, 7))"""

LEDGER = f"""{STORED},
entries AS (
  SELECT 'run-' || (CAST(substring(symbol, 4) AS INTEGER) % 7) || '-' || month(day) AS run, symbol, "interval", day
  FROM (SELECT *, CAST(make_timestamp(open_time * 1000) AS DATE) AS day FROM stored)),
runs AS (
  SELECT DISTINCT run FROM entries WHERE substring(run, 5, 1) NOT IN ('1', '4')),
begun AS (
  SELECT 'run-' || (event_id % 7) || '-' || (event_id // 7 % 12 + 1) AS run, src_path FROM file_names),
finished AS (
  SELECT DISTINCT symbol, "interval", day FROM entries SEMI JOIN runs USING (run))"""

_LINE_HEADER = (
    "open_time,open,high,low,close,volume,close_time,quote_volume,count,"
    "taker_buy_volume,taker_buy_quote_volume,ignore"
)

CSV_LINES = f"""
numbered AS (
  SELECT *, event_id // 100 AS file, event_id % 100 AS line_no, epoch_us(ts) // 1000 AS ms
  FROM events),
lines AS (
  SELECT 'tree/F' || file || '-1h-2024-01-01.zip' AS src_path, 'F' || file AS symbol,
    '1h' AS "interval", line_no,
    CASE WHEN file % 2 = 0 AND line_no = 0 THEN '{_LINE_HEADER}' ELSE
      ms || ',' || user_id || '.25,' || (user_id + 2) || '.5,' || user_id || '.125,'
      || (user_id + 1) || '.0,'
      || CASE WHEN file % 11 = 0 AND line_no = 57 THEN 'x1' ELSE (event_id % 7) || '.75' END
      || ',' || (ms + 3599999)
      || ',' || CASE WHEN event_id % 13 = 0 THEN '' ELSE (event_id % 1000) || 'e-1' END
      || ',' || CASE WHEN file % 23 = 5 AND line_no = 30 THEN '' ELSE CAST(event_id % 50 AS VARCHAR) END
      || ',' || CASE WHEN event_id % 17 = 0 THEN 'NA' ELSE (event_id % 11) || '.5' END
      || ',' || (event_id % 9) || '.5,0' END AS line
  FROM numbered),
cells AS (
  SELECT *, string_split(line, ',') AS c FROM lines),
body AS (
  SELECT * FROM cells WHERE NOT (line_no = 0 AND NOT regexp_full_match(c[1], '[0-9]+'))),
typed AS (
  SELECT src_path, symbol, "interval", line_no,
    try_cast(c[1] AS BIGINT) AS open_time, try_cast(c[7] AS BIGINT) AS close_time,
    try_cast(c[2] AS DOUBLE) AS open_price, try_cast(c[3] AS DOUBLE) AS high_price,
    try_cast(c[4] AS DOUBLE) AS low_price, try_cast(c[5] AS DOUBLE) AS close_price,
    try_cast(c[6] AS DOUBLE) AS volume, try_cast(c[8] AS DOUBLE) AS quote_volume,
    try_cast(c[9] AS BIGINT) AS trades_count, try_cast(c[10] AS DOUBLE) AS taker_buy_volume,
    try_cast(c[11] AS DOUBLE) AS taker_buy_quote_volume, c
  FROM body),
judged AS (
  SELECT *, open_time IS NULL OR close_time IS NULL OR trades_count IS NULL
    OR (open_price IS NULL AND c[2] NOT IN ('', 'NA')) OR (high_price IS NULL AND c[3] NOT IN ('', 'NA'))
    OR (low_price IS NULL AND c[4] NOT IN ('', 'NA')) OR (close_price IS NULL AND c[5] NOT IN ('', 'NA'))
    OR (volume IS NULL AND c[6] NOT IN ('', 'NA')) OR (quote_volume IS NULL AND c[8] NOT IN ('', 'NA'))
    OR (taker_buy_volume IS NULL AND c[10] NOT IN ('', 'NA'))
    OR (taker_buy_quote_volume IS NULL AND c[11] NOT IN ('', 'NA')) AS bad
  FROM typed)"""

MARKERS = """
names AS (
  SELECT DISTINCT CASE WHEN user_id % 13 = 0 THEN '_success__' ELSE '_SUCCESS__' END
    || strftime(ts, '%Y-%m-%d') || '__'
    || CASE WHEN user_id % 17 = 0 THEN 'UM' WHEN user_id % 3 = 0 THEN 'cm' ELSE 'um' END || '__'
    || (['1m', '1h', '4h', '1d'])[event_id % 4 + 1] AS name
  FROM events),
ingested AS (
  SELECT DISTINCT '_SUCCESS__' || strftime(ts, '%Y-%m-%d') || '__'
    || CASE WHEN user_id % 3 = 0 THEN 'cm' ELSE 'um' END || '__'
    || (['1m', '1h', '4h', '1d'])[day(ts) % 4 + 1] AS name
  FROM events),
parsed AS (
  SELECT name, split_part(name, '__', 2) AS date, split_part(name, '__', 3) AS market,
    split_part(name, '__', 4) AS "interval"
  FROM names
  WHERE regexp_full_match(name, '_SUCCESS__[0-9]{4}-[0-9]{2}-[0-9]{2}__[a-z]+__[0-9A-Za-z_]+')),
pending AS (
  SELECT * FROM parsed p WHERE NOT EXISTS (SELECT 1 FROM ingested i WHERE i.name = p.name))"""

_VALUE_TEXT = """CASE o_orderkey % 8
    WHEN 0 THEN 'nan' WHEN 1 THEN 'inf' WHEN 2 THEN 'abc' WHEN 3 THEN NULL
    WHEN 4 THEN '1_000' WHEN 5 THEN ' 42 '
    ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END"""

FACTOR_TEXT = f"""
texts AS (
  SELECT o_orderstatus AS symbol, o_orderkey,
    CASE o_orderkey % 5
      WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 10:30:00'
      WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z'
      WHEN 3 THEN 'not-a-date' ELSE NULL END AS time,
    CASE WHEN o_orderkey % 2 = 0 THEN 'price' ELSE 'cost' END AS factor_name,
    {_VALUE_TEXT} AS raw_value
  FROM orders),
coerced AS (
  SELECT symbol, factor_name,
    try_cast(replace(replace(time, 'T', ' '), 'Z', '') AS TIMESTAMP) AS datetime,
    CASE WHEN raw_value IN ('nan') OR raw_value LIKE '%\\_%' ESCAPE '\\' THEN NULL
      ELSE try_cast(trim(raw_value) AS DOUBLE) END AS factor_value
  FROM texts)"""

FACTOR_WRITE = f"""
given AS (
  SELECT CASE WHEN o_orderkey % 101 = 0 THEN ' ' ELSE o_orderstatus END AS symbol,
    CASE o_orderkey % 7
      WHEN 0 THEN date_trunc('day', o_orderdate)
      WHEN 1 THEN date_trunc('day', o_orderdate) + INTERVAL '10 hours 30 minutes'
      WHEN 2 THEN date_trunc('day', o_orderdate) + INTERVAL '2 hours 30 minutes 250 milliseconds'
      WHEN 3 THEN make_timestamp((1704067200 + o_orderkey) * 1000000)
      WHEN 4 THEN make_timestamp((1704067200123 + o_orderkey) * 1000)
      WHEN 5 THEN make_timestamp(20240101::BIGINT * 1000000)
      ELSE CASE WHEN o_orderkey % 3 = 0 THEN NULL
        ELSE date_trunc('day', o_orderdate) + INTERVAL '23 hours 59 minutes' END END AS datetime,
    CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderpriority END AS factor_name,
    try_cast({_VALUE_TEXT} AS DOUBLE) AS number
  FROM orders),
judged AS (
  SELECT *, CASE WHEN number IS NULL OR isnan(number) OR isinf(number) THEN NULL
      ELSE number END AS factor_value
  FROM given),
faults AS (
  SELECT *, CASE WHEN trim(symbol) = '' THEN 'symbol'
    WHEN coalesce(trim(factor_name), '') = '' THEN 'factor_name'
    WHEN factor_value IS NULL THEN 'dropped'
    WHEN datetime IS NULL THEN 'datetime' END AS fault
  FROM judged)"""

FACTORS = """
wide AS (
  SELECT o_orderstatus AS symbol, o_orderdate AS datetime, o_orderkey, o_orderpriority AS source,
    o_totalprice, CAST(o_custkey AS DOUBLE) AS custkey FROM orders),
versions AS (
  SELECT symbol, datetime, o_orderkey, source, 'price' AS factor_name, o_totalprice AS factor_value FROM wide
  UNION ALL
  SELECT symbol, datetime, o_orderkey, source, 'cust', custkey FROM wide),
factors AS (
  SELECT * FROM versions
  QUALIFY row_number() OVER (PARTITION BY symbol, datetime, factor_name ORDER BY o_orderkey DESC) = 1)"""

SNAPSHOTS = """
entries AS (
  SELECT event_type AS market, event_id // 200 AS block, event_id, epoch_us(ts) // 1000 AS ms,
    '{"symbol":"S' || event_id || '","quoteAsset":"' || (['USDT', 'USDC', 'BTC'])[user_id % 3 + 1] || '"'
    || CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 5 = 0 THEN ',"baseAsset":"USDC"'
         ELSE ',"baseAsset":"B' || user_id || '"' END
    || CASE WHEN event_id % 3 = 0 THEN ',"onboardDate":' || (epoch_us(ts) // 1000) ELSE '' END
    || ',"deliveryDate":4133404800000,"underlyingType":"COIN","status":"'
    || CASE WHEN event_id % 4 = 0 THEN 'BREAK' ELSE 'TRADING' END || '"}' AS entry
  FROM events),
blocks AS (
  SELECT market, block, max(ms) AS ms, string_agg(entry, ',' ORDER BY event_id) AS body
  FROM entries GROUP BY market, block),
snapshots AS (
  SELECT market, block, ms,
    CASE WHEN block % 9 = 8 THEN 'time' ELSE 'exchangeInfo' END AS endpoint,
    CASE WHEN (block + length(market)) % 4 = 0 THEN 500 ELSE 200 END AS status_code,
    '{"symbols":[' || body || ']' || CASE WHEN block % 2 = 0 THEN ',"assets":['
      || array_to_string(generate_series(0, block % 5), ',') || ']' ELSE '' END || '}' AS payload
  FROM blocks),
latest AS (
  SELECT * FROM snapshots WHERE endpoint = 'exchangeInfo' AND status_code = 200
  QUALIFY row_number() OVER (PARTITION BY market ORDER BY ms DESC) = 1),
listed AS (
  SELECT market, unnest(CAST(json_extract(payload, '$.symbols') AS JSON[])) AS e FROM latest),
symbols AS (
  SELECT market,
    coalesce(json_extract_string(e, '$.symbol'), '') AS symbol,
    coalesce(json_extract_string(e, '$.quoteAsset'), '') AS "quoteAsset",
    coalesce(CAST(json_extract_string(e, '$.onboardDate') AS BIGINT), 0) AS "onboardDate",
    coalesce(CAST(json_extract_string(e, '$.deliveryDate') AS BIGINT), 0) AS "deliveryDate",
    coalesce(json_extract_string(e, '$.underlyingType'), '') AS "underlyingType",
    coalesce(json_extract_string(e, '$.status'), '') AS status,
    coalesce(json_extract_string(e, '$.baseAsset'), '') AS base
  FROM listed)"""

PULLS = f"""{SNAPSHOTS},
pulls AS (
  SELECT market, CAST(block AS VARCHAR) AS name, ms AS pulled_ms,
    CASE WHEN block % 4 = 0 AND (block % 5 = 3 OR block % 2 = 0) THEN 'https://pull/' || market
      WHEN block % 5 = 3 THEN NULL ELSE 'file:/landed/' || market || '/' || block || '.json' END AS source_url,
    CAST(CASE WHEN block % 5 = 3 THEN CASE WHEN block % 2 = 0 THEN 503 ELSE 0 END ELSE 200 END AS INTEGER)
      AS status_code,
    CASE WHEN block % 5 = 3 OR block % 2 = 0 THEN block % 100 ELSE 0 END AS latency_ms,
    CASE WHEN block % 5 = 3 THEN '' WHEN block % 7 = 6 THEN substring(payload, 2) ELSE payload END AS payload,
    CASE WHEN block % 5 = 3 THEN 'timed out' END AS err_msg
  FROM snapshots)"""

_SYMBOL_COLUMNS = 'market, symbol, "quoteAsset", "onboardDate", "deliveryDate", "underlyingType", status'
_STABLE = "'BKRW','USDC','USDP','TUSD','BUSD','FDUSD','DAI','EUR','GBP','USBP','SUSD','PAXG','AEUR'"

# -------------------------------------------------------------------- queries

_START, _END = 1704412800000, 1705752000000  # 2024-01-05 and 2024-01-20T12:00 UTC


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def oracle_sql() -> dict[str, str]:
    ranged = f"\"interval\" = '1h' AND open_time >= {_START} AND open_time <= {_END}"
    many = f"symbol IN ('view', 'click', 'purchase') AND {ranged}"
    reasons = """array_to_string(list_filter([
      CASE WHEN open_price <= 0 OR high_price <= 0 OR low_price <= 0 OR close_price <= 0
        THEN 'non-positive price at ' || open_time END,
      CASE WHEN high_price < greatest(open_price, close_price)
        THEN 'high < max(open, close) at ' || open_time END,
      CASE WHEN low_price > least(open_price, close_price)
        THEN 'low > min(open, close) at ' || open_time END,
      CASE WHEN high_price < low_price THEN 'high < low at ' || open_time END,
      CASE WHEN volume < 0 THEN 'negative volume at ' || open_time END],
      lambda r: r IS NOT NULL), '; ')"""
    stats = f"""{GRID},
counts AS (SELECT src_path, symbol, "interval", count(*) AS rows_in FROM feed GROUP BY ALL),
firsts AS (SELECT src_path, count(*) AS n FROM dedup GROUP BY src_path),
per_file AS (
  SELECT c.src_path, c.symbol, c."interval", c.rows_in, c.rows_in - f.n AS duplicates_removed,
    f.n - coalesce(e.n, 0) AS invalid_removed,
    CASE WHEN e.n IS NULL OR e.n < 2 OR e.n = e.m THEN 0 ELSE e.m - e.n END AS gaps_filled,
    CASE WHEN e.n IS NULL THEN 0 WHEN e.n < 2 OR e.n = e.m THEN e.n ELSE e.m END AS rows_out
  FROM counts c JOIN firsts f USING (src_path) LEFT JOIN extent e USING (src_path))"""
    return {
        "clean_dedup_first": _with(DEDUP, "SELECT * FROM dedup"),
        "clean_valid": _with(VALID, "SELECT * FROM valid"),
        "clean_invalid_report": _with(DEDUP, f"""
            SELECT src_path, line_no, open_time, {reasons} AS reasons FROM dedup
            WHERE NOT {_IS_VALID}
            QUALIFY row_number() OVER (PARTITION BY src_path ORDER BY line_no) <= 10"""),
        "clean_gap_fill": _with(GRID, """
            SELECT src_path, open_time, close_time, close_price, trades_count FROM filled
            WHERE line_no IS NULL"""),
        "clean_full": _with(
            GRID, "SELECT * REPLACE (coalesce(line_no, -1) AS line_no) FROM filled"),
        "clean_stats": _with(stats, "SELECT * FROM per_file"),
        "ingest_totals": _with(stats, """
            SELECT count(*) AS files_processed, count(DISTINCT symbol) AS symbols_processed,
              CAST(sum(rows_out) AS BIGINT) AS records_written,
              CAST(sum(duplicates_removed) AS BIGINT) AS duplicates_removed,
              CAST(sum(gaps_filled) AS BIGINT) AS gaps_filled,
              CAST(sum(invalid_removed) AS BIGINT) AS invalid_records_removed
            FROM per_file"""),
        "file_time_range": _with(KLINE_FEED, """
            SELECT src_path, arg_min(open_time, line_no) AS first_time,
              arg_max(open_time, line_no) AS last_time FROM feed GROUP BY src_path"""),
        "kline_latest": _with(KLINES, """
            SELECT "interval", symbol, open_time, close_price, CAST(version AS BIGINT) AS version
            FROM klines"""),
        "kline_query_one": _with(KLINES, f"""
            SELECT {_KLINE_COLUMNS} FROM klines WHERE symbol = 'view' AND {ranged}"""),
        "kline_query_many": _with(KLINES, f"SELECT {_KLINE_COLUMNS} FROM klines WHERE {many}"),
        "kline_query_limit": _with(KLINES, f"""
            SELECT {_KLINE_COLUMNS} FROM klines WHERE {many} ORDER BY symbol, open_time LIMIT 100"""),
        "kline_page_after": _with(KLINES, f"""
            SELECT {_KLINE_COLUMNS} FROM klines WHERE {many}
              AND (symbol > 'click' OR (symbol = 'click' AND open_time > 1705000000000))
            ORDER BY symbol, open_time LIMIT 250"""),
        "kline_batches": _with(KLINES, f"""
            SELECT {_KLINE_COLUMNS},
              (row_number() OVER (ORDER BY symbol, open_time) - 1) // 100 AS batch_id
            FROM klines WHERE "interval" = '1h' AND symbol IN ('view', 'click', 'purchase', 'error')"""),
        "kline_counts_by_symbol": _with(KLINES, """
            SELECT symbol, count(*) AS rows FROM klines WHERE "interval" = '1h' GROUP BY symbol"""),
        "partition_month": _with(KLINES, """
            SELECT symbol, "interval", open_time,
              CAST(strftime(make_timestamp(open_time * 1000), '%Y%m') AS INTEGER) AS month
            FROM versions"""),
        "file_name_fields": _with(FILE_NAMES, """
            SELECT event_id, src_path, symbol, "interval", date, monthly FROM described"""),
        "file_filter": _with(FILE_NAMES, """
            SELECT event_id, src_path, own_symbol AS symbol, "interval" FROM described
            WHERE "interval" IN ('1m', '1h') AND own_symbol IN ('SYM1', 'SYM2', 'SYM3', '')"""),
        "interval_ms": _with(FILE_NAMES, f"""
            SELECT event_id, "interval", CASE "interval" WHEN '1m' THEN 60000 WHEN '1h' THEN {_HOUR}
              WHEN '1d' THEN {_DAY} ELSE 0 END::BIGINT AS step_ms FROM described"""),
        "has_data_day": _with(STORED, f"""
            SELECT src_path, symbol, "interval", date FROM files f
            WHERE date IS NOT NULL AND NOT monthly AND {_STORED_DAY}"""),
        "has_data_month": _with(STORED, f"""
            SELECT src_path, symbol, "interval", date FROM files f
            WHERE date IS NOT NULL AND monthly AND {_STORED_MONTH}"""),
        "skip_existing": _with(STORED, f"""
            SELECT src_path, symbol, "interval", date FROM files f
            WHERE date IS NULL OR NOT (CASE WHEN monthly THEN {_STORED_MONTH} ELSE {_STORED_DAY} END)"""),
        "ledger_days": _with(LEDGER, 'SELECT symbol, "interval", CAST(day AS VARCHAR) AS day FROM finished'),
        "ledger_open_files": _with(LEDGER, """
            SELECT src_path FROM begun EXCEPT SELECT src_path FROM begun SEMI JOIN runs USING (run)"""),
        "ledger_skip": _with(LEDGER, """
            SELECT src_path, symbol, "interval", date FROM files f
            WHERE date IS NULL OR NOT EXISTS (
              SELECT 1 FROM finished s WHERE s.symbol = f.symbol AND s."interval" = f."interval"
                AND CASE WHEN monthly THEN strftime(s.day, '%Y-%m') = substring(f.date, 1, 7)
                    ELSE s.day = CAST(f.date AS DATE) END)"""),
        "csv_typed_strict": _with(CSV_LINES, """
            SELECT symbol, open_time, close_time, open_price, high_price, low_price, close_price,
              volume, quote_volume, trades_count, taker_buy_volume, taker_buy_quote_volume,
              "interval", src_path, line_no
            FROM judged WHERE src_path NOT IN (SELECT src_path FROM judged WHERE bad)"""),
        "csv_rejected_files": _with(CSV_LINES, """
            SELECT src_path, 'not numeric at line ' || min(line_no) AS reason
            FROM judged WHERE bad GROUP BY src_path"""),
        "pending_markers": _with(MARKERS, 'SELECT name, date, market, "interval" FROM pending'),
        "marker_files": _with(f"{MARKERS},{FILE_NAMES}", """
            SELECT DISTINCT d.src_path, p."interval", p.date FROM described d
            JOIN (SELECT DISTINCT "interval", date FROM pending) p
              ON d.src_path LIKE '%-' || p."interval" || '-' || p.date || '.zip'"""),
        "factor_unpivot": """
            SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS symbol,
              CAST(l_shipdate AS TIMESTAMP) AS datetime, factor_name, factor_value,
              'coinmetrics' AS source
            FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
                             l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
                  ON l_quantity, l_extendedprice, l_discount, l_tax
                  INTO NAME factor_name VALUE factor_value)""",
        "factor_coerce": _with(FACTOR_TEXT, """
            SELECT symbol, factor_name, datetime, factor_value, 'coinmetrics' AS source FROM coerced
            WHERE datetime IS NOT NULL AND factor_value IS NOT NULL"""),
        "factor_drop_stats": _with(FACTOR_TEXT, """
            SELECT symbol, count(*) AS cells,
              count(*) FILTER (datetime IS NOT NULL AND factor_value IS NOT NULL) AS rows_kept,
              count(*) FILTER (datetime IS NULL OR factor_value IS NULL) AS dropped_non_numeric
            FROM coerced GROUP BY symbol"""),
        "factor_write_rows": _with(FACTOR_WRITE, """
            SELECT symbol, datetime, factor_name, factor_value, 'sdk' AS source FROM faults
            WHERE fault IS NULL"""),
        "factor_write_faults": _with(FACTOR_WRITE, """
            SELECT coalesce(fault, 'none') AS fault, count(*) AS rows FROM faults GROUP BY 1"""),
        "factor_latest": _with(FACTORS, """
            SELECT symbol, datetime, factor_name, factor_value, source FROM factors"""),
        "factor_query_long": _with(FACTORS, """
            SELECT symbol, datetime, factor_name, factor_value FROM factors
            WHERE symbol IN ('O', 'F') AND factor_name IN ('price', 'cust')
              AND datetime >= TIMESTAMP '1995-01-01' AND datetime <= TIMESTAMP '1998-06-30'"""),
        "factor_query_wide": _with(FACTORS, """
            SELECT symbol, datetime, max(factor_value) FILTER (factor_name = 'price') AS price,
              max(factor_value) FILTER (factor_name = 'cust') AS cust
            FROM factors GROUP BY symbol, datetime"""),
        "factor_coverage": _with(FACTORS, """
            SELECT symbol, source, count(*) AS rows, min(datetime) AS min_datetime,
              max(datetime) AS max_datetime FROM factors GROUP BY symbol, source"""),
        "snapshot_latest": _with(SNAPSHOTS, "SELECT market, ms AS pulled_ms, payload FROM latest"),
        "snapshot_symbols": _with(SNAPSHOTS, f"SELECT {_SYMBOL_COLUMNS} FROM symbols"),
        "snapshot_symbols_filtered": _with(SNAPSHOTS, f"""
            SELECT {_SYMBOL_COLUMNS} FROM symbols
            WHERE "quoteAsset" = 'USDT' AND base NOT IN ({_STABLE})"""),
        "snapshot_hash": _with(SNAPSHOTS, """
            SELECT market, block, sha256(payload) AS payload_hash FROM snapshots"""),
        "factor_file_cells": """
            WITH rows AS (
              SELECT o_orderstatus AS symbol, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS datetime, *
              FROM orders WHERE o_orderkey % 4 < 3)
            SELECT symbol, datetime, 'A' AS factor_name,
              CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS factor_value, 'coinmetrics' AS source
            FROM rows
            UNION ALL SELECT symbol, datetime, 'A.1', CAST(o_custkey AS DOUBLE), 'coinmetrics' FROM rows
            UNION ALL SELECT symbol, datetime, 'Note', CAST(o_custkey AS DOUBLE), 'coinmetrics' FROM rows
              WHERE o_orderkey % 5 <> 0
            UNION ALL SELECT symbol, datetime, 'Flag', CASE WHEN o_orderkey % 3 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE,
              'coinmetrics' FROM rows WHERE o_orderkey % 3 < 2
            UNION ALL SELECT symbol, datetime, f.name, CAST(o_custkey AS DOUBLE), 'coinmetrics'
            FROM (
              SELECT k.kind || '_' || o_orderstatus AS symbol, o_orderkey, o_custkey,
                CASE k.kind WHEN 'name' THEN date_trunc('minute', o_orderdate)
                  WHEN 'eu' THEN CASE WHEN o_orderkey = min(o_orderkey) OVER (PARTITION BY o_orderstatus)
                    THEN TIMESTAMP '1999-12-31' ELSE date_trunc('day', o_orderdate) END
                  ELSE date_trunc('day', o_orderdate) END AS datetime
              FROM orders, (VALUES ('us'), ('eu'), ('name')) k(kind)) t, (VALUES ('A\nlong name'), ('B')) f(name)
            WHERE f.name = 'B' OR o_orderkey % 3 <> 0""",
        "factor_rejects": """
            SELECT 'csv/bad' || n_nationkey || '.csv' AS src_path,
              CASE WHEN n_nationkey % 2 = 0 THEN 'missing required ''time'' column'
                ELSE 'a line has more cells than the header' END AS reason
            FROM nation""",
        "archive_rows": _with(CSV_LINES, """
            SELECT src_path, line_no, symbol, "interval", open_time, high_price, trades_count
            FROM judged WHERE src_path NOT IN (SELECT src_path FROM judged WHERE bad)"""),
        "kline_table_rows": _with(KLINES, """
            SELECT "interval", CAST(strftime(make_timestamp(open_time * 1000), '%Y%m') AS INTEGER) AS month,
              symbol, open_time, close_time, close_price, trades_count, line_no FROM versions"""),
        "factor_table_rows": """
            SELECT o_orderstatus AS symbol, CAST(o_orderdate AS TIMESTAMP) AS datetime, f.name AS factor_name,
              CASE f.name WHEN 'price' THEN o_totalprice ELSE CAST(o_custkey AS DOUBLE) END AS factor_value,
              o_orderpriority AS source, make_timestamp(o_orderkey * 1000000) AS update_time,
              CAST(strftime(CAST(o_orderdate AS TIMESTAMP), '%Y%m') AS INTEGER) AS month
            FROM orders, (VALUES ('price'), ('cust')) f(name)""",
        "snapshot_table_rows": _with(SNAPSHOTS, """
            SELECT market, 'exchangeInfo' AS endpoint, CAST(status_code AS INTEGER) AS status_code,
              sha256(payload) AS payload_hash,
              CAST(strftime(make_timestamp(ms * 1000), '%Y%m') AS INTEGER) AS month,
              make_timestamp(ms * 1000) AS pulled_at FROM snapshots"""),
        "snapshot_valid_json": """
            SELECT event_id, event_id % 10 NOT IN (3, 4, 6, 7) AS valid FROM events""",
        "snapshot_pulls": _with(PULLS, """
            SELECT market, name, pulled_ms, source_url, status_code, latency_ms, payload, err_msg FROM pulls"""),
        "snapshot_broken_pulls": _with(PULLS, """
            SELECT market, name FROM pulls WHERE status_code = 200 AND NOT json_valid(payload)"""),
        "snapshot_rows_of_pulls": _with(PULLS, """
            SELECT market, sha256(payload) AS payload_hash, status_code, err_msg, count(*) AS pulls,
              status_code = 200 AS seen FROM pulls GROUP BY ALL"""),
        "symbols_query": _with(SNAPSHOTS, f"""
            SELECT symbol, "quoteAsset", "onboardDate", "deliveryDate", "underlyingType", status FROM symbols
            WHERE market = 'click' AND "quoteAsset" = 'USDT' AND base NOT IN ({_STABLE})"""),
        "snapshot_counts": _with(SNAPSHOTS, """
            SELECT market, block,
              coalesce(json_array_length(json_extract(payload, '$.symbols')), 0) AS symbols_count,
              coalesce(json_array_length(json_extract(payload, '$.assets')), 0) AS assets_count
            FROM snapshots"""),
    }
