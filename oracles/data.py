"""SQL for loading, cleaning and inspecting bars."""

from __future__ import annotations

from oracles.base import BARS_1D, BARS_1H, OHLCV, WITH_1D, WITH_1H, shaped

REPEATED = """
SELECT l_returnflag AS series, l_shipdate AS ts, l_extendedprice / l_quantity AS price, l_quantity AS volume,
  l_orderkey AS batch FROM lineitem"""

NUMBERED = """numbered AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS pos,
  count(*) OVER (PARTITION BY series) AS size FROM bars)"""

SPLITS = """
span AS (SELECT series, min(ts) AS a, max(ts) AS b FROM bars GROUP BY series),
windows AS (
  SELECT series, t AS train_start, t + INTERVAL 7 DAY AS train_end, t + INTERVAL 7 DAY AS test_start,
    t + INTERVAL 8 DAY AS test_end
  FROM (SELECT series, b, unnest(generate_series(a, b - INTERVAL 8 DAY, INTERVAL 1 DAY)) AS t FROM span)),
counted AS (
  SELECT w.series, w.train_start, w.train_end, w.test_start, w.test_end, count(*) AS train_samples
  FROM windows w JOIN bars r ON r.series = w.series AND r.ts >= w.train_start AND r.ts < w.train_end
  GROUP BY ALL HAVING count(*) >= 150),
splits AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY train_start) AS split FROM counted)"""

ORACLES = {
    "csv_bars": shaped(BARS_1H, OHLCV),
    "stored_day": shaped(f"SELECT * FROM ({BARS_1H}) WHERE ts >= '2024-01-10' AND ts < '2024-01-11'", OHLCV),
    "overview_daily": shaped(
        f"""SELECT series, date_trunc('day', bars.ts) AS ts, arg_max(close, bars.ts) AS close, sum(volume) AS volume
FROM ({BARS_1H}) AS bars GROUP BY series, date_trunc('day', bars.ts)""",
        "close volume",
    ),
    "change_histogram": shaped(
        f"""WITH bars AS (SELECT series, close / lag(close) OVER (PARTITION BY series ORDER BY ts) - 1 AS x FROM ({BARS_1H})),
lim AS (SELECT series, min(x) AS lo, (max(x) - min(x)) / 50 AS w FROM bars GROUP BY series),
b AS (SELECT series, lo, w, CAST(least(floor((x - lo) / w), 49) AS BIGINT) AS bin FROM bars JOIN lim USING (series)
  WHERE x IS NOT NULL)
SELECT series, bin, lo + bin * w AS bin_lower, lo + bin * w + w AS bin_upper, count(*) AS count FROM b
GROUP BY series, bin, lo, w""",
        "bin_lower bin_upper",
    ),
    "sql_views": shaped(
        f"SELECT series, avg(close) AS mean_close, sum(volume) AS volume FROM ({BARS_1H}) GROUP BY series", "mean_close volume"
    ),
    "bars_1d": shaped(BARS_1D, OHLCV, digits=8),
    "bars_1h": shaped(BARS_1H, OHLCV),
    "payload_decode": shaped(BARS_1H, OHLCV),
    "ticker_decode": shaped(
        """SELECT event_type AS series, ts, value AS price, value - 0.5 AS bid, 0.0::DOUBLE AS ask,
  CASE WHEN event_type <> 'error' THEN CAST(props->>'$.k' AS DOUBLE) ELSE 0 END AS volume FROM events""",
        "price bid ask volume",
    ),
    "latest_quote": shaped(
        """SELECT event_type AS series, ts, value AS price, value - 0.5 AS bid, 0.0::DOUBLE AS ask,
  CASE WHEN event_type <> 'error' THEN CAST(props->>'$.k' AS DOUBLE) ELSE 0 END AS volume FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) = 1""",
        "price bid ask volume",
    ),
    "chunk_plan_300m": f"""{WITH_1H}, span AS (SELECT series, min(ts) AS a, max(ts) AS b FROM bars GROUP BY series),
tiles AS (SELECT series, b, unnest(generate_series(a, b, INTERVAL 300 MINUTE)) AS s FROM span)
SELECT series, CAST(row_number() OVER (PARTITION BY series ORDER BY s) - 1 AS BIGINT) AS chunk, s AS chunk_start,
  least(s + INTERVAL 300 MINUTE, b) AS chunk_end FROM tiles WHERE s < b""",
    "chunk_plan_30d": f"""{WITH_1D}, span AS (SELECT series, max(ts) AS b FROM bars GROUP BY series),
k AS (SELECT unnest(range(25)) AS chunk)
SELECT series, CAST(chunk AS BIGINT) AS chunk, b - to_days(CAST(least((chunk + 1) * 30, 730) AS INTEGER)) AS chunk_start,
  b - to_days(CAST(chunk * 30 AS INTEGER)) AS chunk_end FROM span CROSS JOIN k""",
    "timeframe_seconds": """
WITH f AS (SELECT CAST(l_quantity AS INTEGER)::VARCHAR || (['m', 'h', 'd'])[l_suppkey % 3 + 1] AS timeframe FROM lineitem)
SELECT timeframe, count(*) AS n, CAST(left(timeframe, length(timeframe) - 1) AS BIGINT)
  * CASE right(timeframe, 1) WHEN 'm' THEN 60 WHEN 'h' THEN 3600 ELSE 86400 END AS seconds
FROM f GROUP BY timeframe""",
    "recent_slice": shaped(
        f"""{WITH_1H} SELECT b.* FROM bars b JOIN (SELECT series, max(ts) AS m FROM bars GROUP BY series) USING (series)
WHERE ts >= m - INTERVAL 120 HOUR""",
        OHLCV,
    ),
    "min_history_flag": f"""{WITH_1H} SELECT series, count(*) AS rows, count(*) < 240 AS too_short
FROM bars b JOIN (SELECT series, max(ts) AS m FROM bars GROUP BY series) USING (series)
WHERE ts >= m - INTERVAL 120 HOUR GROUP BY series""",
    "dedup_first": shaped(
        f"""SELECT series, ts, price AS open, price AS high, price AS low, price AS close, volume, batch FROM ({REPEATED})
QUALIFY row_number() OVER (PARTITION BY series, ts ORDER BY batch, price, volume) = 1""",
        OHLCV,
        digits=8,
    ),
    "completeness": shaped(
        f"""{WITH_1H} SELECT series, count(*) AS actual_rows, 720::BIGINT AS expected_rows,
  count(*) / 720.0 * 100 AS completeness_pct FROM bars GROUP BY series""",
        "completeness_pct",
    ),
    "gap_report": f"""{WITH_1H} SELECT series, ts AS gap_start, nxt AS gap_end,
  CAST(date_diff('hour', ts, nxt) - 1 AS BIGINT) AS missing_bars
FROM (SELECT *, lead(ts) OVER (PARTITION BY series ORDER BY ts) AS nxt FROM bars) WHERE date_diff('hour', ts, nxt) > 1""",
    "quality_report": f"""WITH damaged AS (SELECT series, ts, CASE WHEN batch % 7 <> 0 THEN price END AS open, price AS high,
  price AS low, CASE WHEN batch % 11 = 0 THEN NULL ELSE price END AS close,
  CASE WHEN volume = 1 THEN 0 ELSE volume END AS volume FROM ({REPEATED}))
SELECT series, count(*) AS rows, CAST(count(*) * 5 - count(open) - count(high) - count(low) - count(close) - count(volume)
  AS BIGINT) AS missing_values, count(*) - count(DISTINCT ts) AS duplicate_stamps,
  count(*) FILTER (volume = 0) AS zero_volume_rows FROM damaged GROUP BY series""",
    "price_stats": shaped(
        f"""{WITH_1D} SELECT series, count(*) AS rows, min(ts) AS first_ts, max(ts) AS last_ts,
  date_diff('day', min(ts), max(ts)) AS duration_days, min(close) AS min_price, max(close) AS max_price,
  avg(close) AS mean_price, stddev_samp(close) AS std_price FROM bars GROUP BY series""",
        "min_price max_price mean_price std_price",
        digits=8,
    ),
    "histogram_50": shaped(
        f"""{WITH_1H}, lim AS (SELECT series, min(close) AS lo, (max(close) - min(close)) / 50 AS w FROM bars GROUP BY series),
b AS (SELECT series, lo, w, CAST(least(floor((close - lo) / w), 49) AS BIGINT) AS bin FROM bars JOIN lim USING (series))
SELECT series, bin, lo + bin * w AS bin_lower, lo + bin * w + w AS bin_upper, count(*) AS count FROM b
GROUP BY series, bin, lo, w""",
        "bin_lower bin_upper",
    ),
    "union_sources": shaped(
        f"""{WITH_1D} SELECT series, ts, open, high, low, close, CASE WHEN year(ts) > 1998 THEN volume + 1 ELSE volume END
  AS volume, CASE WHEN year(ts) > 1998 THEN 2 ELSE 1 END AS seq FROM bars""",
        OHLCV,
        "seq",
        digits=8,
    ),
    "key_intersect": f"{WITH_1H} SELECT series, ts FROM bars WHERE volume > 100 INTERSECT SELECT series, ts FROM bars WHERE close > 20",
    "key_difference": f"{WITH_1H} SELECT series, ts FROM bars EXCEPT SELECT series, ts FROM bars WHERE close > 20",
    "distinct_series": "SELECT DISTINCT event_type AS series FROM events",
    "head_rows": shaped(f"{WITH_1H}, {NUMBERED} SELECT * EXCLUDE (pos, size) FROM numbered WHERE pos < 100", OHLCV),
    "tail_rows": shaped(f"{WITH_1H}, {NUMBERED} SELECT * EXCLUDE (pos, size) FROM numbered WHERE pos >= size - 100", OHLCV),
    "latest_bar": shaped(f"{WITH_1D}, {NUMBERED} SELECT * EXCLUDE (pos, size) FROM numbered WHERE pos = size - 1", OHLCV, digits=8),
    "time_slice": shaped(f"{WITH_1H} SELECT * FROM bars WHERE ts >= '2024-01-08' AND ts < '2024-01-15'", OHLCV),
    "as_of_replay": shaped(
        f"""WITH known AS (SELECT * FROM ({BARS_1H}) WHERE ts <= '2024-01-20 12:00:00'),
bars AS (SELECT k.* FROM known k JOIN (SELECT series, max(ts) AS m FROM known GROUP BY series) USING (series)
  WHERE ts >= m - INTERVAL 120 HOUR),
f AS (SELECT *, lag(close, 1) OVER w AS close_lag_1, lag(close, 2) OVER w AS close_lag_2, lag(close, 5) OVER w AS close_lag_5,
  lag(close, 10) OVER w AS close_lag_10, avg(close) OVER w5 AS close_ma_5, stddev_samp(close) OVER w5 AS close_std_5,
  avg(close) OVER w20 AS close_ma_20, stddev_samp(close) OVER w20 AS close_std_20,
  close / lag(close, 1) OVER w - 1 AS price_change_1, close / lag(close, 5) OVER w - 1 AS price_change_5,
  avg(volume) OVER w5 AS volume_ma_5, volume / avg(volume) OVER w5 AS volume_ratio,
  row_number() OVER (PARTITION BY series ORDER BY ts DESC) AS age
FROM bars WINDOW w AS (PARTITION BY series ORDER BY ts),
  w5 AS (PARTITION BY series ORDER BY ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
  w20 AS (PARTITION BY series ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT * EXCLUDE (age) FROM f WHERE age = 1""",
        OHLCV
        + " close_lag_1 close_lag_2 close_lag_5 close_lag_10 close_ma_5 close_std_5 close_ma_20 close_std_20"
        + " price_change_1 price_change_5 volume_ma_5 volume_ratio",
    ),
    "active_hours": """SELECT event_type AS series, date_trunc('day', ts) AS day, count(*) AS n FROM events
WHERE hour(ts) BETWEEN 9 AND 17 AND isodow(ts) <= 5 AND minute(ts) IN (40, 45, 50, 55) GROUP BY ALL""",
    "rolling_splits": f"""{WITH_1H}, {SPLITS} SELECT series, train_start, train_end, test_start, test_end, train_samples,
  split FROM splits""",
    "split_assignment": f"""{WITH_1H}, {SPLITS}
SELECT r.series, r.ts, 'train' AS part, split FROM bars r JOIN splits s
  ON r.series = s.series AND r.ts >= train_start AND r.ts < train_end
UNION ALL SELECT r.series, r.ts, 'test', split FROM bars r JOIN splits s
  ON r.series = s.series AND r.ts >= test_start AND r.ts < test_end""",
    "positional_split": f"""{WITH_1D}, {NUMBERED} SELECT series, ts, CASE WHEN pos < floor(size * 0.8::DOUBLE) THEN 'train'
  ELSE 'test' END AS part FROM numbered""",
    "walk_forward_splits": f"""{WITH_1D}, n AS (SELECT series, count(*) AS size, CAST(floor(count(*) * 0.2::DOUBLE) AS BIGINT)
  AS test FROM bars GROUP BY series), k AS (SELECT unnest(range(5)) AS i)
SELECT series, CAST(i + 1 AS BIGINT) AS split, size - i * (test // 5) - test AS train_rows,
  size - i * (test // 5) - test AS test_start_pos, size - i * (test // 5) AS test_end_pos
FROM n CROSS JOIN k WHERE size - i * (test // 5) - test > test""",
}
