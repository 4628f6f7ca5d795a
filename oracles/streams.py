"""SQL for what the streaming jobs must have written once their input is used up."""

from __future__ import annotations

from oracles.base import BARS_1H, OHLCV, shaped
from oracles.features import BASIC, BASIC_WINDOWS, ENHANCED, SIMPLE, TARGET, WINDOWS, complete, picked

CLOSED = "(SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"

ISLANDS = """SELECT series, min(ts) AS start_ts, max(ts) + INTERVAL 30 MINUTE AS end_ts, count(*) AS ticks, sum(volume) AS volume,
  min(price) AS low, max(price) AS high FROM (SELECT *, sum(opens) OVER (PARTITION BY series ORDER BY ts) AS island FROM (
    SELECT event_type AS series, ts, value AS price, CAST(props->>'$.k' AS DOUBLE) AS volume,
      CASE WHEN ts <= lag(ts) OVER (PARTITION BY event_type ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM events))
GROUP BY series, island"""

LANDED = f"""WITH b AS (SELECT *, {picked(SIMPLE)} FROM ({BARS_1H})), span AS (SELECT min(epoch(ts)::BIGINT) AS f, max(epoch(ts)::BIGINT) AS l FROM b),
parted AS (SELECT b.*, (epoch(ts)::BIGINT - f) // ((l - f) // 3 + 1) AS part FROM b CROSS JOIN span),
scored AS (SELECT series, part, max(ts) AS ts FROM parted WHERE {" AND ".join(f"{c} IS NOT NULL" for c in SIMPLE)} GROUP BY series, part),
now AS (SELECT max(ts) + INTERVAL 5 MINUTE AS now FROM b)"""

ORACLES = {
    "live_health": shaped(
        f"""{LANDED}, told AS (SELECT series, (SELECT count(*) FROM scored s, now WHERE s.series = b.series AND s.ts > now - INTERVAL 1 HOUR) AS recent_forecasts,
  date_diff('second', max(ts), (SELECT now FROM now)) AS age FROM b GROUP BY series)
SELECT series, recent_forecasts, age / 60.0::DOUBLE AS data_age_minutes, recent_forecasts > 0 AS forecast_ok, age < 600 AS data_ok,
  recent_forecasts > 0 AND age < 600 AS healthy FROM told""",
        "data_age_minutes",
        "recent_forecasts",
    ),
    "stream_snapshots": f"""{LANDED} SELECT part AS batch_id, count(*) AS kept, (SELECT count(*) FROM scored s WHERE s.part = p.part) AS documents,
  count(*) AS input_rows, 0::BIGINT AS late_rows FROM parted p GROUP BY part""",
    "session_windows": shaped(ISLANDS, "volume low high"),
    "stream_sessions": shaped(f"SELECT * FROM ({ISLANDS}) WHERE end_ts <= {CLOSED}", "volume low high"),
    "stream_dedup": shaped(
        """SELECT event_type AS series, ts, value AS price, CAST(props->>'$.k' AS DOUBLE) AS volume, event_id FROM events""",
        "price volume",
    ),
    "stream_bars": shaped(f"SELECT * FROM ({BARS_1H}) WHERE ts + INTERVAL 1 HOUR <= {CLOSED}", OHLCV),
    "stream_sliding": shaped(
        f"""WITH placed AS (SELECT event_type AS series, value, unnest([date_trunc('hour', ts),
  date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS start_ts FROM events)
SELECT series, start_ts, start_ts + INTERVAL 2 HOUR AS end_ts, avg(value) AS mean, stddev_samp(value) AS std,
  min(value) AS low, max(value) AS high, count(*) AS count FROM placed
WHERE start_ts + INTERVAL 2 HOUR <= {CLOSED} GROUP BY series, start_ts""",
        "mean std low high",
    ),
    "stream_late_bars": f"""WITH b AS ({BARS_1H}), span AS (SELECT min(epoch(ts)::BIGINT) AS f, max(epoch(ts)::BIGINT) AS l FROM b)
SELECT series, count(*) AS in_time, count(*) FILTER ((epoch(ts)::BIGINT - f) // ((l - f) // 3 + 1) = 0) AS late
FROM b CROSS JOIN span GROUP BY series""",
    "stream_basic_features": complete(BASIC_WINDOWS, [c for c in BASIC if c not in TARGET]),
    "stream_enhanced_features": complete(WINDOWS, [c for c in ENHANCED if c not in TARGET]),
    "stream_features": shaped(f"SELECT *, {picked(SIMPLE)} FROM ({BARS_1H})", " ".join([OHLCV, *SIMPLE])),
}
