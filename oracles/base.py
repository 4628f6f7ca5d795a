"""Shared SQL fragments."""

from __future__ import annotations

BARS_1D = """
SELECT l_returnflag AS series, date_trunc('day', l_shipdate) AS ts,
  first(l_extendedprice / l_quantity ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS open,
  max(l_extendedprice / l_quantity) AS high,
  min(l_extendedprice / l_quantity) AS low,
  last(l_extendedprice / l_quantity ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS close,
  sum(l_quantity) AS volume
FROM lineitem GROUP BY ALL"""

BARS_1H = """
SELECT event_type AS series, date_trunc('hour', ts) AS ts,
  first(value ORDER BY events.ts, event_id) AS open, max(value) AS high, min(value) AS low,
  last(value ORDER BY events.ts, event_id) AS close,
  sum(CAST(props->>'$.k' AS DOUBLE)) AS volume
FROM events GROUP BY event_type, date_trunc('hour', ts)"""

BARS_1S = BARS_1H.replace("date_trunc('hour', ts)", "date_trunc('second', ts)")
SUPPLIER_BARS = BARS_1D.replace("l_returnflag AS series", "CAST(l_suppkey AS VARCHAR) AS series")

WITH_1D = f"WITH bars AS ({BARS_1D})"
WITH_1H = f"WITH bars AS ({BARS_1H})"


def shaped(sql: str, doubles: str = "", ints: str = "", digits: int = 6) -> str:
    """Round the named doubles and widen the named whole numbers of ``sql``."""
    parts = [f"round({c}, {digits}) + 0.0 AS {c}" for c in doubles.split()]
    parts += [f"CAST({c} AS BIGINT) AS {c}" for c in ints.split()]
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM ({sql}) AS result" if parts else sql


OHLCV = "open high low close volume"
