"""SQL for quantiles, probabilities, calibration and documents."""

from __future__ import annotations

from oracles.base import BARS_1D, BARS_1H, shaped

HORIZONS = (1, 2, 5, 10, 20)


def at(q: str) -> str:
    """Interpolated quantile of the sorted list m of 20 members."""
    rank = f"({q} * 19)"
    low, high = f"m[CAST(floor({rank}) AS INTEGER) + 1]", f"m[CAST(ceil({rank}) AS INTEGER) + 1]"
    return f"({low} + ({high} - {low}) * ({rank} - floor({rank})))"


def ensemble_sql() -> str:
    parts = [
        f"""SELECT series, ts, {h} AS horizon, close, close AS prediction, lead(close, {h}) OVER w AS actual,
  list(step_{h}) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS steps,
  count(step_{h}) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS n
  FROM stepped WINDOW w AS (PARTITION BY series ORDER BY ts)"""
        for h in HORIZONS
    ]
    steps = ", ".join(f"close - lag(close, {h}) OVER (PARTITION BY series ORDER BY ts) AS step_{h}" for h in HORIZONS)
    return f"""bars AS ({BARS_1H}), stepped AS (SELECT *, {steps} FROM bars),
spread AS ({" UNION ALL ".join(parts)}),
ens AS (SELECT series, ts, horizon, close, prediction, actual, list_sort(list_transform(steps, lambda s: s + close)) AS m
  FROM spread WHERE n = 20)"""


ENSEMBLE = ensemble_sql()
GRID = f"gridded AS (SELECT * EXCLUDE (m), list_transform(range(1, 100), lambda k: {at('(k / 100.0::DOUBLE)')}) AS g FROM ens)"


def cdf(t: str) -> str:
    n = f"len(list_filter(g, lambda v: v < {t}))"
    return f"""CASE WHEN {n} = 0 THEN 0.0::DOUBLE WHEN {n} = 99 THEN 1.0::DOUBLE
  ELSE ({n} + ({t} - g[{n}]) / (g[{n} + 1] - g[{n}])) / 100.0::DOUBLE END"""


PROBABILITY = f"""CASE op WHEN 'between' THEN ({cdf("high")}) - ({cdf("low")}) WHEN 'above' THEN 1 - ({cdf("low")})
  ELSE {cdf("low")} END"""
EVENT = """CASE op WHEN 'between' THEN actual >= low AND actual < high WHEN 'above' THEN actual >= low
  ELSE actual < low END"""

RELATIVE_RULES = (
    ("above_0.5pct", "above", "close * 1.005::DOUBLE", "NULL"),
    ("below_0.5pct", "below", "close * 0.995::DOUBLE", "NULL"),
    ("above_1pct", "above", "close * 1.01::DOUBLE", "NULL"),
    ("below_1pct", "below", "close * 0.99::DOUBLE", "NULL"),
    ("between_0.2pct", "between", "close * 0.998::DOUBLE", "close * 1.002::DOUBLE"),
)
RELATIVE = " UNION ALL ".join(
    f"SELECT *, '{q}' AS query, '{op}' AS op, {low} AS low, CAST({high} AS DOUBLE) AS high FROM gridded"
    for q, op, low, high in RELATIVE_RULES
)
SCORED = f"""{ENSEMBLE}, {GRID}, asked AS ({RELATIVE}),
scored AS (SELECT series, ts, horizon, query, round({PROBABILITY}, 9) + 0.0 AS probability,
  CAST(CAST({EVENT} AS INTEGER) AS DOUBLE) AS event FROM asked)"""


def live_rules(price: str) -> str:
    p, base = price, f"(round_even({price} / 100, 0) * 100)"
    rules = []
    for pct, up, down in (("0.5", "1.005", "0.995"), ("1.0", "1.01", "0.99"), ("2.0", "1.02", "0.98"), ("5.0", "1.05", "0.95")):
        rules.append((f"'above_{pct}pct'", "above", f"{p} * {up}::DOUBLE", "NULL"))
        rules.append((f"'below_{pct}pct'", "below", f"{p} * {down}::DOUBLE", "NULL"))
    for d in (500, 1000, 2000):
        rules.append((f"'above_' || CAST(trunc({base} + {d}) AS BIGINT)", "above", f"{base} + {d}", "NULL"))
        rules.append((f"'below_' || CAST(trunc({base} - {d}) AS BIGINT)", "below", f"{base} - {d}", "NULL"))
    lo, hi = f"{p} * 0.995::DOUBLE", f"{p} * 1.005::DOUBLE"
    rules.append((f"'between_' || CAST(trunc({lo}) AS BIGINT) || '_' || CAST(trunc({hi}) AS BIGINT)", "between", lo, hi))
    return " UNION ALL ".join(
        f"SELECT series, {q} AS query, '{op}' AS op, CAST({low} AS DOUBLE) AS low, CAST({high} AS DOUBLE) AS high FROM prices"
        for q, op, low, high in rules
    )


def percent_rules() -> str:
    rules = []
    for up, down in (("1.01", "0.99"), ("1.02", "0.98")):
        rules.append(("above", f"price * {up}::DOUBLE"))
        rules.append(("below", f"price * {down}::DOUBLE"))
    out = [
        f"SELECT series, '{op}_' || CAST(trunc({v}) AS BIGINT) AS query, '{op}' AS op, {v} AS low, NULL::DOUBLE AS high FROM prices"
        for op, v in rules
    ]
    lo, hi = "price * 0.995::DOUBLE", "price * 1.005::DOUBLE"
    out.append(
        f"SELECT series, 'between_' || CAST(trunc({lo}) AS BIGINT) || '_' || CAST(trunc({hi}) AS BIGINT), 'between', {lo}, {hi} FROM prices"
    )
    return " UNION ALL ".join(out)


PRICES = "prices AS (SELECT series, arg_max(close, ts) AS price FROM bars GROUP BY series)"
WITH_LIVE = f"""WITH {ENSEMBLE}, {GRID}, {PRICES}, rules AS ({live_rules("price")})"""
ASKED_LIVE = f"""asked AS (SELECT g.*, query, op, low, high FROM gridded g JOIN rules USING (series))"""
LAST = "last AS (SELECT series, max(ts) AS ts FROM ens GROUP BY series)"

FIFTH = "lambda x: (x * x % 2147483647) * (x * x % 2147483647) % 2147483647 * x % 2147483647"
DRAWN = f"""WITH {ENSEMBLE}, {GRID}, keyed AS (SELECT *, CAST('0x' || substr(md5('42|' || series || '|' ||
  CAST(epoch(ts) AS BIGINT) || '|' || horizon), 1, 8) AS BIGINT) % 2147483647 AS key FROM gridded),
fifths AS (SELECT * EXCLUDE (key), list_transform(list_transform(range(1, 1001), lambda d: (key + d * 1000003) % 2147483647), {FIFTH}) AS a FROM keyed),
mixed AS (SELECT * EXCLUDE (a), list_transform(list_transform(a, lambda x, i: (x + i * 7919) % 2147483647), {FIFTH}) AS a FROM fifths),
spots AS (SELECT * EXCLUDE (a), list_transform(a, lambda x: (x + 0.5::DOUBLE) * 100 / 2147483647.0::DOUBLE) AS s FROM mixed),
drawn AS (SELECT * EXCLUDE (s), list_transform(s, lambda u: CASE WHEN u < 1 THEN g[1] WHEN u >= 99 THEN g[99]
  ELSE g[CAST(floor(u) AS INTEGER)] + (g[CAST(floor(u) AS INTEGER) + 1] - g[CAST(floor(u) AS INTEGER)]) * (u - floor(u)) END) AS v FROM spots)"""

LOSS = """-avg(event * ln(greatest(least(probability, 1 - 1e-15), 1e-15))
  + (1 - event) * ln(1 - greatest(least(probability, 1 - 1e-15), 1e-15)))"""
BINS = f"""WITH {SCORED}, bins AS (SELECT k / 20.0::DOUBLE AS lo, (k + 1) / 20.0::DOUBLE AS hi FROM (SELECT unnest(range(20)) AS k)),
curve AS (SELECT query, horizon, lo, hi, avg(probability) AS confidence, avg(event) AS accuracy, count(*) AS count
  FROM scored JOIN bins ON probability > lo AND probability <= hi WHERE event IS NOT NULL GROUP BY ALL)"""

ORACLES = {
    "member_quantiles": shaped(
        f"WITH {ENSEMBLE} "
        + " UNION ALL ".join(
            f"SELECT series, ts, horizon, {q}::DOUBLE AS q, {at(f'{q}::DOUBLE')} AS value FROM ens"
            for q in ("0.05", "0.25", "0.5", "0.75", "0.95")
        ),
        "q value",
        "horizon",
    ),
    "pinball_loss": shaped(
        f"WITH {ENSEMBLE}, levels AS ("
        + " UNION ALL ".join(
            f"SELECT horizon, actual, {q}::DOUBLE AS q, {at(f'{q}::DOUBLE')} AS value FROM ens WHERE actual IS NOT NULL"
            for q in ("0.05", "0.25", "0.5", "0.75", "0.95")
        )
        + """) SELECT q, horizon, avg(greatest(q * (actual - value), (q - 1) * (actual - value))) AS loss,
  count(*) AS n_samples FROM levels GROUP BY q, horizon""",
        "q loss",
        "horizon",
    ),
    "stored_quantiles": shaped(
        f"WITH {ENSEMBLE} SELECT series, ts, horizon, 0.25::DOUBLE AS q, {at('0.25::DOUBLE')} AS value FROM ens",
        "q value",
        "horizon",
    ),
    "prediction_intervals": shaped(
        f"WITH {ENSEMBLE} "
        + " UNION ALL ".join(
            f"""SELECT series, ts, horizon, {v}::DOUBLE AS level, {at(f'((1 - {v}::DOUBLE) / 2)')} AS lower,
  {at(f'(1 - (1 - {v}::DOUBLE) / 2)')} AS upper FROM ens"""
            for v in ("0.68", "0.95")
        ),
        "level lower upper",
        "horizon",
    ),
    "interval_coverage": shaped(
        f"WITH {ENSEMBLE}, banded AS ("
        + " UNION ALL ".join(
            f"""SELECT horizon, actual, {v}::DOUBLE AS level, {at(f'((1 - {v}::DOUBLE) / 2)')} AS lower,
  {at(f'(1 - (1 - {v}::DOUBLE) / 2)')} AS upper FROM ens WHERE actual IS NOT NULL"""
            for v in ("0.68", "0.95")
        )
        + """) SELECT level, horizon, avg(CASE WHEN actual BETWEEN lower AND upper THEN 1.0 ELSE 0.0 END) AS coverage,
  avg(upper - lower) AS mean_width, count(*) AS n_samples FROM banded GROUP BY level, horizon""",
        "level coverage mean_width",
        "horizon",
    ),
    "threshold_set": shaped(f"WITH bars AS ({BARS_1D}), {PRICES} {live_rules('price')}", "low high", digits=8),
    "percent_threshold_set": shaped(f"WITH bars AS ({BARS_1D}), {PRICES} {percent_rules()}", "low high", digits=8),
    "query_name_parse": shaped(
        f"""WITH bars AS ({BARS_1D}), named AS (SELECT series, ts, unnest([
  'above_' || CAST(trunc(close) AS BIGINT), 'below_' || CAST(trunc(close * 0.98::DOUBLE) AS BIGINT),
  'between_' || CAST(trunc(close * 0.995::DOUBLE) AS BIGINT) || '_' || CAST(trunc(close * 1.005::DOUBLE) AS BIGINT),
  'price']) AS query FROM bars),
digits AS (SELECT *, regexp_extract_all(query, '-?\\d+(?:\\.\\d+)?') AS d FROM named)
SELECT series, ts, query, CASE WHEN query LIKE '%between%' THEN 'between' WHEN query LIKE '%above%' THEN 'above'
  WHEN query LIKE '%below%' THEN 'below' END AS op, CAST(d[1] AS DOUBLE) AS low,
  CASE WHEN query LIKE '%between%' THEN CAST(d[2] AS DOUBLE) END AS high FROM digits""",
        "low high",
    ),
    "event_probabilities": shaped(
        f"""{WITH_LIVE}, {ASKED_LIVE} SELECT series, ts, horizon, query, {PROBABILITY} AS probability,
  CAST(CAST({EVENT} AS INTEGER) AS DOUBLE) AS event FROM asked""",
        "probability",
        "horizon",
    ),
    "probabilities_long": shaped(f"WITH {SCORED} SELECT * FROM scored", "probability", "horizon", digits=9),
    "probabilities_wide": shaped(
        f"""WITH {SCORED} SELECT series, ts, horizon, max(probability) FILTER (query = 'above_0.5pct') AS up_half,
  max(probability) FILTER (query = 'below_0.5pct') AS down_half, max(probability) FILTER (query = 'above_1pct') AS up_one,
  max(probability) FILTER (query = 'below_1pct') AS down_one, max(probability) FILTER (query = 'between_0.2pct') AS flat
FROM scored GROUP BY series, ts, horizon""",
        "up_half down_half up_one down_one flat",
        "horizon",
        digits=9,
    ),
    "sql_probabilities": shaped(
        f"""WITH {ENSEMBLE}, {GRID} SELECT series, ts, horizon, 'above_' || CAST(trunc(close * 1.01::DOUBLE) AS BIGINT) AS up,
  'between_' || CAST(trunc(close * 0.998::DOUBLE) AS BIGINT) || '_' || CAST(trunc(close * 1.002::DOUBLE) AS BIGINT) AS band, g[50] AS middle,
  1 - ({cdf("close * 1.01::DOUBLE")}) AS p_up, {cdf("close * 0.99::DOUBLE")} AS p_down,
  ({cdf("close * 1.002::DOUBLE")}) - ({cdf("close * 0.998::DOUBLE")}) AS p_band FROM gridded""",
        "middle p_up p_down p_band",
        "horizon",
    ),
    "sql_splits": f"""WITH bars AS ({BARS_1H}), span AS (SELECT series, min(ts) AS f, max(ts) AS l FROM bars GROUP BY series),
w AS (SELECT series, i AS number, f + to_days(CAST(i AS INTEGER)) AS train_start FROM span, range(1000) t(i) WHERE f + to_days(CAST(i + 8 AS INTEGER)) <= l)
SELECT series, number, train_start, train_start + INTERVAL 7 DAY AS test_start, train_start + INTERVAL 8 DAY AS test_end,
  (SELECT count(*) FROM bars b WHERE b.series = w.series AND b.ts >= train_start AND b.ts < train_start + INTERVAL 7 DAY) AS train_samples FROM w""",
    "sampled_distribution": shaped(
        f"""{DRAWN} SELECT series, ts, horizon, 1000 AS draws, list_avg(v) AS mean, list_stddev_pop(v) AS deviation,
  list_min(v) AS low, list_max(v) AS high FROM drawn""",
        "mean deviation low high",
        "horizon draws",
        digits=5,
    ),
    "sampled_probabilities": shaped(
        f"{DRAWN} "
        + " UNION ALL ".join(
            f"""SELECT series, ts, horizon, '{q}' AS query, len(list_filter(v, lambda x: {
                f'x >= {low} AND x < {high}' if op == 'between' else f'x >= {low}' if op == 'above' else f'x < {low}'
            })) / 1000.0::DOUBLE AS probability FROM drawn"""
            for q, op, low, high in RELATIVE_RULES
        ),
        "probability",
        "horizon",
    ),
    "probability_summary": shaped(
        f"""WITH {SCORED} SELECT query, horizon, avg(probability) AS mean_probability,
  stddev_pop(probability) AS std_probability, min(probability) AS min_probability, max(probability) AS max_probability
FROM scored GROUP BY query, horizon""",
        "mean_probability std_probability min_probability max_probability",
        "horizon",
    ),
    "brier_logloss": shaped(
        f"""WITH {SCORED} SELECT query, horizon, avg((probability - event) ** 2) AS brier_score, {LOSS} AS log_loss,
  count(*) AS n_samples FROM scored WHERE event IS NOT NULL GROUP BY query, horizon""",
        "brier_score log_loss",
        "horizon",
    ),
    "ece": shaped(
        f"""{BINS}, total AS (SELECT query, horizon, avg((probability - event) ** 2) AS brier_score, {LOSS} AS log_loss,
  count(*) AS n_samples FROM scored WHERE event IS NOT NULL GROUP BY query, horizon)
SELECT t.*, coalesce((SELECT sum(abs(confidence - accuracy) * count) FROM curve c
  WHERE c.query = t.query AND c.horizon = t.horizon), 0) / n_samples AS calibration_error FROM total t""",
        "brier_score log_loss calibration_error",
        "horizon",
    ),
    "calibration_curve": shaped(
        f"""{BINS} SELECT query, horizon, lo AS bin_lower, hi AS bin_upper, confidence, accuracy, count FROM curve""",
        "bin_lower bin_upper confidence accuracy",
        "horizon",
    ),
    "stored_documents": shaped(
        f"""{WITH_LIVE}, {ASKED_LIVE}, {LAST}
SELECT series, ts, form, close AS current_price, 'point_horizon_' || horizon || 'min' AS field, prediction AS value
FROM ens JOIN last USING (series, ts), (SELECT unnest(['json', 'flat']) AS form)
UNION ALL SELECT series, ts, form, close, 'prob_' || query || '_horizon_' || horizon || 'min', {PROBABILITY}
FROM asked JOIN last USING (series, ts), (SELECT unnest(['json', 'flat']) AS form)""",
        "current_price value",
    ),
    "forecast_flat": shaped(
        f"""{WITH_LIVE}, {ASKED_LIVE}, {LAST}
SELECT series, ts, close AS current_price, 'point_horizon_' || horizon || 'min' AS field, prediction AS value
FROM ens JOIN last USING (series, ts)
UNION ALL SELECT series, ts, close, 'prob_' || query || '_horizon_' || horizon || 'min', {PROBABILITY}
FROM asked JOIN last USING (series, ts)""",
        "current_price value",
    ),
    "document_quantiles": shaped(
        f"WITH {ENSEMBLE}, {LAST}, newest AS (SELECT ens.* FROM ens JOIN last USING (series, ts)) "
        + " UNION ALL ".join(
            f"""SELECT series, ts, 'q{round(float(q) * 100)}' AS label, 'horizon_' || horizon || 'min' AS horizon,
  {at(f'{q}::DOUBLE')} AS low, {at(f'{q}::DOUBLE')} AS high FROM newest"""
            for q in ("0.05", "0.25", "0.5", "0.75", "0.95")
        )
        + "".join(
            f""" UNION ALL SELECT series, ts, '{round(float(v) * 100)}pct', 'horizon_' || horizon || 'min',
  {at(f'((1 - {v}::DOUBLE) / 2)')}, {at(f'(1 - (1 - {v}::DOUBLE) / 2)')} FROM newest"""
            for v in ("0.68", "0.95")
        ),
        "low high",
    ),
    "forecast_health": shaped(
        f"""WITH bars AS ({BARS_1H}) SELECT series,
  count(*) FILTER (ts > TIMESTAMP '2024-01-20 12:05:00' - INTERVAL 1 HOUR) AS recent_forecasts,
  date_diff('second', max(ts), TIMESTAMP '2024-01-20 12:05:00') / 60.0::DOUBLE AS data_age_minutes,
  count(*) FILTER (ts > TIMESTAMP '2024-01-20 12:05:00' - INTERVAL 1 HOUR) > 0 AS forecast_ok,
  date_diff('second', max(ts), TIMESTAMP '2024-01-20 12:05:00') < 600 AS data_ok,
  count(*) FILTER (ts > TIMESTAMP '2024-01-20 12:05:00' - INTERVAL 1 HOUR) > 0
    AND date_diff('second', max(ts), TIMESTAMP '2024-01-20 12:05:00') < 600 AS healthy
FROM bars WHERE ts <= '2024-01-20 12:05:00' GROUP BY series""",
        "data_age_minutes",
    ),
}
