"""SQL for what must hold whatever numbers a fit comes to."""

from __future__ import annotations

from oracles import regressions
from oracles.base import BARS_1H, shaped
from oracles.features import SIMPLE, clean_table

HORIZONS = (1, 5, 20)
TEST = f"""WITH clean AS ({clean_table(BARS_1H)}), numbered AS (SELECT *,
  row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS pos, count(*) OVER (PARTITION BY series) AS size FROM clean),
test AS (SELECT * FROM numbered WHERE pos >= floor(size * 0.8::DOUBLE))"""
EACH = f"(SELECT unnest([{', '.join(map(str, HORIZONS))}]) AS horizon)"
BOUNDS = "train_start train_end test_start test_end"


def members(trees: int) -> str:
    return shaped(
        f"""{TEST} SELECT series, horizon, count(*) AS rows, {trees} AS members, 0 AS falling, 0 AS off_mean
FROM test CROSS JOIN {EACH} GROUP BY series, horizon""",
        "",
        "horizon rows members falling off_mean",
    )


WINDOWS = f"""WITH clean AS ({clean_table(BARS_1H)}), span AS (SELECT min(ts) AS f, max(ts) AS l FROM clean),
k AS (SELECT f + to_days(CAST(i AS INTEGER)) AS train_start, l FROM span, range(10000) t(i) WHERE f + to_days(CAST(i + 8 AS INTEGER)) <= l),
w AS (SELECT train_start, train_start + INTERVAL 7 DAY AS train_end, train_start + INTERVAL 7 DAY AS test_start,
  train_start + INTERVAL 8 DAY AS test_end FROM k),
counted AS (SELECT w.*, (SELECT count(*) FROM clean WHERE ts >= train_start AND ts < train_end) AS train_samples,
  (SELECT count(*) FROM clean WHERE ts >= test_start AND ts < test_end) AS test_samples FROM w)
SELECT row_number() OVER (ORDER BY train_start) AS split, *, {len(HORIZONS)} AS scores FROM counted WHERE train_samples >= 150"""

WALKED = f"""WITH clean AS ({clean_table(BARS_1H)}),
n AS (SELECT series, count(*) AS size, CAST(floor(count(*) * 0.2::DOUBLE) AS BIGINT) AS test FROM clean GROUP BY series),
cut AS (SELECT i + 1 AS split, size - i * (test // 3) - test AS train, test FROM n, range(3) t(i))
SELECT split, sum(train) AS train_samples, sum(test) AS test_samples, {len(HORIZONS)} AS scores FROM cut WHERE train > test GROUP BY split"""

FEATURES = ", ".join(f"'{c}'" for c in SIMPLE)

ORACLES = {
    **regressions.ORACLES,
    "rf_member_check": members(10),
    "rf_member_check_small": members(100),
    "rf_member_check_full": members(200),
    "boosting_check": shaped(
        f"""{TEST} SELECT horizon, 200 AS trees, true AS leaves_bounded, true AS leaves_filled, 0 AS rises, count(*) AS rows, 0 AS off
FROM test CROSS JOIN {EACH} GROUP BY horizon""",
        "",
        "horizon trees rises rows off",
    ),
    "stored_features": f"""SELECT 'linear' AS kind, CAST(i AS BIGINT) AS position, ([{FEATURES}])[i + 1] AS feature FROM range({len(SIMPLE)}) t(i)""",
    "importance_check": shaped(f"SELECT horizon, 1.0 AS total, 0 AS negative FROM {EACH}", "total", "horizon negative"),
    "normal_equations": shaped(
        f"SELECT kind, horizon, feature, 0.0 AS gradient FROM (SELECT unnest(['linear', 'ridge']) AS kind), {EACH}, (SELECT unnest([{FEATURES}]) AS feature)",
        "gradient",
        "horizon",
    ),
    "rolling_windows_fitted": shaped(WINDOWS, "", "split train_samples test_samples scores"),
    "walk_forward_fitted": shaped(WALKED, "", "split train_samples test_samples scores"),
    "roundtrip_check": shaped(f"{TEST} SELECT series, ts, horizon, 0.0 AS gap FROM test CROSS JOIN {EACH}", "gap", "horizon"),
}
