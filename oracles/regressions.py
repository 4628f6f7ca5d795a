"""SQL for linear and ridge forecasts: sums of products, elimination as a recursion over lists, and errors of what follows."""

from __future__ import annotations

import math

from oracles.base import BARS_1H, shaped
from oracles.features import SIMPLE, clean_table

HORIZONS = (1, 5, 20)
D = len(SIMPLE)
TARGETS = [f"target_{h}" for h in HORIZONS]


def solver(system: str, key: str) -> str:
    """Elimination on matrices with the right-hand sides beside them: column D + h of row i ends as the weight of feature i for target h."""
    return f"""eliminated AS (SELECT {key}, 1 AS k, m FROM {system}
  UNION ALL SELECT {key}, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / m[k][k])
    ELSE list_transform(r, lambda v, j: v - r[k] / m[k][k] * m[k][j]) END) FROM eliminated WHERE k <= {D}),
weights AS (SELECT {key}, m FROM eliminated WHERE k = {D + 1})"""


def matrix(product, diagonal: str) -> str:
    """Sums of products of features around their means, and of features with targets."""
    rows = []
    for i, a in enumerate(SIMPLE):
        cells = [product(a, b) + (f" + {diagonal.format(a=a)}" if j == i else "") for j, b in enumerate([*SIMPLE, *TARGETS])]
        rows.append(f"[{', '.join(cells)}]")
    return f"[{', '.join(rows)}]"


def plain(a: str, b: str) -> str:
    return f"covar_pop({a}, {b}) * count(*)"


def weighted(a: str, b: str) -> str:
    return f"sum(w * {a} * {b}) - sum(w * {a}) * sum(w * {b}) / sum(w)"


def forecast_of(n: int) -> str:
    terms = [f"m[{i + 1}][{D + n + 1}] * (r.{c} - n.mean_{c})" for i, c in enumerate(SIMPLE)]
    return f"n.mean_{TARGETS[n]} + {' + '.join(terms)}"


def each_horizon(select: str) -> str:
    return " UNION ALL ".join(select.replace("<h>", str(h)).replace("<p>", forecast_of(n)) for n, h in enumerate(HORIZONS))


MEANS = ", ".join(f"avg({c}) AS mean_{c}" for c in (*SIMPLE, *TARGETS))
WEIGHTED_MEANS = ", ".join(f"sum(w * {c}) / sum(w) AS mean_{c}" for c in (*SIMPLE, *TARGETS))
N = "(SELECT * EXCLUDE (m) FROM n) n"
ERROR = """sqrt(avg((actual - p) ** 2)) AS rmse, avg(abs(actual - p)) AS mae,
  avg(CASE WHEN actual <> 0 THEN abs((actual - p) / actual) END) * 100 AS mape, count(*) AS test_samples"""

PARTED = f"""WITH RECURSIVE clean AS ({clean_table(BARS_1H)}), numbered AS (SELECT *,
  row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS pos, count(*) OVER (PARTITION BY series) AS size FROM clean),
train AS (SELECT * FROM numbered WHERE pos < floor(size * 0.8::DOUBLE)), test AS (SELECT * FROM numbered WHERE pos >= floor(size * 0.8::DOUBLE))"""
SCALES = ", ".join(
    f"quantile_cont({c}, 0.5) AS mid_{c}, coalesce(nullif(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 0), 1) AS width_{c}"
    for c in SIMPLE
)
SCALED = ", ".join(f"({c} - mid_{c}) / width_{c} AS {c}" for c in SIMPLE)
ROBUST = f"""{PARTED}, scales AS (SELECT {SCALES} FROM train),
x_train AS (SELECT * REPLACE ({SCALED}) FROM train, scales), x_test AS (SELECT * REPLACE ({SCALED}) FROM test, scales)"""


def fitted(alpha: float) -> str:
    forecasts = each_horizon(f"SELECT series, ts, close, <h> AS horizon, <p> AS prediction FROM x_test r, {N}, weights")
    system = f"SELECT 0 AS g, {MEANS}, {matrix(plain, f'{alpha}::DOUBLE')} AS m FROM x_train"
    return shaped(f"{ROBUST}, n AS ({system}), {solver('n', 'g')} {forecasts}", "close prediction", "horizon", digits=4)


#: Copies of a row in 100 resamples: draws of the Poisson distribution of mean 1 by the hash of its key.
FIFTH = "lambda x: (x * x % 2147483647) * (x * x % 2147483647) % 2147483647 * x % 2147483647"
LEVELS = [int(sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) * 2147483647) for k in range(10)]
COPIES = f"""keyed AS (SELECT *, CAST('0x' || substr(md5('42|' || series || '|' || CAST(epoch(ts) AS BIGINT)), 1, 8) AS BIGINT) % 2147483647 AS key FROM x_train),
fifths AS (SELECT * EXCLUDE (key), list_transform(list_transform(range(1, 101), lambda d: (key + d * 1000003) % 2147483647), {FIFTH}) AS a FROM keyed),
mixed AS (SELECT * EXCLUDE (a), list_transform(list_transform(a, lambda x, i: (x + i * 7919) % 2147483647), {FIFTH}) AS a FROM fifths),
copies AS (SELECT * EXCLUDE (a), unnest(range(100)) AS g, unnest(list_transform(a, lambda u: CAST(len(list_filter({LEVELS}, lambda c: u >= c)) AS DOUBLE))) AS w FROM mixed)"""
MEMBERS = each_horizon(f"SELECT series, ts, <h> AS horizon, <p> AS p FROM x_test r, {N} JOIN weights USING (g)")
BOOTSTRAP = f"""{ROBUST}, {COPIES}, n AS (SELECT g, {WEIGHTED_MEANS}, {matrix(weighted, "1.0::DOUBLE")} AS m FROM copies GROUP BY g), {solver("n", "g")},
forecasts AS ({MEMBERS})
SELECT series, ts, horizon, unnest([0.05, 0.25, 0.5, 0.75, 0.95]::DOUBLE[]) AS q,
  unnest(quantile_cont(p, [0.05, 0.25, 0.5, 0.75, 0.95])) AS value FROM forecasts GROUP BY series, ts, horizon"""

TESTED = each_horizon(
    f"""SELECT raw, train_start, train_samples, <h> AS horizon, target_<h> AS actual, <p> AS p FROM {N} JOIN weights USING (raw)
  JOIN clean r ON r.ts >= train_start + INTERVAL 7 DAY AND r.ts < train_start + INTERVAL 8 DAY"""
)
ROLLED = f"""WITH RECURSIVE clean AS ({clean_table(BARS_1H)}), span AS (SELECT min(ts) AS f, max(ts) AS l FROM clean),
k AS (SELECT i AS raw, f + to_days(CAST(i AS INTEGER)) AS train_start, l FROM span, range(10000) t(i) WHERE f + to_days(CAST(i + 8 AS INTEGER)) <= l),
n AS (SELECT raw, train_start, count(*) AS train_samples, {MEANS}, {matrix(plain, "var_pop({a})")} AS m
  FROM k JOIN clean ON ts >= train_start AND ts < train_start + INTERVAL 7 DAY GROUP BY raw, train_start HAVING count(*) >= 150),
{solver("n", "raw")}, forecasts AS ({TESTED})
SELECT dense_rank() OVER (ORDER BY raw) AS split, horizon, train_samples, 'ridge' AS model, train_start, train_start + INTERVAL 7 DAY AS train_end,
  train_start + INTERVAL 7 DAY AS test_start, train_start + INTERVAL 8 DAY AS test_end, {ERROR}
FROM forecasts GROUP BY raw, train_start, train_samples, horizon"""

AHEAD = each_horizon(
    f"""SELECT split, train_samples, <h> AS horizon, target_<h> AS actual, <p> AS p FROM {N} JOIN weights USING (split)
  JOIN chosen r USING (split) WHERE pos >= begin AND pos < begin + test_rows"""
)
FORWARD = f"""{PARTED}, sized AS (SELECT *, CAST(floor(size * 0.2::DOUBLE) AS BIGINT) AS test_rows FROM numbered),
cut AS (SELECT sized.*, i + 1 AS split, size - i * (test_rows // 3) - test_rows AS begin FROM sized, range(3) t(i)),
chosen AS (SELECT * FROM cut WHERE begin > test_rows),
n AS (SELECT split, count(*) AS train_samples, {MEANS}, {matrix(plain, "0")} AS m FROM chosen WHERE pos < begin GROUP BY split),
{solver("n", "split")}, forecasts AS ({AHEAD})
SELECT split, horizon, train_samples, 'linear' AS model, {ERROR} FROM forecasts GROUP BY split, train_samples, horizon"""

ORACLES = {
    "linear_forecast": fitted(0.0),
    "ridge_forecast": fitted(1.0),
    "bootstrap_quantiles": shaped(BOOTSTRAP, "q value", "horizon", digits=4),
    "rolling_validation": shaped(ROLLED, "rmse mae mape", "split horizon train_samples test_samples", digits=4),
    "walk_forward": shaped(FORWARD, "rmse mae mape", "split horizon train_samples test_samples", digits=4),
}
