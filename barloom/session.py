"""Session settings the engine relies on, and where it may write."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Timestamps are naive wall-clock values: pin the session to UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or one in the warehouse where that is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place for an intermediate table. It is removed when the process ends, if the session is still up."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_removed, spark, path)
    return path


def _removed(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder through Spark's own file system, wherever it is."""
    context = spark.sparkContext
    if context._jsc is None:  # the session was stopped
        return
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish(views: dict[str, DataFrame]) -> None:
    """Make tables available to SQL under the given names."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


#: SQL functions by their signature, and what they return. Later ones may call earlier ones.
SQL_FUNCTIONS = (
    ("above_name(price DOUBLE)", "STRING", "concat('above_', cast(cast(price AS BIGINT) AS STRING))"),
    ("below_name(price DOUBLE)", "STRING", "concat('below_', cast(cast(price AS BIGINT) AS STRING))"),
    ("between_name(low DOUBLE, high DOUBLE)", "STRING", "concat_ws('_', 'between', cast(low AS BIGINT), cast(high AS BIGINT))"),
    (
        "sorted_quantile(sorted ARRAY<DOUBLE>, q DOUBLE)",
        "DOUBLE",
        """transform(array(q * (size(sorted) - 1)), r -> get(sorted, cast(floor(r) AS INT))
          + (get(sorted, cast(ceil(r) AS INT)) - get(sorted, cast(floor(r) AS INT))) * (r - floor(r)))[0]""",
    ),
    (
        "interpolated(x DOUBLE, xs ARRAY<DOUBLE>, ys ARRAY<DOUBLE>)",
        "DOUBLE",
        """transform(array(size(filter(xs, v -> v < x))), n -> CASE WHEN n = 0 THEN ys[0] WHEN n = size(xs) THEN ys[n - 1]
          ELSE ys[n - 1] + (ys[n] - ys[n - 1]) * (x - xs[n - 1]) / (xs[n] - xs[n - 1]) END)[0]""",
    ),
    (
        "percentile_grid(sorted ARRAY<DOUBLE>)",
        "ARRAY<DOUBLE>",
        """transform(transform(sequence(1, 99), k -> k / 100D * (size(sorted) - 1)), r -> get(sorted, cast(floor(r) AS INT))
          + (get(sorted, cast(ceil(r) AS INT)) - get(sorted, cast(floor(r) AS INT))) * (r - floor(r)))""",
    ),
    (
        "probability_below(grid ARRAY<DOUBLE>, threshold DOUBLE)",
        "DOUBLE",
        """transform(array(size(filter(grid, v -> v < threshold))), n -> CASE WHEN n = 0 THEN 0D WHEN n = size(grid) THEN 1D
          ELSE (n + (threshold - grid[n - 1]) / (grid[n] - grid[n - 1])) / (size(grid) + 1) END)[0]""",
    ),
    (
        "event_probability(grid ARRAY<DOUBLE>, op STRING, low DOUBLE, high DOUBLE)",
        "DOUBLE",
        """CASE op WHEN 'between' THEN probability_below(grid, high) - probability_below(grid, low)
          WHEN 'above' THEN 1 - probability_below(grid, low) WHEN 'below' THEN probability_below(grid, low) ELSE 0D END""",
    ),
    (
        "split_windows(first TIMESTAMP, last TIMESTAMP, train_days INT, test_days INT, step_days INT)",
        "TABLE(number BIGINT, train_start TIMESTAMP, test_start TIMESTAMP, test_end TIMESTAMP)",
        """SELECT k, first + make_dt_interval(cast(k * step_days AS INT)), first + make_dt_interval(cast(k * step_days + train_days AS INT)),
          first + make_dt_interval(cast(k * step_days + train_days + test_days AS INT))
          FROM (SELECT explode(filter(sequence(0L, greatest(0L, (unix_seconds(last) - unix_seconds(first)) div (86400L * step_days))),
            k -> (unix_seconds(last) - unix_seconds(first)) >= 86400L * (k * step_days + train_days + test_days))) AS k)""",
    ),
)


def register_functions(spark: SparkSession) -> None:
    """Threshold names, quantiles, interpolation, event probabilities and rolling windows as functions of the session's SQL.

    They are expressions of SQL, so the optimizer sees through them; no Python runs in a query that calls them.
    """
    for signature, kind, body in SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
