"""Run registered queries beside their SQL and compare whole results."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

DATA = "/root/testdata"


def session(app: str = "barloom", threads: str = "8", shared: str | None = None):
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master(f"local[{threads}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]")
        elif df[c].dtype == object and len(df) and not isinstance(df[c].iloc[0], str):
            df[c] = df[c].astype(str)
    return df.sort_values(list(df.columns), ignore_index=True)


def difference(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    a, e = canonical(actual), canonical(expected)
    if list(a.columns) != list(e.columns):
        return f"columns {list(a.columns)} != {list(e.columns)}"
    if len(a) != len(e):
        return f"rows {len(a)} != {len(e)}"
    kinds = [(c, str(a[c].dtype), str(e[c].dtype)) for c in a.columns if str(a[c].dtype) != str(e[c].dtype)]
    if kinds:
        return f"types {kinds}"
    for c in a.columns:
        same = (a[c] == e[c]) | (a[c].isna() & e[c].isna())
        if not same.all():
            i = (~same).idxmax()
            keys = {k: a.loc[i, k] for k in a.columns if k in ("series", "ts", "horizon", "query", "model", "split")}
            return f"{(~same).sum()} values differ in {c}, first at {keys}: {a.loc[i, c]!r} != {e.loc[i, c]!r}"
    return None


def main(names: list[str], sf: str) -> int:
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    sf_dir = f"{DATA}/{sf}"
    spark, con = session(), connect(sf_dir)
    bad, got = 0, ()
    for name in names or list(queries):
        t = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            took = time.time() - t
            found = difference(got, con.execute(oracles[name]).df()) if name in oracles else "(no sql)"
        except Exception as error:  # report and go on with the next query
            took, found = time.time() - t, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found not in (None, "(no sql)")
        print(f"{name:28s} {took:6.1f}s {len(got):8d} {found or 'ok'}", flush=True)
    print("mismatches", bad)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    scale = next((a for a in args if a.startswith("sf")), "sf0.01")
    sys.exit(main([a for a in args if not a.startswith("sf")], scale))
