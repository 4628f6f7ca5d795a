import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from compare import session

    s = session("tests", shared=str(tmp_path_factory.mktemp("shared")))
    yield s
    s.stop()


def walk(n: int, seed: int = 0, series: str = "a", start: str = "2024-01-01", freq: str = "min") -> pd.DataFrame:
    """Random-walk bars with whole-number volumes."""
    rng = np.random.default_rng(seed)
    close = 100 + rng.normal(size=n).cumsum() * 0.5
    open_ = np.concatenate([[100.0], close[:-1]])
    wick = rng.uniform(0, 0.3, size=(2, n))
    return pd.DataFrame(
        {
            "series": series,
            "ts": pd.date_range(start, periods=n, freq=freq),
            "open": open_,
            "high": np.maximum(open_, close) + wick[0],
            "low": np.minimum(open_, close) - wick[1],
            "close": close,
            "volume": rng.integers(1, 100, n).astype(float),
        }
    )


def collected(df, by=("series", "ts")) -> pd.DataFrame:
    return df.toPandas().sort_values(list(by), ignore_index=True)


def same(actual, expected, tol=1e-9):
    a, e = pd.Series(actual, dtype=float), pd.Series(expected, dtype=float)
    assert (a.isna().values == e.isna().values).all()
    ok = ~e.isna().values
    assert np.allclose(a.values[ok], e.values[ok], rtol=tol, atol=tol)
