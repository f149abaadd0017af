import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from barlab.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 4, "barlab-tests")
    yield session
    session.stop()


def walk(symbol: str, n: int, seed: int, digits: int = 2) -> pd.DataFrame:
    """Random bars on a cent grid around 10."""
    rng = np.random.RandomState(seed)
    close = 10 + np.cumsum(rng.randint(-6, 7, n)) / 100
    close = 2 + np.abs((close - 2) % 28 - 14)
    open_ = close + rng.randint(-4, 5, n) / 100
    high = np.maximum(open_, close) + rng.randint(0, 6, n) / 100
    low = np.minimum(open_, close) - rng.randint(0, 6, n) / 100
    frame = pd.DataFrame({
        "symbol": symbol, "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), unit="h"),
        "open": open_, "high": high, "low": low, "close": close, "volume": rng.randint(100, 900, n).astype(float),
    })
    frame[["open", "high", "low", "close"]] = frame[["open", "high", "low", "close"]].round(digits)
    frame["bar_no"] = np.arange(n)
    frame["n_bars"] = n
    return frame


def to_spark(spark, frame: pd.DataFrame):
    """A pandas panel as a DataFrame; NaN becomes null."""
    kinds = {"symbol": "string", "ts": "timestamp_ntz", "bar_no": "bigint", "n_bars": "bigint"}
    schema = ", ".join(f"`{c}` {kinds.get(c, 'double')}" for c in frame.columns)
    clean = frame.astype(object).where(frame.notna(), None)
    rows = [
        tuple(
            v.to_pydatetime() if isinstance(v, pd.Timestamp)
            else (int(v) if c in ("bar_no", "n_bars") else v if v is None or c == "symbol" else float(v))
            for c, v in zip(frame.columns, r)
        )
        for r in clean.itertuples(index=False)
    ]
    return spark.createDataFrame(rows, schema)
