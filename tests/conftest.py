import datetime as dt
import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barflow.schemas import BARS  # noqa: E402
from barflow.session import local_session  # noqa: E402
from helpers import START  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def bars(spark):
    """bars({"A": closes, ...}): daily bars with high and low one off the close, volume 10."""

    def build(series, start=START, volume=10):
        rows = []
        for symbol, closes in series.items():
            for i, close in enumerate(closes):
                high = None if close is None else float(close) + 1
                low = None if close is None else float(close) - 1
                close = None if close is None else float(close)
                rows.append((symbol, start + dt.timedelta(days=i), close, high, low, close, close, volume))
        return spark.createDataFrame(rows, BARS)

    return build


@pytest.fixture(scope="session")
def random_bars():
    """Pandas bars: one long symbol with gaps (most of the rows) and two short ones."""
    rng = np.random.default_rng(7)
    frames = []
    for symbol, n in (("HOT", 900), ("B", 120), ("C", 40)):
        days = np.cumsum(rng.integers(1, 6, n))
        close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
        frames.append(pd.DataFrame({
            "symbol": symbol,
            "date": [START + dt.timedelta(days=int(d)) for d in days],
            "open": close * (1 + rng.normal(0, 0.005, n)),
            "high": close * (1 + rng.uniform(0.006, 0.02, n)),
            "low": close * (1 - rng.uniform(0.006, 0.02, n)),
            "close": close,
            "adj_close": close,
            "volume": rng.integers(1, 1000, n),
        }))
    return pd.concat(frames, ignore_index=True)
