import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], *filter(None, [os.environ.get("PYTHONPATH")])])  # for the workers

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="3", spark__ui__enabled="false", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def walk(spark):
    """Three random series of unequal length with gaps in the calendar; one holds most rows."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(7)
    frames = []
    for symbol, n in (("HOT", 1500), ("B", 260), ("C", 40)):
        days = pd.Timestamp("2001-01-01") + pd.to_timedelta(np.cumsum(rng.integers(1, 4, n)), unit="D")
        close = 100 + np.cumsum(rng.normal(0, 1, n))
        spread = rng.uniform(0.1, 2, (2, n))
        frames.append(pd.DataFrame({
            "symbol": symbol, "date": days.date, "open": close + rng.normal(0, 0.3, n), "high": close + spread[0],
            "low": close - spread[1], "close": close, "volume": rng.integers(0, 1000, n).astype(float)}))
    pdf = pd.concat(frames, ignore_index=True)
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=1), "symbol string, date date, open double, high double, low double, close double, volume double")
    return pdf, df.cache()
