import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "8", "riskloom-tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def scored(spark):
    """3,000 labelled rows with tied scores, five groups (A degraded) and a raw score."""
    rng = np.random.default_rng(7)
    n = 3000
    group = rng.choice(list("ABCDE"), n)
    y = (rng.random(n) < 0.12).astype(int)
    lift = np.where(group == "A", 0.0, 0.25)
    raw = np.clip(rng.beta(2, 8, n) + lift * y, 0, 1)
    rows = [
        (int(i), int(a), float(b), float(round(b, 2)), str(g)) for i, (a, b, g) in enumerate(zip(y, raw, group))
    ]
    df = spark.createDataFrame(rows, "id long, y int, raw double, score double, grp string")
    return df.cache()


@pytest.fixture
def many_ranges(monkeypatch):
    """Force the range-by-range path on small data."""
    from riskloom.operators import ranking

    monkeypatch.setattr(ranking, "CELLS_PER_RANGE", 25)
