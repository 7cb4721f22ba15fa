import os
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest

from shelfcast.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", os.environ.get("TEST_CPUS", "4"), 4)
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session


@pytest.fixture(scope="session")
def tables():
    return SMALL


def days(first: str, n: int) -> list[date]:
    start = date.fromisoformat(first)
    return [start + timedelta(days=i) for i in range(n)]


def retail_frame(n_items: int = 3, n_stores: int = 2, n_days: int = 120, seed: int = 0) -> pd.DataFrame:
    """Small dense panel: items in two departments of one category, stores in two states."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n_items):
        for j in range(n_stores):
            level = rng.uniform(1, 6)
            for k, d in enumerate(days("2015-01-01", n_days)):
                rows.append(
                    {
                        "id": f"item_{i}_S{j}_1",
                        "item_id": f"item_{i}",
                        "dept_id": f"dept_{i % 2}",
                        "cat_id": "cat",
                        "store_id": f"S{j}_1",
                        "state_id": f"S{j}",
                        "date": d,
                        "sales": float(rng.poisson(level * (1.5 if d.weekday() >= 5 else 1.0))),
                    }
                )
    return pd.DataFrame(rows)


@pytest.fixture(scope="session")
def retail():
    return retail_frame()


@pytest.fixture(scope="session")
def retail_df(spark, retail):
    return spark.createDataFrame(retail)
