import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkrisk.session import build_session  # noqa: E402
from sparkrisk.spec import FeatureSpec  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=8, partitions=4)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def mixed_pandas():
    """100 rows: three numeric, two nominal, two ordinal columns and a target."""
    rng = np.random.RandomState(42)
    return pd.DataFrame({
        "row_id": np.arange(100),
        "num1": rng.normal(size=100), "num2": rng.normal(size=100) * 10, "num3": rng.normal(size=100),
        "nom1": rng.choice([1, 2, 3, 4], 100), "nom2": rng.choice([10, 20, 30], 100),
        "ord1": rng.choice([1, 2, 3], 100), "ord2": rng.choice([1, 2, 3, 4], 100),
        "target": rng.choice([0, 1], 100, p=[0.7, 0.3]),
    })


@pytest.fixture(scope="session")
def mixed_table(spark, mixed_pandas):
    return spark.createDataFrame(mixed_pandas).repartition(4).persist()


@pytest.fixture(scope="session")
def mixed_spec():
    return FeatureSpec(
        numeric=("num1", "num2", "num3"), nominal=("nom1", "nom2"), ordinal=("ord1", "ord2"), target="target",
        rules={"nom1": [1, 2, 3, 4], "nom2": [10, 20, 30]}, outlier_columns=("num1", "num2"),
    )


def column(df, name):
    return [r[0] for r in df.select(f"`{name}`").collect()]


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}
