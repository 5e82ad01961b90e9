import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from anamnesis.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def one(spark):
    """Evaluates a Column over a one-row frame."""
    def evaluate(column, row=(0,), schema="x int"):
        return spark.createDataFrame([row], schema).select(column.alias("v")).first()["v"]
    return evaluate
