import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from carelake.session import get_session

    session = get_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    from carelake.fixtures import Inputs

    return Inputs(spark, SF_DIR)


def rows(df, *columns):
    """Rows as tuples, sorted by their text."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
