import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starfold.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.log.level": "ERROR",
    }
    session = build_session("tests", "local[4]", **conf)
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df, *order):
    """Rows as tuples, sorted with NULLs first."""
    found = [tuple(r) for r in df.select(*(order or df.columns)).collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.fixture(scope="session")
def as_rows():
    return rows
