import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__driver__host="127.0.0.1",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _order(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, doubles to nine places."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        plain = (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in picked.collect())
        return sorted(plain, key=_order)

    return collect
