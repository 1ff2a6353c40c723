import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "3g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="cohortlens-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text):
    return dt.date.fromisoformat(text) if text else None


def rows(df, *columns):
    """Sorted tuples, nulls last."""
    columns = columns or df.columns
    out = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(v) if v is not None and not isinstance(v, (int, float)) else v or 0) for v in r))
