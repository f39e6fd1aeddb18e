import sys
import tempfile
from pathlib import Path

import pytest

for folder in Path(__file__).resolve().parents[:2]:
    sys.path.insert(0, str(folder))

from rowgate.session import build_session  # noqa: E402
from samples import HEADER, LINE  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "rowgate-tests",
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="rowgate-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def valid_row():
    row = dict(zip(HEADER.split(","), LINE.split(",")))
    return {**row, "grid_area": "3"}


@pytest.fixture
def rows(spark):
    """Dicts of text as a frame with every CSV field."""
    from rowgate import energy

    ddl = "n int, " + ", ".join(f"{name} string" for name in energy.CSV_FIELDS)

    def build(dicts):
        data = [
            (i, *(d.get(name) for name in energy.CSV_FIELDS)) for i, d in enumerate(dicts)
        ]
        return spark.createDataFrame(data, ddl)

    return build
