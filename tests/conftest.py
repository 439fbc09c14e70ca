import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from touchline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = build_session("touchline-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(work / "checkpoints"),
        "spark.sql.warehouse.dir": str(work / "warehouse")})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples, NULLs first."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        key = lambda r: tuple((v is not None, str(v)) for v in r)
        return sorted((tuple(r) for r in picked.collect()), key=key)
    return collect
