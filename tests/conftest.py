import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from trawlspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = local_session(
        8, 4, **{"spark.sql.warehouse.dir": str(home / "warehouse"), "spark.checkpoint.dir": str(home / "shared")}
    )
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a DataFrame as sorted tuples."""

    def collect(df, *cols):
        return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)

    return collect
