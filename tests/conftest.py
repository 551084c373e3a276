import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from strataflow.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        "tests",
        partitions=4,
        memory="6g",
        extra={
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "checkpoints"),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_lake(spark):
    from verification.queries import lake

    return lake(spark, SMALL)


@pytest.fixture(scope="session")
def medium_lake(spark):
    from verification.queries import lake

    return lake(spark, MEDIUM)


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))
