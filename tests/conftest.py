import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from isobar.plans import preprocess  # noqa: E402
from isobar.session import local_session, scratch_path  # noqa: E402
from isobar.sources.observations import observations  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "isobar-tests")
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    return observations(spark, SMALL)


@pytest.fixture(scope="session")
def table(spark):
    """The split table as the cleaning job writes it."""
    path = scratch_path(spark, "split-table")
    preprocess.write_split_table(observations(spark, MEDIUM), path, "obs_id")
    return spark.read.parquet(path)
