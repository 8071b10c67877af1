import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from shopgrain.session import local_session

    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(
        partitions=4, **{"spark.checkpoint.dir": folder, "spark.ui.showConsoleProgress": "false"}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
