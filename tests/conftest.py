import os
import sys
import tempfile

import pytest

TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(TESTS), TESTS]

from fixture_values import FIXTURE_POSTINGS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from postclust.session import build_session

    # fallback checkpoint folder, used only if the Spark configuration names none
    ckpt = tempfile.mkdtemp(prefix="postclust-ckpt-", dir="/tmp")
    session = build_session(
        master="local[*]",
        shuffle_partitions=8,
        checkpoint_dir=ckpt,
        extra_conf={"spark.ui.showConsoleProgress": "false"},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fixture_postings(spark):
    from postclust.sources.memory import postings_from_rows

    return postings_from_rows(spark, FIXTURE_POSTINGS)


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
