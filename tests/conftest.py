import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cohortlift.session import build_session

    s = build_session("local[*]", shuffle_partitions=8, app="cohortlift-tests")
    # tests only: a scratch checkpoint folder where the session names none
    if not s.conf.get("spark.checkpoint.dir", None):
        d = str(tmp_path_factory.mktemp("checkpoints"))
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()
