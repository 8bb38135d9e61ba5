import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import ensure_checkpoint_dir, local_session

    s = local_session(cores=8, partitions=8, app="tessera-tests")
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
