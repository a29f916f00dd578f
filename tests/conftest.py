import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from larder.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "larder-tests", cores=8, shuffle_partitions=2, settings={"spark.default.parallelism": "2"}
    )
    yield session
    session.stop()
