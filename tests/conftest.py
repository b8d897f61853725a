import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check_queries import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("4")
    yield spark
    spark.stop()
