import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    from tillroll.llm.common import find_package
    find_package(spark)
