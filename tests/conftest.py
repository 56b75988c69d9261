import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from nearrate.session import get_session
    s = get_session("local[4]", 4, app_name="nearrate-tests")
    yield s


@pytest.fixture(scope="session")
def tiny(spark):
    """Hand fixture with known answers (FIXTURES.md section 2)."""
    from nearrate.sources import RATING_SCHEMA
    train = [(1, 1, 5), (1, 2, 3), (1, 3, 4), (2, 1, 4), (2, 2, 2), (2, 4, 5),
             (3, 2, 5), (3, 3, 1), (3, 4, 3), (4, 1, 3), (4, 3, 3), (5, 5, 2), (5, 6, 5),
             (6, 1, 1), (6, 2, 5), (6, 5, 5)]
    test = [(1, 4, 4), (2, 3, 2), (3, 1, 5), (5, 1, 4), (4, 2, 4), (6, 6, 3), (9, 1, 2), (1, 9, 3)]
    tr = spark.createDataFrame([(u, i, float(r)) for u, i, r in train], RATING_SCHEMA)
    te = spark.createDataFrame([(u, i, float(r)) for u, i, r in test], RATING_SCHEMA)
    return tr, te, test
