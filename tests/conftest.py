import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from placerank.schema import LISTINGS_RAW, POSTS  # noqa: E402
from placerank.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(master="local[*]", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def posts(spark):
    rows = [
        (1, "A", "X", "2 years ago", "Beach beach sun"),
        (2, "A", "X", "a year ago", "temple"),
        (3, "B", "X", "2 years ago", "beach"),
        (4, "C", "Y", None, None),
        (5, "A", "Y", "2 years ago", "sun sun"),
    ]
    return spark.createDataFrame(rows, schema=POSTS)


@pytest.fixture(scope="session")
def listings_raw(spark):
    rows = [
        (1, "Villa one", "Entire villa", " 4 guests ", "4.8"),
        (2, "Villa two", "Entire villa", "2", "5.0"),
        (3, "Room three", "Private room", "16+ guests", "4.5"),
        (4, "Room four", "Private room", "", "4.9"),
        (5, "Room five", "Private room", "3", "New"),
        (6, "Room six", "Private room", "0 guests", "4.0"),
        (7, "Hotel seven", "Hotel room", "2 guests", " 3.9 "),
        (8, "Hotel eight", "Hotel room", "99999999999", "4.0"),
        (9, "Hotel nine", "Hotel room", "2", "4."),
        (10, "Hotel ten", "Hotel room", "2", "-4.0"),
    ]
    return spark.createDataFrame(rows, schema=LISTINGS_RAW)


def rows(df, *cols):
    """Collected rows as tuples of the given columns, in the DataFrame's order."""
    return [tuple(r[c] for c in cols) for r in df.collect()]
