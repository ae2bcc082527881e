import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from careledger.session import get_session  # noqa: E402
from careledger.sources.catalog import Catalog  # noqa: E402
from careledger.sources.driver_tables import bind_driver_tables  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=4, app="careledger-tests")
    yield s


@pytest.fixture(scope="session")
def fixture_catalog(spark):
    return bind_driver_tables(spark, SF_SMALL)


@pytest.fixture(scope="session")
def make_catalog(spark, fixture_catalog):
    """A catalog of empty tables with the fixture schemas; keyword arguments
    replace tables with hand-made rows (list of tuples in schema order)."""
    def build(**tables):
        kw = {}
        for name in Catalog.__dataclass_fields__:
            if name == "spark":
                continue
            schema = getattr(fixture_catalog, name).schema
            rows = tables.get(name, [])
            kw[name] = spark.createDataFrame(rows, schema)
        return Catalog(spark=spark, **kw)
    return build


def ts(s):
    return dt.datetime.fromisoformat(s)


def d(s):
    return dt.date.fromisoformat(s)
