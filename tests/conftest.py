import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockmart.params import EnumSet, NaParams  # noqa: E402
from stockmart.session import build_session  # noqa: E402
from stockmart.sources.star_views import ENUMS, star_tables  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", shuffle_partitions=8,
        conf={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def enums():
    return EnumSet((e, i, n, n) for e, names in ENUMS.items() for i, n in enumerate(names))


@pytest.fixture(scope="session")
def params():
    return NaParams()


@pytest.fixture(scope="session")
def star(spark):
    return star_tables(spark, SMALL)


@pytest.fixture
def now():
    return dt.datetime(2001, 8, 15)


def tuples(df, *columns):
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))
