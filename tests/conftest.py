import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from starforge.session import local_session, ship_package

    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    ship_package(session)
    yield session


@pytest.fixture
def tables(spark):
    from starforge.plans.bindings import Tables

    return Tables(spark, SF)


def rows(df, *columns):
    """Rows as sorted tuples."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
