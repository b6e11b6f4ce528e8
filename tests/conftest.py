import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from recordflow.session import local_session

    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        8,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.driver.memory": "8g",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """A frame with one ``value`` per given text."""
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value string")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture
def new_table(spark, tmp_path):
    """Create an empty table under the test's folder."""
    from recordflow.sinks import tables

    def make(schema, streaming=False):
        name = f"t_{tmp_path.name}_{len(list(tmp_path.iterdir()))}".lower().replace("-", "_")
        location = tmp_path / name
        location.mkdir()
        tables.create_table(spark, name, schema, streaming=streaming, location=str(location))
        return name

    return make
