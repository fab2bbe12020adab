import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from numberplace.session import local_session  # noqa: E402
from numberplace.sources.generate import generate  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "numberplace-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def records(spark):
    """3,000 generated records."""
    return generate(spark, 3_000).cache()


@pytest.fixture(scope="session")
def awkward(spark):
    """A small table with copies, null cells and ids that are no numbers."""
    rows = [
        (str(1 + i % 40) if i % 7 else f"x{i % 3}", f"p{i % 4}", ["广东", "北京", None][i % 3],
         ["广州", "北京"][i % 2], f"Op{i % 2}", "020" if i % 5 else None, None)
        for i in range(600)
    ]
    rows += [("5", "p1", "广东", "广州", "Op1", "020", None)] * 300  # a third are copies
    names = "record_id phone_number province city operator area_code postal_code"
    schema = ", ".join(f"{name} string" for name in names.split())
    return spark.createDataFrame(rows, schema).repartition(5).cache()
