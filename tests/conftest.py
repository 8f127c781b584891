import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from corpusmill.session import build

    session = build("tests", 4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    if not (DATA / "sf0.001").exists():
        pytest.skip("no test tables here")
    return str(DATA / "sf0.001")
