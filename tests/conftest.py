import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bench import session


@pytest.fixture(scope="session")
def spark():
    spark = session()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    return spark
