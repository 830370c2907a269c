import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from proseloom.session import get_spark, ship

    s = get_spark("tests", 4, **{"spark.driver.memory": "4g"})
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return ship(s)
