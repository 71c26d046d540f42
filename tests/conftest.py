import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wattlake.session import local_session

    folder = tmp_path_factory.mktemp("checkpoints")
    return local_session(
        8, **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(folder),
        }
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
