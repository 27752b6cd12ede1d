import pytest

from tests.oracle import session
from weftgraph import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return configure(spark)
