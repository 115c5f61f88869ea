import pytest
from pyspark.sql import SparkSession

from stowage import SpaceStore

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Keep several partitions even for a few rows, as a cluster would.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return SpaceStore(spark, str(tmp_path / "spaces"))


@pytest.fixture(scope="session")
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


@pytest.fixture(scope="session")
def lines(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")
