import pytest
from pyspark.sql import SparkSession

from oreflow.session import tuned


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        tuned(SparkSession.builder.master("local[4]").appName("tests"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of one expression over one text column."""

    def evaluate(values, expression, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [row[0] for row in df.orderBy("i").select(expression).collect()]

    return evaluate
