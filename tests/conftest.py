import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Makes a frame from tuples and a schema text; timestamps may be given as text."""

    def make(data, schema):
        fields = [f.strip().rsplit(" ", 1) for f in schema.split(",")]
        text = ", ".join(f"{n} {'string' if t == 'timestamp' else t}" for n, t in fields)
        df = spark.createDataFrame(data, text)
        return df.selectExpr(*[f"cast({n} as {t}) as {n}" for n, t in fields])

    return make
