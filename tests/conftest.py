import pytest

from reportloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of a column expression for a list of strings."""
    from pyspark.sql import functions as F

    def run(values, expression, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        return [r["y"] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]

    return run
