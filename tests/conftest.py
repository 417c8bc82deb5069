import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session()
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Value of one column expression over one string."""
    from pyspark.sql import functions as F

    def evaluate(expression, text):
        return spark.createDataFrame([(text,)], "t string").select(expression(F.col("t"))).first()[0]

    return evaluate


@pytest.fixture(scope="session")
def each(spark):
    """Values of one column expression over several strings, in order."""
    from pyspark.sql import functions as F

    def evaluate(expression, texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
        return [r[1] for r in rows.select("i", expression(F.col("t"))).orderBy("i").collect()]

    return evaluate
