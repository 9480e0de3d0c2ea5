import json

import pytest
from pyspark.sql import SparkSession

from sluice import configure
from sluice.operators.records import decode


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def values(spark):
    """JSON texts to rows (n INT, value VARIANT)."""

    def make(*texts):
        df = spark.createDataFrame(list(enumerate(texts)), "n INT, body STRING")
        return decode(df, "body")

    return make


@pytest.fixture
def page_files(tmp_path):
    """Writes page bodies of an endpoint as files; returns the base folder."""

    def make(endpoint, bodies, first=1):
        folder = tmp_path / "api" / endpoint
        folder.mkdir(parents=True, exist_ok=True)
        for n, body in enumerate(bodies, first):
            text = body if isinstance(body, str) else json.dumps(body)
            (folder / f"page={n}").write_text(text, encoding="utf-8")
        return str(tmp_path / "api")

    return make
