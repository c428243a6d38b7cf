import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from newslens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate column functions on a single row of string values."""
    from pyspark.sql import functions as F

    def run(build, **values):
        cells = [F.lit(v).cast("string").alias(k) if v is None or isinstance(v, str) else F.lit(v).alias(k)
                 for k, v in values.items()]
        row = spark.range(1).repartition(1).select(*cells)
        return row.select(build(*[F.col(k) for k in values]).alias("out")).first()["out"]

    return run


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
