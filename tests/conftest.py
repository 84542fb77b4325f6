import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[8]").appName("tests").config("spark.driver.memory", "6g")
         .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=str) if not order else [tuple(r) for r in df.orderBy(*order).collect()]
