import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from runlens import get_spark

    session = get_spark("local[8]", app="tests", shuffle_partitions=8,
                        extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                               "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from runlens.sources.tables import Tables

    return Tables(spark, SF)


def rows(df):
    """Rows as sorted tuples, columns by name."""
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)
