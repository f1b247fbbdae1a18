import os
import sys
from pathlib import Path

import pandas as pd
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in Path(DATA).iterdir():
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def texts(frame):
    """Rows as sorted texts, columns by name, numbers and nulls alike."""
    one = lambda v: "null" if v is None or v is pd.NA or v != v else str(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) or type(v).__name__.startswith(("int", "float")) else str(v)
    return sorted("|".join(map(one, r)) for r in frame[sorted(frame.columns)].astype(object).values.tolist())


@pytest.fixture(scope="session")
def same(spark, duck):
    def check(query, sql):
        a, b = query(spark, DATA).toPandas(), duck.sql(sql).df()
        assert sorted(a.columns) == sorted(b.columns)
        assert texts(a) == texts(b)

    return check
