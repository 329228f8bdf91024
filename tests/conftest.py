import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


@pytest.fixture(scope="session")
def same(duck):
    """Compares a query's rows with its SQL's, column by column and without regard to order."""

    def rows_of(names, rows):
        at = sorted(range(len(names)), key=lambda i: names[i])
        fixed = (tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in at) for r in rows)
        return sorted(fixed, key=str)

    def check(df, sql):
        got = duck.execute(sql)
        names = [x[0] for x in got.description]
        expected = got.fetchall()
        assert sorted(df.columns) == sorted(names)
        assert rows_of(df.columns, df.collect()) == rows_of(names, expected)

    return check
