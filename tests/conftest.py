"""One session for all tests, and a comparison with DuckDB."""

import glob
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('checkpoints')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def _cell(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def normal(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="session")
def same(spark, sf_dir, duck):
    """Checks a query against its SQL: columns, row count and values."""

    def check(query, sql):
        got = query(spark, sf_dir)
        want = duck.execute(sql)
        names = [d[0] for d in want.description]
        assert sorted(got.columns) == sorted(names)
        assert normal([tuple(r) for r in got.collect()], got.columns) == normal(want.fetchall(), names)

    return check
