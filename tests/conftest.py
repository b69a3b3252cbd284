import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from tenantmart.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # a checkpoint folder of our own only where the session names none
    ensure_checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="tm-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from tenantmart.sources.fixtures import BASE_TABLES
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def src(spark):
    from tenantmart.sources.fixtures import FixtureSource
    return FixtureSource(spark, SF_SMALL)
