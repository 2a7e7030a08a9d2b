import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="riskframe-test-ckpt-")
    wh = tempfile.mkdtemp(prefix="riskframe-test-wh-")
    ledgers = tempfile.mkdtemp(prefix="riskframe-test-ledgers-")
    session = (SparkSession.builder.master("local[*]")
               .appName("riskframe-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", wh)
               .config("spark.checkpoint.dir", ckpt)
               # The suite's jobs search the same rows: each goes on from the last one.
               .config("riskframe.ledger.dir", ledgers)
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from riskframe.plans.standin import TABLES

    con = duckdb.connect()
    for t in TABLES:
        p = f"{SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con
