import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Python workers import the package too
os.environ["PYTHONPATH"] = sys.path[0] + os.pathsep + os.environ.get("PYTHONPATH", "")

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('checkpoints')}").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(s.conf.get("spark.checkpoint.dir"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return DATA


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def _plain(v):
    if isinstance(v, float):
        return f"{v + 0.0:.9g}"
    if isinstance(v, (list, tuple)):
        return str([_plain(x) for x in v])
    return str(v)


@pytest.fixture(scope="session")
def same(spark, sf, duck):
    """Asserts that a query equals its SQL as a multiset, with the same column names."""

    def check(query, sql):
        df, rel = query(spark, sf), duck.sql(sql)
        cols = sorted(df.columns)
        assert cols == sorted(rel.columns)
        at = [rel.columns.index(c) for c in cols]
        assert sorted(tuple(_plain(r[c]) for c in cols) for r in df.collect()) == sorted(tuple(_plain(r[i]) for i in at) for r in rel.fetchall())

    return check
