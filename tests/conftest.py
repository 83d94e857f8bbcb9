import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    conf = {"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    session = SparkSession.builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def same():
    """Compares a DataFrame with SQL on a folder's tables in DuckDB, as sorted rows."""
    import duckdb

    tables = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

    def rows(names, found):
        at = sorted(range(len(names)), key=lambda i: names[i])
        return sorted((tuple(r[i] for i in at) for r in found), key=lambda r: tuple((x is not None, str(x)) for x in r))

    def compare(df, sql, folder):
        con = duckdb.connect()
        for t in tables:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        want = con.sql(sql)
        assert sorted(df.columns) == sorted(want.columns)
        assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())

    return compare
