"""Dimensions and facts with old and new keys, derived from the test tables by SQL that Spark and DuckDB both run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BASE = ("customer", "supplier", "part", "orders", "lineitem")
FIXTURES = {
    "legacy_customer": "SELECT CAST(c_custkey + 1 AS BIGINT) AS old_sk, '  ' || lower(c_name) || ' ' AS nk, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 50 <> 7",
    "target_customer": "SELECT CAST((SELECT max(c_custkey) FROM customer) - c_custkey + 1 AS BIGINT) AS new_sk, c_name AS nk, CASE WHEN c_custkey % 9 = 0 THEN ' del ' WHEN c_custkey % 9 = 1 THEN NULL ELSE 'A' END AS status FROM customer WHERE c_custkey % 40 <> 3",
    "versions": "SELECT o_custkey, s, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY s) AS BIGINT) AS rn, lead(s) OVER (PARTITION BY o_custkey ORDER BY s) AS e, CAST(row_number() OVER (ORDER BY o_custkey, s) AS BIGINT) AS up, CAST(row_number() OVER (ORDER BY o_custkey DESC, s) AS BIGINT) AS down FROM (SELECT DISTINCT o_custkey, o_orderdate AS s FROM orders) d",
    "legacy_a": "SELECT up AS old_sk, CAST(o_custkey AS STRING) AS nk, s, e FROM versions WHERE (o_custkey * 17 + rn) % 307 <> 0",
    "target_a": "SELECT down AS new_sk, CAST(o_custkey AS STRING) AS nk, s, e FROM versions WHERE (o_custkey * 31 + rn) % 211 <> 0",
    "legacy_b": "SELECT up AS old_sk, CAST(o_custkey AS STRING) AS nk, s, lead(s) OVER (PARTITION BY o_custkey ORDER BY s) AS e FROM versions WHERE rn % 3 <> 2 AND o_custkey % 45 <> 7",
    "target_b": "SELECT down AS new_sk, CAST(o_custkey AS STRING) AS nk, s, lead(s) OVER (PARTITION BY o_custkey ORDER BY s) AS e FROM versions WHERE rn % 4 <> 1 AND o_custkey % 60 <> 11",
    "fact_orders": "SELECT o_orderkey, CAST(o_custkey + 1 AS BIGINT) AS fk, CAST(o_totalprice AS DOUBLE) AS price, o_orderdate AS event FROM orders",
    "fact_reloaded": "SELECT o_orderkey, CAST((SELECT max(c_custkey) FROM customer) - o_custkey + 1 AS BIGINT) AS fk FROM orders",
    "fact_mixed": "SELECT o.o_orderkey, CASE WHEN o.o_orderkey % 2 = 0 THEN o.fk ELSE r.fk + 1000000 END AS fk FROM fact_orders o JOIN fact_reloaded r ON o.o_orderkey = r.o_orderkey",
    "fact_a": "SELECT o_orderkey, old_sk AS fk FROM orders JOIN legacy_a ON nk = CAST(o_custkey AS STRING) AND s = o_orderdate",
    "fact_b": "SELECT o_orderkey, l_linenumber, ship AS event, old_sk AS fk FROM orders JOIN (SELECT l_orderkey, l_linenumber, min(l_shipdate) AS ship FROM lineitem GROUP BY l_orderkey, l_linenumber) l ON l_orderkey = o_orderkey JOIN legacy_b ON nk = CAST(o_custkey AS STRING) AND o_orderdate >= s AND (o_orderdate < e OR e IS NULL)",
}


#: Small inputs of the queries on configuration and results; the SQL reads the same rows.
ROWS = {
    "catalogue": ("table_name string, column_name string", [
        ("fact_orders", "o_orderkey"), ("fact_orders", "fk"), ("fact_orders", "price"), ("fact_reloaded", "o_orderkey"), ("legacy_customer", "old_sk"), ("legacy_customer", "nk"), ("fact_line", "SK_CUSTOMER"), ("fact_line", "sk_customer_roleB"), ("fact_line", "sk_part"),
        ("fact_line", "l_quantity"), ("fact_line", "customer_note"), ("dim_customer", "sk_customer"), ("dim_customer", "customer_key"), ("dim_part", "sk_part"), ("hub_order", "sk_customer"), ("fact_old", "sk_part"),
    ]),
    "providers": ("provider_table string, sk_col string, archetype string, effective_start_col string", [("dim_customer", "sk_customer", "SCD1", None), ("dim_part", "sk_part", "SCD1", None), ("hub_order", "sk_order", "HUB_SCD2", "o_orderdate")]),
    "registered": ("consumer_table string, fk_col string", [("FACT_OLD", "sk_part")]),
    "roles": ("consumer_table string, fk_col string, provider_table string, repair_status string", [("fact_b", "fk", "DIM_PART", "SELECTED"), ("hub_z", "sk_a", "dim_customer", "FIXED"), ("hub_a", "sk_b", "dim_part", "SELECTED"), ("fact_a", "fk", "dim_gone", "DISCOVERED"), ("hub_a", "sk_a", "hub_order", "SELECTED")]),
    "hubs": ("provider_table string, topo_level int", [("HUB_A", 2), ("hub_z", 1)]),
    "results": ("run_id string, run_at long, consumer_table string, fk_col string, verdict string", [("r1", 1, "fact_a", "fk", "FAIL"), ("r2", 2, "fact_a", "fk", "PASS"), ("r2", 2, "fact_b", "fk", "FAIL"), ("r2", 2, "fact_b", "fk", "INFO"), ("r2", 2, "hub_a", "sk_b", "PASS")]),
}


def rows(spark: SparkSession, name: str) -> DataFrame:
    schema, found = ROWS[name]
    return spark.createDataFrame(found, schema)


def values(name: str) -> str:
    """The rows as a common table expression."""
    schema, found = ROWS[name]
    cell = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    return f"{name}({', '.join(c.split()[0] for c in schema.split(', '))}) AS (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in found)})"


def cte() -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in FIXTURES.items())


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which the whole cluster shares; where it is missing (tests), a folder of this machine, with a local master only."""
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or ""
    if top:
        return top.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file://" + tempfile.gettempdir()


_written: dict[tuple[str, str, str], str] = {}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture's rows, derived once in a session, written, and read from there."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        for t in BASE:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
        path = f"{shared_folder(spark)}/fixtures-{uuid.uuid4().hex}/{name}"
        spark.sql(f"{cte()}\nSELECT * FROM {name}").write.parquet(path)
        _written[key] = path
    return spark.read.parquet(_written[key])
