"""Catalogue of the write operators: each query gives the table that the write makes, without writing it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queryset.domain import context
from queryset.writes.versions import applied, conflicts, deleted, updated


def execute_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = updated(context(spark, sf_dir), "orders", lambda o: o.o_totalprice > 200000, {"o_totalprice": lambda o: o.o_totalprice + 1, "o_orderpriority": lambda o: o.o_orderpriority.lower()})
    return rows.select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"), "o_orderpriority")


def execute_update_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = updated(context(spark, sf_dir), "orders", lambda o: o.customer.nation.n_name == "NATION_3", {"o_orderstatus": lambda o: o.customer.c_mktsegment})
    return rows.select("o_orderkey", "o_orderstatus")


def execute_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = deleted(context(spark, sf_dir), "orders", lambda o: o.o_totalprice < 100000)
    return rows.select("o_orderkey", "o_totalprice")


def execute_delete_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = deleted(context(spark, sf_dir), "orders", lambda o: o.customer.nation.n_name == "NATION_3")
    return rows.select("o_orderkey", "o_custkey")


def apply_change_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = spark.read.parquet(f"{sf_dir}/nation.parquet")
    inserts = spark.createDataFrame([(25, "NEW_A", 0), (26, "NEW_B", 1)], base.schema)
    updates = spark.createDataFrame([(3, ["n_name"], "RENAMED", None), (4, ["n_regionkey"], None, None)], "n_nationkey int, _changed array<string>, n_name string, n_regionkey int")
    deletes = spark.createDataFrame([(7,), (8,)], "n_nationkey int")
    return applied(base, ["n_nationkey"], inserts, updates, deletes)


def concurrency_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = spark.read.parquet(f"{sf_dir}/nation.parquet")
    read = base.withColumn("n_name", F.when(F.col("n_nationkey") % 5 == 0, F.concat("n_name", F.lit("_old"))).otherwise(F.col("n_name")))
    gone = spark.createDataFrame([(99, "NOWHERE", 0)], base.schema)
    return conflicts(base, read.unionByName(gone), ["n_nationkey"], "n_name")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (execute_update, execute_update_join, execute_delete, execute_delete_join, apply_change_set, concurrency_conflicts)}


def oracle_sql() -> dict[str, str]:
    return {
        "execute_update": """SELECT o_orderkey, round(CASE WHEN o_totalprice > 200000 THEN o_totalprice + 1 ELSE o_totalprice END, 2) AS o_totalprice,
            CASE WHEN o_totalprice > 200000 THEN lower(o_orderpriority) ELSE o_orderpriority END AS o_orderpriority FROM orders""",
        "execute_update_join": """SELECT o_orderkey, CASE WHEN n_name = 'NATION_3' THEN c_mktsegment ELSE o_orderstatus END AS o_orderstatus
            FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
        "execute_delete_join": """SELECT o_orderkey, o_custkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
            WHERE NOT coalesce(n_name = 'NATION_3', false)""",
        "execute_delete": "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT coalesce(o_totalprice < 100000, false)",
        "apply_change_set": """SELECT n_nationkey, CASE n_nationkey WHEN 3 THEN 'RENAMED' ELSE n_name END AS n_name, CASE n_nationkey WHEN 4 THEN NULL ELSE n_regionkey END AS n_regionkey
            FROM nation WHERE n_nationkey NOT IN (7, 8) UNION ALL VALUES (25, 'NEW_A', 0), (26, 'NEW_B', 1)""",
        "concurrency_conflicts": "SELECT n_nationkey FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT 99",
    }
