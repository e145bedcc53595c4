import pytest

from compare import duck_rows, spark_rows
from queryset import catalog

SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, duck, sf_dir):
    assert spark_rows(catalog.queries()[name](spark, sf_dir)) == duck_rows(duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL)))
def test_query_without_sql_runs(name, spark, sf_dir):
    assert catalog.queries()[name](spark, sf_dir).count() > 0


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
    assert set(catalog.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize(("name", "table"), [("order_by_all", "part"), ("then_by_all", "part"), ("reverse_ordered_all", "nation")])
def test_whole_table_in_order(name, table, spark, duck, sf_dir):
    found = catalog.queries()[name](spark, sf_dir)
    assert list(map(tuple, found.collect())) == duck.execute(SQL[name]).fetchall()
    assert found.count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "TakeOrdered" not in plan
