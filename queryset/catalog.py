"""Query catalogue of the relational operators: each query and the same as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queryset.domain import context
from queryset.functions.expr import Array, Expr, array, coalesce, column, cond, constant, guid, make_date, map_of, new_guid, record
from queryset.operators.rows import prop, type_is

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Add ``fn(ctx)``, which gives a Query or a DataFrame, under a name."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            found = fn(context(spark, sf_dir))
            return found if isinstance(found, DataFrame) else found.to_df()

        _QUERIES[name] = run
        if sql:
            _SQL[name] = sql
        return fn

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from queryset import write_catalog

    return {**_QUERIES, **write_catalog.queries()}


def oracle_sql() -> dict[str, str]:
    from queryset import write_catalog

    return {**_SQL, **write_catalog.oracle_sql()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders above a price by market segment."""
    return _QUERIES["flagship"](spark, sf_dir)


def text_list(items, fn: Callable[[Column], Column] = lambda x: x) -> Expr:
    """An array as one text, so that results compare in any engine."""
    return Expr(F.array_join(F.transform(column(items), lambda x: fn(x).cast("string")), ","))


def money(expr) -> Expr:
    return Expr(F.round(column(expr).cast("double"), 2))


@register(
    "flagship",
    """SELECT c_mktsegment AS seg, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_totalprice > 100000 GROUP BY c_mktsegment""",
)
def _(ctx):
    return ctx.orders.where(lambda o: o.o_totalprice > 100000).group_by(lambda o: o.customer.c_mktsegment).select(lambda g: record(seg=g.key, n=g.count(), total=money(g.sum(lambda o: o.o_totalprice))))


# Sources and roots


@register("scan_entity_set", "SELECT * FROM region")
def _(ctx):
    return ctx.region


@register("scan_named_set", "SELECT * FROM nation")
def _(ctx):
    return ctx.set("nation")


@register("keyless_view", "SELECT c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def _(ctx):
    return ctx.customer_names.where(lambda c: c.c_mktsegment == "BUILDING")


@register("inline_collection", "SELECT k, n_name FROM (VALUES (1), (3), (5)) v(k) JOIN nation ON n_nationkey = k")
def _(ctx):
    return ctx.inline([1, 3, 5], "int").join(ctx.nation, lambda k: k, lambda n: n.n_nationkey, lambda k, n: record(k=k, n_name=n.n_name))


@register("query_filter", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def _(ctx):
    return ctx.open_orders.select(lambda o: record(o_orderkey=o.o_orderkey, o_orderstatus=o.o_orderstatus))


@register("ignore_query_filters", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(ctx):
    return ctx.set("open_orders", ignore_filters=["not_finished"]).select(lambda o: record(o_orderkey=o.o_orderkey, o_orderstatus=o.o_orderstatus))


@register(
    "nested_to_list",
    """SELECT n_nationkey, coalesce((SELECT string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY s_suppkey) FROM supplier WHERE s_nationkey = n_nationkey), '') AS keys FROM nation""",
)
def _(ctx):
    return ctx.nation.select(lambda n: record(n_nationkey=n.n_nationkey, keys=text_list(n.suppliers.to_list(lambda s: s.s_suppkey))))


# Projection


@register("select_columns", "SELECT p_name, p_retailprice FROM part")
def _(ctx):
    return ctx.part.select(lambda p: record(p_name=p.p_name, p_retailprice=p.p_retailprice))


@register("select_dto", "SELECT p_partkey AS id, upper(p_name) AS label, p_size * 2 AS twice FROM part")
def _(ctx):
    return ctx.part.select(lambda p: record(id=p.p_partkey, label=p.p_name.upper(), twice=p.p_size * 2))


@register("client_projection", "SELECT n_nationkey AS key, '#' || n_nationkey || ': ' || r_name AS text FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(ctx):
    return ctx.nation.select_client_rows("key int, text string", lambda key, region: (key, f"#{key}: {region}"), lambda n: n.n_nationkey, lambda n: n.region.r_name)


@register("nav_reference_projection", "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _(ctx):
    return ctx.customer.select(lambda c: record(c_custkey=c.c_custkey, n_name=c.nation.n_name))


@register("nav_collection_count", "SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer")
def _(ctx):
    return ctx.customer.select(lambda c: record(c_custkey=c.c_custkey, n=c.orders.count()))


@register("correlated_scalar", "SELECT c_custkey, (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey) AS most FROM customer")
def _(ctx):
    return ctx.customer.select(lambda c: record(c_custkey=c.c_custkey, most=c.orders.max(lambda o: o.o_totalprice)))


@register(
    "nested_collection",
    """SELECT r_regionkey, (SELECT string_agg(n_nationkey || ':' || n_name, ',' ORDER BY n_nationkey) FROM nation WHERE n_regionkey = r_regionkey) AS nations FROM region""",
)
def _(ctx):
    nations = lambda r: r.nations.to_list(lambda n: record(n_nationkey=n.n_nationkey, n_name=n.n_name))
    return ctx.region.select(lambda r: record(r_regionkey=r.r_regionkey, nations=text_list(nations(r), lambda x: F.concat_ws(":", x["n_nationkey"], x["n_name"]))))


@register("conditional_projection", "SELECT c_custkey, round(CASE WHEN c_acctbal > 0 THEN 1000 / c_acctbal END, 4) AS inverse FROM customer")
def _(ctx):
    return ctx.customer.select(lambda c: record(c_custkey=c.c_custkey, inverse=cond(c.c_acctbal > 0, 1000 / c.c_acctbal, None).round(4)))


@register("let_binding", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem WHERE l_extendedprice * (1 - l_discount) > 90000")
def _(ctx):
    lines = ctx.lineitem.let(net=lambda x: x.l_extendedprice * (1 - x.l_discount)).where(lambda t: t.net > 90000)
    return lines.select(lambda t: record(l_orderkey=t.row.l_orderkey, l_linenumber=t.row.l_linenumber, net=t.net.round(4)))


@register("oftype_discriminator", "SELECT event_id, user_id FROM events WHERE event_type = 'click'")
def _(ctx):
    return ctx.events.of_type("click_events").select(lambda e: record(event_id=e.event_id, user_id=e.user_id))


@register("type_test", "SELECT event_id, event_type = 'click' AS is_click FROM events")
def _(ctx):
    return ctx.events.select(lambda e: record(event_id=e.event_id, is_click=type_is(e, "click_events")))


@register(
    "zip_ordered",
    """SELECT n_name, s_name FROM (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) AS k FROM nation) JOIN (SELECT s_name, row_number() OVER (ORDER BY s_suppkey) AS k FROM supplier) USING (k)""",
)
def _(ctx):
    return ctx.nation.order_by(lambda n: n.n_nationkey).zip(ctx.supplier.order_by(lambda s: s.s_suppkey), lambda n, s: record(n_name=n.n_name, s_name=s.s_name))


# Predicates


def _line(x):
    return record(l_orderkey=x.l_orderkey, l_linenumber=x.l_linenumber, l_quantity=x.l_quantity)


@register("where_filter", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 5 AND l_discount > 0.05")
def _(ctx):
    return ctx.lineitem.where(lambda x: (x.l_quantity < 5) & (x.l_discount > 0.05)).select(_line)


@register("where_comparison", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 10 AND l_quantity <= 12 AND l_returnflag <> 'A' AND l_linestatus = 'O'")
def _(ctx):
    return ctx.lineitem.where(lambda x: (x.l_quantity >= 10) & (x.l_quantity <= 12) & (x.l_returnflag != "A") & (x.l_linestatus == "O")).select(_line)


@register("where_logical", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_quantity < 3 OR l_tax = 0) AND NOT l_returnflag = 'R'")
def _(ctx):
    return ctx.lineitem.where(lambda x: ((x.l_quantity < 3) | (x.l_tax == 0.0)) & ~(x.l_returnflag == "R")).select(_line)


@register(
    "null_semantics",
    """SELECT count(*) AS n FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderstatus) AS a, max(CASE WHEN o_totalprice > 300000 THEN o_orderstatus END) AS b FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey
       WHERE a IS NOT DISTINCT FROM b""",
)
def _(ctx):
    best = lambda c: c.orders.where(lambda o: o.o_totalprice > 300000).max(lambda o: o.o_orderstatus)
    return ctx.customer.where(lambda c: c.orders.max(lambda o: o.o_orderstatus) == best(c)).fold(n=lambda g: g.count())


@register("in_list", "SELECT p_partkey, p_size FROM part WHERE p_size IN (3, 7, 11)")
def _(ctx):
    some = ctx.part.where(lambda p: p.p_size.isin([3, 7, 11])).concat(ctx.part.where(lambda p: p.p_size.isin([])))
    return some.select(lambda p: record(p_partkey=p.p_partkey, p_size=p.p_size))


@register("entity_equality", "SELECT o_orderkey FROM orders WHERE o_custkey = 42")
def _(ctx):
    return ctx.orders.where(lambda o: o.customer == 42).select(lambda o: record(o_orderkey=o.o_orderkey))


@register("exists_semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def _(ctx):
    dear = ctx.orders.where(lambda o: o.o_totalprice > 400000)
    return ctx.customer.where_exists(dear, lambda c, o: c.c_custkey == o.o_custkey).select(lambda c: record(c_custkey=c.c_custkey))


@register("exists_any", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def _(ctx):
    return ctx.customer.where(lambda c: c.orders.any(lambda o: o.o_totalprice > 400000)).select(lambda c: record(c_custkey=c.c_custkey))


@register("not_exists_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def _(ctx):
    dear = ctx.orders.where(lambda o: o.o_totalprice > 200000)
    return ctx.customer.where_not_exists(dear, lambda c, o: c.c_custkey == o.o_custkey).select(lambda c: record(c_custkey=c.c_custkey))


@register("all_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND NOT o_totalprice > 50000)")
def _(ctx):
    return ctx.customer.where(lambda c: c.orders.all(lambda o: o.o_totalprice > 50000)).select(lambda c: record(c_custkey=c.c_custkey))


@register("struct_equality", "SELECT c_custkey FROM customer WHERE c_nationkey = 3 AND c_mktsegment = 'MACHINERY'")
def _(ctx):
    return ctx.customer.where(lambda c: record(a=c.c_nationkey, b=c.c_mktsegment) == record(a=3, b="MACHINERY")).select(lambda c: record(c_custkey=c.c_custkey))


# Joins


@register("inner_join", "SELECT c_name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 300000")
def _(ctx):
    dear = ctx.orders.where(lambda o: o.o_totalprice > 300000)
    return ctx.customer.join(dear, lambda c: c.c_custkey, lambda o: o.o_custkey, lambda c, o: record(c_name=c.c_name, o_orderkey=o.o_orderkey))


@register("left_join", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 450000) ON c_custkey = o_custkey")
def _(ctx):
    dear = ctx.orders.where(lambda o: o.o_totalprice > 450000)
    return ctx.customer.left_join(dear, lambda c: c.c_custkey, lambda o: o.o_custkey, lambda c, o: record(c_custkey=c.c_custkey, o_orderkey=o.o_orderkey))


@register("right_join", "SELECT c_custkey, o_orderkey FROM (SELECT * FROM customer WHERE c_acctbal < 0) RIGHT JOIN orders ON c_custkey = o_custkey")
def _(ctx):
    poor = ctx.customer.where(lambda c: c.c_acctbal < 0)
    return poor.right_join(ctx.orders, lambda c: c.c_custkey, lambda o: o.o_custkey, lambda c, o: record(c_custkey=c.c_custkey, o_orderkey=o.o_orderkey))


@register(
    "composite_key_join",
    """SELECT a.l_partkey, a.l_suppkey, a.n, b.q FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL) a
       JOIN (SELECT l_partkey, l_suppkey, max(l_quantity) AS q FROM lineitem GROUP BY ALL) b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey WHERE a.n > 1""",
)
def _(ctx):
    pair = lambda x: record(p=x.l_partkey, s=x.l_suppkey)
    grouped = ctx.lineitem.group_by(pair)
    a = grouped.having(lambda g: g.count() > 1).select(lambda g: record(p=g.key.p, s=g.key.s, n=g.count()))
    b = grouped.select(lambda g: record(p=g.key.p, s=g.key.s, q=g.max(lambda x: x.l_quantity)))
    return a.join(b, lambda x: record(p=x.p, s=x.s), lambda y: record(p=y.p, s=y.s), lambda x, y: record(l_partkey=x.p, l_suppkey=x.s, n=x.n, q=y.q))


@register(
    "group_join",
    """SELECT c_custkey, coalesce((SELECT string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) FROM orders WHERE o_custkey = c_custkey), '') AS keys FROM customer""",
)
def _(ctx):
    return ctx.customer.group_join(ctx.orders, lambda c: c.c_custkey, lambda o: o.o_custkey, lambda o: o.o_orderkey, lambda c, keys: record(c_custkey=c.c_custkey, keys=text_list(keys)))


@register("select_many_nav", "SELECT c_name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey")
def _(ctx):
    return ctx.customer.select_many(lambda c: c.orders, lambda c, o: record(c_name=c.c_name, o_orderkey=o.o_orderkey))


@register("cross_join", "SELECT a.r_name AS a, b.r_name AS b FROM region a CROSS JOIN region b")
def _(ctx):
    return ctx.region.cross_join(ctx.region, lambda a, b: record(a=a.r_name, b=b.r_name))


@register("theta_join", "SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_acctbal < b.s_acctbal")
def _(ctx):
    a, b = (ctx.supplier.select(lambda s: record(key=s.s_suppkey, at=s.s_acctbal)) for _ in range(2))
    return a.join_below(b, lambda a: a.at, lambda b: b.at, lambda a, b: record(a=a.key, b=b.key))


_TOP = "(SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS k FROM orders)"


@register("cross_apply_topn", f"SELECT c_custkey, o_orderkey, o_totalprice FROM customer JOIN {_TOP} ON o_custkey = c_custkey AND k <= 2")
def _(ctx):
    return ctx.customer.select_many(
        lambda c: c.orders.order_by(lambda o: o.o_totalprice, desc=True).take(2), lambda c, o: record(c_custkey=c.c_custkey, o_orderkey=o.o_orderkey, o_totalprice=o.o_totalprice)
    )


@register("outer_apply", f"SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * FROM {_TOP} WHERE k <= 2) ON o_custkey = c_custkey")
def _(ctx):
    return ctx.customer.select_many(lambda c: c.orders.order_by(lambda o: o.o_totalprice, desc=True).take(2), lambda c, o: record(c_custkey=c.c_custkey, o_orderkey=o.o_orderkey), outer=True)


@register("nav_predicate", "SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_7'")
def _(ctx):
    return ctx.orders.where(lambda o: o.customer.nation.n_name == "NATION_7").select(lambda o: record(o_orderkey=o.o_orderkey))


@register("many_to_many", "SELECT DISTINCT p_name, s_name, p_partkey, s_suppkey FROM part JOIN lineitem ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey WHERE p_size = 7")
def _(ctx):
    small = ctx.part.where(lambda p: p.p_size == 7)
    return small.select_many(lambda p: p.suppliers, lambda p, s: record(p_name=p.p_name, s_name=s.s_name, p_partkey=p.p_partkey, s_suppkey=s.s_suppkey))


@register("self_join", "SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey WHERE a.s_suppkey < b.s_suppkey")
def _(ctx):
    pairs = ctx.supplier.join(ctx.supplier, lambda s: s.s_nationkey, lambda s: s.s_nationkey, lambda a, b: record(a=a.s_suppkey, b=b.s_suppkey))
    return pairs.where(lambda t: t.a < t.b)


# Aggregation and grouping


@register("count_all", "SELECT count(*) AS n FROM lineitem")
def _(ctx):
    return ctx.lineitem.fold(n=lambda g: g.count())


@register("count_pred", "SELECT count(*) FILTER (WHERE l_quantity >= 10) AS n FROM lineitem")
def _(ctx):
    return ctx.lineitem.fold(n=lambda g: g.count(lambda x: x.l_quantity >= 10))


@register("sum_selector", "SELECT round(sum(l_extendedprice), 2) AS total, 0.0::DOUBLE AS empty_total FROM lineitem")
def _(ctx):
    both = ctx.lineitem.fold(total=lambda g: money(g.sum(lambda x: x.l_extendedprice)))
    none = ctx.lineitem.where(lambda x: x.l_quantity < 0).fold(empty_total=lambda g: money(g.sum(lambda x: x.l_extendedprice)))
    return both.cross_join(none, lambda a, b: record(total=a.total, empty_total=b.empty_total))


@register("average_selector", "SELECT round(avg(l_discount), 6) AS mean FROM lineitem")
def _(ctx):
    return ctx.lineitem.fold(mean=lambda g: g.average(lambda x: x.l_discount).round(6))


@register("min_max", "SELECT min(o_totalprice) AS low, max(o_totalprice) AS high, min(o_orderdate) AS first FROM orders")
def _(ctx):
    return ctx.orders.fold(low=lambda g: g.min(lambda o: o.o_totalprice), high=lambda g: g.max(lambda o: o.o_totalprice), first=lambda g: g.min(lambda o: o.o_orderdate))


@register("max_by", "SELECT c_mktsegment AS seg, arg_max(c_name, c_acctbal) AS richest FROM customer GROUP BY 1")
def _(ctx):
    return ctx.customer.group_by(lambda c: c.c_mktsegment).select(lambda g: record(seg=g.key, richest=g.max_by(lambda c: c.c_name, lambda c: c.c_acctbal)))


@register("group_by_agg", "SELECT o_orderstatus AS status, count(*) AS n, round(avg(o_totalprice), 2) AS mean FROM orders GROUP BY 1")
def _(ctx):
    return ctx.orders.group_by(lambda o: o.o_orderstatus).select(lambda g: record(status=g.key, n=g.count(), mean=money(g.average(lambda o: o.o_totalprice))))


@register("group_by_composite", "SELECT o_orderstatus AS status, CAST(year(o_orderdate) AS INTEGER) AS y, n_name AS nation, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def _(ctx):
    keys = lambda o: record(status=o.o_orderstatus, y=o.o_orderdate.part("year"), nation=o.customer.nation.n_name)
    return ctx.orders.group_by(keys).select(lambda g: record(status=g.key.status, y=g.key.y, nation=g.key.nation, n=g.count()))


@register("group_by_element_selector", "SELECT CAST(year(o_orderdate) AS INTEGER) AS y, round(sum(o_totalprice), 2) AS total, max(o_totalprice) AS most FROM orders GROUP BY 1")
def _(ctx):
    grouped = ctx.orders.group_by(lambda o: o.o_orderdate.part("year"), lambda o: o.o_totalprice)
    return grouped.select(lambda g: record(y=g.key, total=money(g.sum()), most=g.max()))


@register(
    "final_group_by",
    """SELECT n_regionkey AS key, string_agg(n_nationkey || ':' || n_name, ',' ORDER BY n_nationkey) AS items FROM nation GROUP BY 1""",
)
def _(ctx):
    groups = ctx.nation.group_by(lambda n: n.n_regionkey).to_groups(lambda n: record(k=n.n_nationkey, name=n.n_name))
    return groups.select(lambda t: record(key=t.key, items=text_list(t.items, lambda x: F.concat_ws(":", x["k"], x["name"]))))


@register("having", "SELECT o_custkey AS customer, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 15")
def _(ctx):
    return ctx.orders.group_by(lambda o: o.o_custkey).having(lambda g: g.count() > 15).select(lambda g: record(customer=g.key, n=g.count()))


@register("count_distinct", "SELECT o_orderpriority AS priority, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1")
def _(ctx):
    return ctx.orders.group_by(lambda o: o.o_orderpriority).select(lambda g: record(priority=g.key, n=g.count_distinct(lambda o: o.o_custkey)))


@register("array_aggregate", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 4) AS total FROM embeddings")
def _(ctx):
    return ctx.embeddings.select(lambda e: record(vec_id=e.vec_id, n=e.embedding.count(), total=e.embedding.sum().round(4)))


# Order and cardinality


@register("order_by", "SELECT p_partkey, p_size FROM part ORDER BY p_size NULLS FIRST, p_partkey LIMIT 30")
def _(ctx):
    return ctx.part.order_by(lambda p: p.p_size).then_by(lambda p: p.p_partkey).take(30).select(lambda p: record(p_partkey=p.p_partkey, p_size=p.p_size))


@register("then_by", "SELECT p_partkey, p_brand, p_size FROM part ORDER BY p_brand NULLS FIRST, p_size DESC NULLS LAST, p_partkey LIMIT 40")
def _(ctx):
    ordered = ctx.part.order_by(lambda p: p.p_brand).then_by(lambda p: p.p_size, desc=True).then_by(lambda p: p.p_partkey)
    return ordered.take(40).select(lambda p: record(p_partkey=p.p_partkey, p_brand=p.p_brand, p_size=p.p_size))


@register("order_by_all", "SELECT p_partkey, p_size FROM part ORDER BY p_size NULLS FIRST, p_partkey")
def _(ctx):
    return ctx.part.order_by(lambda p: p.p_size).then_by(lambda p: p.p_partkey).select(lambda p: record(p_partkey=p.p_partkey, p_size=p.p_size))


@register("then_by_all", "SELECT p_partkey, p_brand, p_size FROM part ORDER BY p_brand NULLS FIRST, p_size DESC NULLS LAST, p_partkey")
def _(ctx):
    ordered = ctx.part.order_by(lambda p: p.p_brand).then_by(lambda p: p.p_size, desc=True).then_by(lambda p: p.p_partkey)
    return ordered.select(lambda p: record(p_partkey=p.p_partkey, p_brand=p.p_brand, p_size=p.p_size))


@register("skip_take_page", "SELECT p_partkey, p_name FROM part ORDER BY p_size NULLS FIRST, p_partkey LIMIT 20 OFFSET 40")
def _(ctx):
    return ctx.part.order_by(lambda p: p.p_size).then_by(lambda p: p.p_partkey).skip(40).take(20).select(lambda p: record(p_partkey=p.p_partkey, p_name=p.p_name))


@register("take_subquery", "SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey LIMIT (SELECT count(*) FROM region)")
def _(ctx):
    return ctx.nation.order_by(lambda n: n.n_nationkey).take(ctx.region.fold(n=lambda g: g.count())).select(lambda n: record(n_nationkey=n.n_nationkey, n_name=n.n_name))


@register(
    "first_or_default",
    """SELECT r_name, n.n_name FROM region LEFT JOIN (SELECT n_regionkey, min(n_nationkey) AS k FROM nation WHERE n_nationkey > 21 GROUP BY 1) ON n_regionkey = r_regionkey LEFT JOIN nation n ON n.n_nationkey = k""",
)
def _(ctx):
    first = lambda r: r.nations.where(lambda n: n.n_nationkey > 21).order_by(lambda n: n.n_nationkey).first_or_default(lambda n: n.n_name)
    return ctx.region.select(lambda r: record(r_name=r.r_name, n_name=first(r)))


@register("single", "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey = 7")
def _(ctx):
    one = ctx.nation.where(lambda n: n.n_nationkey == 7).select(lambda n: record(n_nationkey=n.n_nationkey, n_name=n.n_name)).single()
    return ctx.spark.createDataFrame([tuple(one)], "n_nationkey int, n_name string")


@register("last_ordered", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey DESC LIMIT 1")
def _(ctx):
    return ctx.orders.order_by(lambda o: o.o_totalprice).then_by(lambda o: o.o_orderkey).reverse().take(1).select(lambda o: record(o_orderkey=o.o_orderkey, o_totalprice=o.o_totalprice))


@register("element_at", "SELECT o_orderkey FROM orders ORDER BY o_totalprice NULLS FIRST, o_orderkey LIMIT 1 OFFSET 100")
def _(ctx):
    return ctx.orders.order_by(lambda o: o.o_totalprice).then_by(lambda o: o.o_orderkey).skip(100).take(1).select(lambda o: record(o_orderkey=o.o_orderkey))


@register("reverse_ordered", "SELECT n_nationkey FROM nation ORDER BY n_nationkey DESC LIMIT 5")
def _(ctx):
    return ctx.nation.order_by(lambda n: n.n_nationkey).reverse().take(5).select(lambda n: record(n_nationkey=n.n_nationkey))


@register("reverse_ordered_all", "SELECT n_nationkey FROM nation ORDER BY n_nationkey DESC")
def _(ctx):
    return ctx.nation.order_by(lambda n: n.n_nationkey).reverse().select(lambda n: record(n_nationkey=n.n_nationkey))


@register("query_contains", "SELECT EXISTS (SELECT 1 FROM nation WHERE n_name = 'NATION_3') AS found, EXISTS (SELECT 1 FROM nation WHERE n_name = 'ATLANTIS') AS missing")
def _(ctx):
    names = ctx.nation.select(lambda n: n.n_name)
    return ctx.spark.createDataFrame([(names.contains("NATION_3"), names.contains("ATLANTIS"))], "found boolean, missing boolean")


@register("find_by_key", "SELECT c_custkey, c_name FROM customer WHERE c_custkey = 42")
def _(ctx):
    row = ctx.customer.find(42)
    return ctx.spark.createDataFrame([(row["c_custkey"], row["c_name"])], "c_custkey long, c_name string")


# Sets


@register("distinct_rows", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def _(ctx):
    return ctx.customer.select(lambda c: record(c_nationkey=c.c_nationkey, c_mktsegment=c.c_mktsegment)).distinct()


@register("distinct_by", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey) AS k FROM orders) WHERE k = 1")
def _(ctx):
    first = ctx.orders.order_by(lambda o: o.o_orderdate).then_by(lambda o: o.o_orderkey).distinct_by(lambda o: o.o_custkey)
    return first.select(lambda o: record(o_custkey=o.o_custkey, o_orderkey=o.o_orderkey))


def _nations(ctx):
    a = ctx.customer.where(lambda c: c.c_acctbal > 9000).select(lambda c: record(k=c.c_nationkey))
    b = ctx.supplier.where(lambda s: s.s_acctbal < 2000).select(lambda s: record(k=s.s_nationkey))
    return a, b


_A, _B = "SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000", "SELECT s_nationkey AS k FROM supplier WHERE s_acctbal < 2000"


@register("union_distinct", f"{_A} UNION {_B}")
def _(ctx):
    a, b = _nations(ctx)
    return a.union(b)


@register("concat_all", f"{_A} UNION ALL {_B}")
def _(ctx):
    a, b = _nations(ctx)
    return a.concat(b)


@register("intersect_rows", f"{_A} INTERSECT {_B}")
def _(ctx):
    a, b = _nations(ctx)
    return a.intersect(b)


@register("except_rows", f"{_A} EXCEPT {_B}")
def _(ctx):
    a, b = _nations(ctx)
    return a.except_(b)


_BY_C = "SELECT c_nationkey AS k, c_custkey AS id, c_name AS name, 0 AS side FROM customer WHERE c_acctbal > 9000"
_BY_S = "SELECT s_nationkey AS k, s_suppkey AS id, s_name AS name, 1 AS side FROM supplier WHERE s_acctbal < 2000"
_FIRST = "SELECT k, id, name FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY side, id) AS r FROM ({rows})) WHERE r = 1"


def _keyed(ctx):
    a = ctx.customer.where(lambda c: c.c_acctbal > 9000).select(lambda c: record(k=c.c_nationkey, id=c.c_custkey, name=c.c_name))
    b = ctx.supplier.where(lambda s: s.s_acctbal < 2000).select(lambda s: record(k=s.s_nationkey, id=s.s_suppkey, name=s.s_name))
    return a, b


@register("union_by", _FIRST.format(rows=f"{_BY_C} UNION ALL {_BY_S}"))
def _(ctx):
    a, b = _keyed(ctx)
    return a.union_by(b, lambda t: t.k, lambda t: t.id)


@register("intersect_by", f"{_FIRST.format(rows=_BY_C)} AND k IN ({_B})")
def _(ctx):
    a, b = _keyed(ctx)
    return a.intersect_by(b.select(lambda t: t.k), lambda t: t.k, lambda t: t.id)


@register("except_by", f"{_FIRST.format(rows=_BY_C)} AND k NOT IN ({_B})")
def _(ctx):
    a, b = _keyed(ctx)
    return a.except_by(b.select(lambda t: t.k), lambda t: t.k, lambda t: t.id)


@register(
    "array_set_ops",
    """WITH c AS (SELECT n_nationkey AS k, coalesce(list(DISTINCT c_mktsegment) FILTER (WHERE c_acctbal > 5000), []) AS a, coalesce(list(DISTINCT c_mktsegment) FILTER (WHERE c_acctbal < 0), []) AS b
                 FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1)
       SELECT k, array_to_string(list_sort(list_distinct(list_concat(a, b))), ',') AS u, array_to_string(list_sort(list_intersect(a, b)), ',') AS i,
              array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), ',') AS e FROM c""",
)
def _(ctx):
    def sets(n):
        a = n.customers.where(lambda c: c.c_acctbal > 5000).to_list(lambda c: c.c_mktsegment)
        b = n.customers.where(lambda c: c.c_acctbal < 0).to_list(lambda c: c.c_mktsegment)
        return record(k=n.n_nationkey, u=text_list(a.union(b).order()), i=text_list(a.intersect(b).order()), e=text_list(a.except_(b).order()))

    return ctx.nation.select(sets)


# Related data


@register("include_reference", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def _(ctx):
    return ctx.orders.include("customer").to_df().select("o_orderkey", F.col("customer.c_name").alias("c_name"))


@register("include_collection", "SELECT r_name, (SELECT string_agg(n_name, ',' ORDER BY n_nationkey) FROM nation WHERE n_regionkey = r_regionkey) AS nations FROM region")
def _(ctx):
    return ctx.region.include("nations").to_df().select("r_name", F.array_join(F.col("nations.n_name"), ",").alias("nations"))


_THEN = """SELECT r_name, (SELECT string_agg(n_name || '/' || (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey), ',' ORDER BY n_nationkey) FROM nation WHERE n_regionkey = r_regionkey) AS nations FROM region"""


def _with_suppliers(df):
    return df.select("r_name", F.array_join(F.transform("nations", lambda n: F.concat_ws("/", n["n_name"], F.size(n["suppliers"]))), ",").alias("nations"))


@register("then_include", _THEN)
def _(ctx):
    return _with_suppliers(ctx.region.include("nations").include("nations.suppliers").to_df())


@register("include_string_path", _THEN)
def _(ctx):
    return _with_suppliers(ctx.region.include("nations.suppliers").to_df())


@register(
    "include_filtered",
    """SELECT c_custkey, coalesce((SELECT string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) FROM
         (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS k FROM orders WHERE o_totalprice > 200000) WHERE k <= 2 AND o_custkey = c_custkey), '') AS keys FROM customer""",
)
def _(ctx):
    best = ctx.customer.include("orders", where=lambda o: o.o_totalprice > 200000, order_by=lambda o: o.o_totalprice, desc=True, take=2)
    return best.to_df().select("c_custkey", F.array_join(F.transform(F.col("orders.o_orderkey"), lambda k: k.cast("string")), ",").alias("keys"))


@register("explicit_load_query", "SELECT count(*) AS n FROM orders WHERE o_custkey = 42 AND o_totalprice > 100000")
def _(ctx):
    loaded = ctx.customer.where(lambda c: c == 42).select_many(lambda c: c.orders, lambda c, o: o)
    return loaded.where(lambda o: o.o_totalprice > 100000).fold(n=lambda g: g.count())


@register("property_by_name", "SELECT p_partkey, p_brand FROM part WHERE p_size > 45")
def _(ctx):
    return ctx.part.where(lambda p: prop(p, "p_size") > 45).select(lambda p: record(p_partkey=prop(p, "p_partkey"), p_brand=prop(p, "p_brand")))


# Scalars


@register("scalar_arithmetic", "SELECT p_partkey, p_size + 3 AS a, p_size - 3 AS b, p_size * 3 AS c, CAST(p_size // 3 AS BIGINT) AS d, p_size % 3 AS e, round(p_retailprice / 7, 4) AS f, -p_size AS g, pow(p_size, 2)::DOUBLE AS h FROM part")
def _(ctx):
    return ctx.part.select(lambda p: record(p_partkey=p.p_partkey, a=p.p_size + 3, b=p.p_size - 3, c=p.p_size * 3, d=p.p_size // 3, e=p.p_size % 3, f=(p.p_retailprice / 7).round(4), g=-p.p_size, h=p.p_size**2))


@register("scalar_bitwise", "SELECT p_partkey, p_size & 6 AS a, p_size | 6 AS b, xor(p_size, 6) AS c, ~p_size AS d, p_size << 2 AS e, p_size >> 1 AS f FROM part")
def _(ctx):
    return ctx.part.select(lambda p: record(p_partkey=p.p_partkey, a=p.p_size.bit_and(6), b=p.p_size.bit_or(6), c=p.p_size.bit_xor(6), d=p.p_size.bit_not(), e=p.p_size.shift_left(2), f=p.p_size.shift_right(1)))


@register("scalar_cast", "SELECT p_partkey, CAST(p_size AS VARCHAR) AS a, CAST(trunc(p_retailprice) AS INTEGER) AS b, CAST(p_size AS DOUBLE) AS c, TRY_CAST(p_name AS INTEGER) AS d FROM part")
def _(ctx):
    return ctx.part.select(lambda p: record(p_partkey=p.p_partkey, a=p.p_size.cast("string"), b=p.p_retailprice.cast("int"), c=p.p_size.cast("double"), d=p.p_name.try_cast("int")))


_LAST = "(SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey)"


@register("coalesce_conditional", f"SELECT c_custkey, coalesce({_LAST}, -1) AS best, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'some' ELSE 'rich' END AS kind FROM customer")
def _(ctx):
    kind = lambda c: cond(c.c_acctbal < 0, "debt", cond(c.c_acctbal < 5000, "some", "rich"))
    return ctx.customer.select(lambda c: record(c_custkey=c.c_custkey, best=coalesce(c.orders.max(lambda o: o.o_totalprice), -1.0), kind=kind(c)))


@register("nullable_access", f"SELECT c_custkey, {_LAST} IS NOT NULL AS has, coalesce({_LAST}, 0) AS value FROM customer")
def _(ctx):
    best = lambda c: c.orders.max(lambda o: o.o_totalprice)
    return ctx.customer.select(lambda c: record(c_custkey=c.c_custkey, has=best(c).has_value(), value=best(c).value_or(0.0)))


@register("array_index", "SELECT vec_id, embedding[1] AS a, embedding[label + 1] AS b, embedding[1000] AS c, CAST(len(embedding) AS INTEGER) AS n FROM embeddings")
def _(ctx):
    return ctx.embeddings.select(lambda e: record(vec_id=e.vec_id, a=e.embedding[0], b=e.embedding[e.label], c=e.embedding[999], n=e.embedding.length()))


@register("string_predicates", "SELECT p_partkey, contains(p_name, 'ring') AS a, starts_with(p_name, 'red') AS b, ends_with(p_name, 'widget') AS c, p_name = 'small ring' AS d, CAST(length(p_name) AS INTEGER) AS n FROM part")
def _(ctx):
    return ctx.part.select(lambda p: record(p_partkey=p.p_partkey, a=p.p_name.contains("ring"), b=p.p_name.startswith("red"), c=p.p_name.endswith("widget"), d=p.p_name == "small ring", n=p.p_name.length()))


@register("string_funky", r"SELECT doc_id, contains(text, '%') AS a, contains(text, '_') AS b, contains(text, '\') AS c, contains(text, '') AS d, starts_with(text, '%') AS e FROM documents")
def _(ctx):
    return ctx.documents.select(lambda d: record(doc_id=d.doc_id, a=d.text.contains("%"), b=d.text.contains("_"), c=d.text.contains("\\"), d=d.text.contains(""), e=d.text.startswith("%")))


@register(
    "string_functions",
    """SELECT p_partkey, upper(p_name) AS a, lower(p_brand) AS b, trim('  ' || p_name || ' ') AS c, substring(p_name, 3, 4) AS d, replace(p_name, 'e', '3') AS e, CAST(instr(p_name, 'i') - 1 AS INTEGER) AS f, p_name || '/' || p_brand AS g,
              coalesce(p_name, '') = '' AS h, substring(p_name, 4) AS i FROM part""",
)
def _(ctx):
    return ctx.part.select(
        lambda p: record(
            p_partkey=p.p_partkey,
            a=p.p_name.upper(),
            b=p.p_brand.lower(),
            c=constant("  ").concat(p.p_name, " ").trim(),
            d=p.p_name.substring(2, 4),
            e=p.p_name.replace("e", "3"),
            f=p.p_name.index_of("i"),
            g=p.p_name.concat("/", p.p_brand),
            h=p.p_name.is_null_or_empty(),
            i=p.p_name.substring(3),
        )
    )


@register("like_pattern", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%r_n%' AND NOT p_name LIKE '%!%%' ESCAPE '!'")
def _(ctx):
    return ctx.part.where(lambda p: p.p_name.like("%r_n%") & ~p.p_name.like("%!%%", "!")).select(lambda p: record(p_partkey=p.p_partkey, p_name=p.p_name))


@register("regex_match", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^[rs][a-z]+ (ring|widget)$')")
def _(ctx):
    return ctx.part.where(lambda p: p.p_name.regex("^[rs][a-z]+ (ring|widget)$")).select(lambda p: record(p_partkey=p.p_partkey, p_name=p.p_name))


@register(
    "math_functions",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, round(abs(l_discount - 0.05), 4) AS a, CAST(ceil(l_extendedprice) AS BIGINT) AS b, CAST(floor(l_extendedprice) AS BIGINT) AS c, round(sqrt(l_quantity), 4) AS d,
              round(ln(l_extendedprice), 4) AS e, round(log10(l_extendedprice), 4) AS f, round(exp(l_tax), 4) AS g, round(sin(l_quantity), 4) AS h, CAST(sign(l_discount - 0.05) AS DOUBLE) AS i FROM lineitem""",
)
def _(ctx):
    return ctx.lineitem.select(
        lambda x: record(
            l_orderkey=x.l_orderkey,
            l_linenumber=x.l_linenumber,
            l_quantity=x.l_quantity,
            l_extendedprice=x.l_extendedprice,
            a=(x.l_discount - 0.05).abs().round(4),
            b=x.l_extendedprice.ceiling(),
            c=x.l_extendedprice.floor(),
            d=x.l_quantity.sqrt().round(4),
            e=x.l_extendedprice.log().round(4),
            f=x.l_extendedprice.log10().round(4),
            g=x.l_tax.exp().round(4),
            h=x.l_quantity.sin().round(4),
            i=(x.l_discount - 0.05).sign(),
        )
    )


@register(
    "date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(day(ts) AS INTEGER) AS d, CAST(hour(ts) AS INTEGER) AS h, CAST(minute(ts) AS INTEGER) AS mi, date_trunc('hour', ts) AS t, CAST(ts AS DATE) AS day FROM events""",
)
def _(ctx):
    return ctx.events.select(
        lambda e: record(event_id=e.event_id, y=e.ts.part("year"), m=e.ts.part("month"), d=e.ts.part("day"), h=e.ts.part("hour"), mi=e.ts.part("minute"), t=e.ts.truncate("hour"), day=e.ts.date())
    )


@register(
    "date_arithmetic",
    """SELECT o_orderkey, o_orderdate + INTERVAL 10 DAY AS a, o_orderdate + INTERVAL 3 MONTH AS b, CAST(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS BIGINT) AS c, make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS d FROM orders""",
)
def _(ctx):
    end = Expr(F.expr("timestamp_ntz'2002-01-01'"))
    return ctx.orders.select(
        lambda o: record(o_orderkey=o.o_orderkey, a=o.o_orderdate.add("DAY", 10), b=o.o_orderdate.add("MONTH", 3), c=o.o_orderdate.until("DAY", end), d=make_date(o.o_orderdate.part("year"), 1, 1))
    )


@register("guid_functions")
def _(ctx):
    return ctx.nation.select(lambda n: record(n_nationkey=n.n_nationkey, size=new_guid().length()))


@register(
    "guid_parse",
    """SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE g END AS parsed, n_nationkey % 5 <> 0 AS valid, n_nationkey % 5 <> 0 AND g < '80000000-0000-0000-0000-000000000000' AS low
    FROM (SELECT n_nationkey, substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21, 12) AS g FROM (SELECT n_nationkey, md5(n_name) AS m FROM nation))""",
)
def _(ctx):
    """Texts of several forms: bare digits in upper case, in braces, and such as are none."""
    digits = lambda n: Expr(F.upper(F.md5(column(n.n_name))))
    text = lambda n: cond(n.n_nationkey % 5 == 0, "not a guid", cond(n.n_nationkey % 2 == 0, digits(n), Expr(F.concat(F.lit("{"), column(guid(digits(n))), F.lit("}")))))
    low = guid(constant("80000000000000000000000000000000"))
    return ctx.nation.let(g=lambda n: guid(text(n))).select(lambda t: record(n_nationkey=t.row.n_nationkey, parsed=t.g, valid=t.g != None, low=coalesce(t.g < low, False)))  # noqa: E711


@register("enum_functions", "SELECT o_orderkey, flag, (flag & 5) <> 0 AS hit FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 4 END AS flag FROM orders)")
def _(ctx):
    flag = lambda o: cond(o.o_orderstatus == "O", 1, cond(o.o_orderstatus == "F", 2, 4))
    return ctx.orders.let(flag=flag).select(lambda t: record(o_orderkey=t.row.o_orderkey, flag=t.flag, hit=t.flag.bit_and(5) != 0))


@register("bytes_functions", "SELECT c_custkey, CAST(octet_length(encode(c_name)) AS INTEGER) AS n, encode(c_name) = encode('Customer#000000007') AS same FROM customer")
def _(ctx):
    return ctx.customer.select(lambda c: record(c_custkey=c.c_custkey, n=c.c_name.bytes().octets(), same=c.c_name.bytes() == constant("Customer#000000007").bytes()))


@register("array_contains", "SELECT p_partkey, list_contains(string_split(p_name, ' '), 'ring') AS a FROM part")
def _(ctx):
    return ctx.part.select(lambda p: record(p_partkey=p.p_partkey, a=p.p_name.split(" ").contains("ring")))


@register("array_filter", "SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x > 0.1)) AS INTEGER) AS n, len(list_filter(embedding, lambda x: x > 0.3)) > 0 AS some FROM embeddings")
def _(ctx):
    return ctx.embeddings.select(lambda e: record(vec_id=e.vec_id, n=e.embedding.count(lambda x: x > 0.1), some=e.embedding.any(lambda x: x > 0.3)))


@register("array_explode", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def _(ctx):
    return ctx.part.select_many(lambda p: p.p_name.split(" "), lambda p, w: record(p_partkey=p.p_partkey, word=w))


@register("array_paging", "SELECT vec_id, round(list_sum(list_transform(list_sort(embedding)[3:6], lambda x: x::DOUBLE)), 4) AS s, CAST(len(list_distinct(string_split('a,b,a', ','))) AS INTEGER) AS d FROM embeddings")
def _(ctx):
    return ctx.embeddings.select(lambda e: record(vec_id=e.vec_id, s=e.embedding.order().skip(2).take(4).sum().round(4), d=array("a", "b", "a").distinct().count()))


@register("map_access", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, NULL::INTEGER AS missing FROM events")
def _(ctx):
    props = lambda e: map_of("k", e.props.json("$.k", "int"))
    return ctx.events.select(lambda e: record(event_id=e.event_id, k=props(e)["k"], missing=props(e)["z"]))


@register("json_path", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) > 90")
def _(ctx):
    return ctx.events.where(lambda e: e.props.json("$.k", "long") > 90).select(lambda e: record(event_id=e.event_id, k=e.props.json("$.k", "long")))


@register("json_array_filter", "SELECT event_id, CAST(len(list_filter([{'k': CAST(json_extract(props, '$.k') AS INTEGER)}, {'k': 50}], lambda x: x.k >= 50)) AS INTEGER) AS n FROM events")
def _(ctx):
    def parsed(e):
        text = F.to_json(F.array(F.struct(column(e.props.json("$.k", "int")).alias("k")), F.struct(F.lit(50).alias("k"))))
        return Array(F.from_json(text, "array<struct<k:int>>"))

    return ctx.events.select(lambda e: record(event_id=e.event_id, n=parsed(e).count(lambda x: x.k >= 50)))
