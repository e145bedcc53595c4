import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from queryset.domain import context
from queryset.errors import CardinalityError, TranslationError
from queryset.functions.expr import array, cond, record
from queryset.operators.rows import prop, type_is
from queryset.sources.context import Context
from queryset.sources.model import Collection, EntityType, Model, Reference


@pytest.fixture(scope="module")
def ctx(spark, sf_dir):
    return context(spark, sf_dir)


LIBRARY = Model(
    EntityType("authors", "authors", ("Id",), {"books": Collection("books", ("AuthorId",))}),
    EntityType("books", "books", ("Id",), {"author": Reference("authors", ("AuthorId",), required=False)}, hidden=("Shelf",), auto_includes=("author",)),
)


@pytest.fixture(scope="module")
def library(spark):
    tables = {
        "authors": spark.createDataFrame([(1, "Austen"), (2, "Woolf"), (3, None)], "Id int, Name string"),
        "books": spark.createDataFrame([(1, "Emma", 1, "a"), (2, "Orphan", None, "b")], "Id int, Title string, AuthorId int, Shelf string"),
    }
    return Context(spark, "unused", LIBRARY, tables.get)


def rows(query):
    return sorted((tuple(r) for r in query.to_list()), key=str)


def test_collection_counts_keep_zero(library):
    assert rows(library.authors.select(lambda a: record(id=a.Id, n=a.books.count()))) == [(1, 1), (2, 0), (3, 0)]


def test_absent_row_is_null_and_never_zero(library):
    first = library.authors.select(lambda a: record(id=a.Id, title=a.books.order_by(lambda b: b.Id).first_or_default(lambda b: b.Title)))
    assert rows(first) == [(1, "Emma"), (2, None), (3, None)]
    joined = library.authors.left_join(library.books, lambda a: a.Id, lambda b: b.AuthorId, lambda a, b: record(id=a.Id, book=b))
    assert [r["book"] is None for r in joined.order_by(lambda t: t.id).to_list()] == [False, True, True]


def test_optional_navigation_propagates_null(library):
    assert rows(library.books.select(lambda b: record(id=b.Id, author=b.author.Name))) == [(1, "Emma" and "Austen"), (2, None)]
    assert [r[0] for r in rows(library.books.where(lambda b: b.author == None).select(lambda b: b.Id))] == [2]  # noqa: E711


def test_nulls_are_equal_and_negation_is_two_valued(library):
    named = library.authors.select(lambda a: record(id=a.Id, name=a.Name))
    assert [r[0] for r in rows(named.where(lambda t: t.name != "Austen"))] == [2, 3]
    assert [r[0] for r in rows(named.where(lambda t: ~(t.name == "Austen")))] == [2, 3]
    assert [r[0] for r in rows(named.where(lambda t: t.name.isin(["Woolf", None])))] == [2, 3]
    assert rows(named.where(lambda t: t.name.isin(None))) == []
    assert [r[0] for r in rows(named.where(lambda t: record(a=t.name) == record(a=None)))] == [3]


def test_all_over_no_rows_is_true(library):
    assert [r[0] for r in rows(library.authors.where(lambda a: a.books.all(lambda b: b.Title == "Emma")).select(lambda a: a.Id))] == [1, 2, 3]


def test_hidden_columns_are_read_by_name_only(library):
    with pytest.raises(TranslationError):
        library.books.select(lambda b: b.Shelf)
    assert rows(library.books.select(lambda b: prop(b, "Shelf"))) == [("a",), ("b",)]
    assert "Shelf" not in library.books.ignore_auto_includes().to_df().columns


def test_auto_includes(library):
    assert [r["author"] and r["author"]["Name"] for r in library.books.order_by(lambda b: b.Id).to_list()] == ["Austen", None]
    assert "author" not in library.books.ignore_auto_includes().to_df().columns


def test_includes_do_not_multiply(library):
    found = library.authors.include("books").order_by(lambda a: a.Id).to_list()
    assert [len(r["books"]) for r in found] == [1, 0, 0]
    with pytest.raises(TranslationError):
        library.authors.include("books.nothing")


def test_cardinality(ctx):
    none = ctx.nation.where(lambda n: n.n_nationkey < 0)
    for run in (none.first, none.single, lambda: none.max(lambda n: n.n_nationkey), lambda: none.average(lambda n: n.n_nationkey)):
        with pytest.raises(CardinalityError):
            run()
    with pytest.raises(CardinalityError):
        ctx.nation.single()
    assert none.first_or_default() is None and none.single_or_default() is None and none.sum(lambda n: n.n_nationkey) == 0 and none.count() == 0
    ordered = ctx.nation.order_by(lambda n: n.n_nationkey)
    assert (ordered.first()[0], ordered.last()[0], ordered.element_at(3)[0], ordered.element_at_or_default(99)) == (0, 24, 3, None)
    assert ctx.nation.find(7)["n_name"] == "NATION_7" and ctx.nation.find(77) is None
    assert ctx.nation.any() and not none.any() and ctx.nation.all(lambda n: n.n_nationkey >= 0)


def test_count_answers_a_number(ctx):
    assert ctx.lineitem.count(lambda x: x.l_quantity >= 10) == ctx.lineitem.where(lambda x: x.l_quantity >= 10).count()


def client(value):
    return value


@pytest.mark.parametrize(
    "query",
    [
        lambda c: c.nation.where(lambda n: True if n.n_nationkey == 1 else False),
        lambda c: c.nation.where(lambda n: (n.n_nationkey == 1) and (n.n_name == "x")),
        lambda c: c.nation.select(lambda n: client),
        lambda c: c.nation.where(lambda n: n.no_member == 1),
        lambda c: c.set("atlantis"),
        lambda c: c.region.select(lambda r: r.nations),
        lambda c: c.region.select(lambda r: record(name=r.r_name, nations=r.nations)),
        lambda c: c.nation.reverse(),
        lambda c: c.nation.take_while(lambda n: n.n_nationkey < 3),
        lambda c: c.nation.sequence_equal(c.nation),
        lambda c: c.nation.then_by(lambda n: n.n_name),
        lambda c: c.nation.distinct_by(lambda n: n.n_regionkey),
        lambda c: c.embeddings.distinct(),
        lambda c: c.region.union(c.nation),
        lambda c: c.nation.of_type("click_events"),
        lambda c: c.nation.where(lambda n: n.region == n),
        lambda c: c.nation.group_by(lambda n: [1]).select(lambda g: g.count()),
        lambda c: c.nation.join(c.region, lambda n: {"k": 1}, lambda r: r.r_regionkey),
        lambda c: c.nation.where(lambda n: record(a=n.n_name) == record(b=n.n_name)),
        lambda c: c.region.select(lambda r: r.nations.take(2).count()),
        lambda c: c.nation.zip(c.region, lambda a, b: a),
        lambda c: c.customer_names.where(lambda x: x == 1),
        lambda c: c.nation.where(lambda n: [x for x in n.n_name]),
        lambda c: c.nation.where(lambda n: "a" in n.n_name),
    ],
)
def test_refusals(ctx, query):
    with pytest.raises(TranslationError):
        query(ctx)


def test_interceptors_and_hints(spark, sf_dir):
    ctx = context(spark, sf_dir)
    ctx.interceptors.append(lambda q: q.where(lambda n: n.n_nationkey < 3) if q.shape.type.name == "nation" else q)
    assert ctx.nation.as_no_tracking().as_split_query().tag_with("three").count() == 3
    assert ctx.region.count() == 5


def test_type_tests(ctx):
    assert ctx.events.where(lambda e: type_is(e, "click_events")).count() == ctx.click_events.count() > 0


def test_filters_and_columns_reach_the_scan(ctx):
    plan = ctx.orders.where(lambda o: (o.o_totalprice > 100000) & (o.o_orderstatus == "O")).select(lambda o: o.o_orderkey).to_df()._jdf.queryExecution().toString()
    assert "GreaterThan(o_totalprice,100000.0)" in plan.split("PushedFilters")[-1] or "o_totalprice,100000.0), EqualTo(o" in plan.split("PushedFilters")[-1]
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan


def test_references_are_joined_once(ctx):
    query = ctx.orders.where(lambda o: o.customer.c_acctbal > 0).where(lambda o: o.customer.nation.n_name != "x").select(lambda o: record(a=o.customer.c_name, b=o.customer.nation.n_name))
    assert query.to_df()._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet="a%_\\é ", max_size=4)), st.text(alphabet="a%_\\é", max_size=2)), min_size=1, max_size=5))
def test_string_patterns_are_literal(spark, pairs):
    model = Model(EntityType("t", "t", ("i",)))
    table = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "i int, a string, b string")
    ctx = Context(spark, "unused", model, lambda _: table)
    got = ctx.t.select(lambda t: record(i=t.i, c=t.a.contains(t.b), s=t.a.startswith(t.b), e=t.a.endswith(t.b), f=t.a.index_of(t.b))).to_list()
    for i, c, s, e, f in got:
        a, b = pairs[i]
        assert (c, s, e, f) == ((None,) * 4 if a is None else (b in a, a.startswith(b), a.endswith(b), a.find(b)))


def test_arrays(spark):
    model = Model(EntityType("t", "t", ("i",)))
    table = spark.createDataFrame([(1, [3, 1, 2, 3]), (2, []), (3, None)], "i int, xs array<int>")
    ctx = Context(spark, "unused", model, lambda _: table)
    got = ctx.t.order_by(lambda t: t.i).select(lambda t: record(n=t.xs.count(), has=t.xs.contains(3), page=t.xs.order().skip(1).take(2), at=t.xs[1], out=t.xs[9], all=t.xs.all(lambda x: x > 0), two=t.xs.count(lambda x: x > 1)))
    assert [tuple(r) for r in got.to_list()] == [(4, True, [2, 3], 1, None, True, 3), (0, False, [], None, None, True, 0), (0, False, None, None, None, True, 0)]
    assert ctx.t.select(lambda t: record(u=array(1, 2).union(array(2, 3)), c=cond(t.i > 1, "b", "a"))).count() == 3


def test_inline_collections(ctx):
    assert rows(ctx.inline([2, 1], "int")) == [(1,), (2,)] and ctx.inline([], "int").count() == 0


def test_integer_division_goes_toward_zero(spark):
    model = Model(EntityType("t", "t", ("i",)))
    table = spark.createDataFrame([(7, 2), (-7, 2), (7, -2), (-7, -2)], "i int, j int")
    ctx = Context(spark, "unused", model, lambda _: table)
    assert [r[0] for r in ctx.t.select(lambda t: t.i // t.j).to_list()] == [3, -3, -3, 3]


def test_pages_are_top_rows_of_partitions(ctx):
    """Order, offset and limit are planned as one; no exchange takes the whole table to one task."""
    ordered = ctx.orders.order_by(lambda o: o.o_totalprice).then_by(lambda o: o.o_orderkey)
    for query in (ordered.skip(40).take(20), ordered.skip(10).skip(90).take(1), ordered.skip(5).take(30).skip(3)):
        plan = query.select(lambda o: record(o_orderkey=o.o_orderkey)).to_df()._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan and "SinglePartition" not in plan
    keys = [r[0] for r in ordered.select(lambda o: record(k=o.o_orderkey)).to_list()]
    got = lambda q: [r["o_orderkey"] for r in q.to_list()]
    assert got(ordered.skip(40).take(20)) == keys[40:60] and got(ordered.take(20).skip(15)) == keys[15:20]
    assert got(ordered.skip(5).take(30).skip(3).take(4)) == keys[8:12] and got(ordered.take(3).skip(9)) == []
    assert got(ordered.skip(len(keys) - 3)) == keys[-3:]
    assert ordered.skip(2).take(4).count() == 4 and got(ordered.take(9).where(lambda o: o.o_orderkey == keys[8])) == [keys[8]]
    assert got(ordered.take(9).order_by_desc(lambda o: o.o_totalprice).then_by(lambda o: o.o_orderkey).take(2)) == keys[8:6:-1]
    assert ordered.element_at(100)["o_orderkey"] == keys[100]


def test_cancelled_work_ends(spark):
    import threading
    import time

    from pyspark.sql import functions as F

    from queryset.errors import CancelledError
    from queryset.operators.cancel import Cancellation

    @F.udf("long", useArrow=False)
    def slow(k):
        time.sleep(0.5)
        return k

    token, start = Cancellation(spark), time.monotonic()
    threading.Timer(2, token.cancel).start()
    with pytest.raises(CancelledError):
        token.run(lambda: spark.range(80).select(slow("id")).collect())
    assert time.monotonic() - start < 9
    with pytest.raises(CancelledError):
        token.run(lambda: 1)
    assert Cancellation(spark).run(lambda: spark.range(3).count()) == 3
    with pytest.raises(ZeroDivisionError):
        Cancellation(spark).run(lambda: 1 // 0)


def test_client_code_runs_where_the_rows_are(ctx):
    rows = ctx.nation.select_client_rows("k int, t string", lambda k, r: (k, None if k == 3 else r * 2), lambda n: n.n_nationkey, lambda n: n.region.r_name)
    assert rows.count() == 25 and rows.where("k = 3 AND t IS NULL").count() == 1
    assert ctx.region.where(lambda r: r.r_regionkey < 0).select_client_rows("k int", lambda k: (k,), lambda r: r.r_regionkey).count() == 0


def test_sequences_and_casts_of_queries(ctx):
    """A query is a sequence already: results come as lists, sets and dicts of Python."""
    names = ctx.region.select(lambda r: r.r_name)
    assert len(names.to_list()) == len({r[0] for r in names.to_list()}) == 5
    assert set(ctx.region.to_dict("r_regionkey")) == set(range(5))


def test_pairs_are_dealt_over_all_cores(spark, ctx):
    """A small file is one partition; its pairs are not one task."""
    small = ctx.supplier.where(lambda s: s.s_suppkey < 5)
    for test in (None, lambda a, b: a.s_acctbal < b.s_acctbal):
        pairs = small.cross_join(ctx.supplier, lambda a, b: record(a=a.s_suppkey, b=b.s_suppkey), where=test).to_df()
        assert pairs.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_pairs_below_take_little_room(spark, tmp_path):
    """Written pairs take a fraction of a byte, and the same as more rows come; all are there, with nulls, NaN, zeros of both signs, ties and repeated rows."""
    import duckdb

    from queryset import catalog

    room = []
    for n in (1500, 3000):
        folder = tmp_path / str(n)
        folder.mkdir()
        value = f"CASE WHEN i % 50 = 0 THEN NULL WHEN i % 50 = 1 THEN 'NaN'::DOUBLE WHEN i % 50 = 2 THEN 0.0 WHEN i % 50 = 3 THEN '-0.0'::DOUBLE WHEN i % 50 < 20 THEN 7.5 ELSE hash(i) % {n} - 99.5 END"
        table = f"SELECT i // 2 * 2 + (i % 4) // 3 AS s_suppkey, 'S' || i AS s_name, (i % 25)::INT AS s_nationkey, {value} AS s_acctbal FROM range({n}) t(i)"
        duckdb.execute(f"COPY ({table}) TO '{folder}/supplier.parquet' (FORMAT parquet)")
        catalog.queries()["theta_join"](spark, str(folder)).write.parquet(str(folder / "pairs"))
        query = catalog.oracle_sql()["theta_join"].replace("supplier", f"'{folder}/supplier.parquet'")
        files = f"'{folder}/pairs/*.parquet'"
        counts = [f"(SELECT a, b, count(*) AS n FROM ({x}) GROUP BY ALL)" for x in (query, f"SELECT a, b FROM {files}")]
        assert duckdb.execute(f"SELECT count(*) FROM {counts[0]} x FULL JOIN {counts[1]} y USING (a, b, n) WHERE x.a IS NULL OR y.a IS NULL").fetchall() == [(0,)]
        (pairs,) = duckdb.execute(f"SELECT count(*) FROM {files}").fetchall()[0]
        assert pairs > n * n / 4
        room.append(sum(duckdb.execute(f"SELECT sum(total_compressed_size) FROM parquet_metadata({files})").fetchall()[0]) / pairs)
    assert room[1] < 0.7 and room[1] < 1.1 * room[0]


def test_pairs_below_follow_navigations_and_empty_sides(ctx):
    few = ctx.supplier.where(lambda s: s.s_suppkey < 3)
    result = lambda a, b: record(a=a.s_suppkey, b=b.s_suppkey, name=b.nation.n_name)
    keys = lambda s: s.s_acctbal
    below = few.join_below(ctx.supplier, keys, keys, result).to_df()
    where = few.cross_join(ctx.supplier, result, where=lambda a, b: a.s_acctbal < b.s_acctbal).to_df()
    assert sorted(below.collect()) == sorted(where.collect()) != []
    assert few.join_below(ctx.supplier.where(lambda s: s.s_suppkey < 0), keys, keys).to_df().count() == 0
