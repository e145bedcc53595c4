import threading

import pytest

from queryset.domain import MODEL as DRIVER_MODEL
from queryset.errors import ConcurrencyError, TransactionError, TranslationError
from queryset.sources.model import Collection, EntityType, Model, Reference, Skip
from queryset.writes.versions import UnitOfWork, Versions, execute_delete, execute_update

MODEL = Model(
    EntityType("blogs", "blogs", ("Id",), {"posts": Collection("posts", ("BlogId",))}),
    EntityType("posts", "posts", ("Id",), {"blog": Reference("blogs", ("BlogId",)), "tags": Skip("tags", "post_tags", ("PostId",), ("TagId",))}),
    EntityType("tags", "tags", ("Id",)),
    EntityType("post_tags", "post_tags", ("PostId", "TagId"), {"post": Reference("posts", ("PostId",)), "tag": Reference("tags", ("TagId",))}),
    EntityType("widgets", "widgets", ("Id",)),
)
TABLES = {"blogs": "Id int, Name string", "posts": "Id int, Heading string, BlogId int", "tags": "Id int, Label string", "post_tags": "PostId int, TagId int", "widgets": "Id int, Name string, Version int"}


@pytest.fixture
def versions(spark, tmp_path):
    for name, schema in TABLES.items():
        rows = [(1, "original", 1)] if name == "widgets" else []
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "source" / f"{name}.parquet"))
    return Versions(spark, str(tmp_path / "versions"), str(tmp_path / "source"), MODEL)


def rows(versions, name):
    return sorted(tuple(r) for r in versions.table(name).collect())


def test_insert_update_delete(versions):
    work = UnitOfWork(versions)
    work.add("blogs", Id=work.new_key("blogs"), Name="a")
    assert work.save() == {"blogs": 1} and rows(versions, "blogs") == [(1, "a")]
    work = UnitOfWork(versions)
    work.modify("blogs", 1, Name=None)
    work.save()
    assert rows(versions, "blogs") == [(1, None)]
    work = UnitOfWork(versions)
    work.remove("blogs", 1)
    work.save()
    assert rows(versions, "blogs") == []


def test_generated_keys_follow_placeholders_by_type(versions):
    work = UnitOfWork(versions)
    blogs = [work.new_key("blogs") for _ in range(2)]
    posts = [work.new_key("posts") for _ in range(3)]
    for k, (post, blog) in enumerate(zip(posts, [blogs[0], blogs[1], blogs[1]])):
        work.add("posts", Id=post, Heading=f"p{k}", BlogId=blog)
    for k, blog in enumerate(blogs):
        work.add("blogs", Id=blog, Name=f"b{k}")
    tag = work.new_key("tags")
    work.add("tags", Id=tag, Label="t")
    work.add("post_tags", PostId=posts[2], TagId=tag)
    work.save()
    assert rows(versions, "blogs") == [(1, "b0"), (2, "b1")]
    assert rows(versions, "posts") == [(1, "p0", 1), (2, "p1", 2), (3, "p2", 2)]
    assert rows(versions, "post_tags") == [(3, 1)]
    found = versions.context().posts.select_many(lambda p: p.tags, lambda p, t: t.Label).to_list()
    assert [r[0] for r in found] == ["t"]


def test_unknown_placeholder_changes_nothing(versions):
    work, other = UnitOfWork(versions), UnitOfWork(versions)
    work.add("posts", Id=work.new_key("posts"), Heading="x", BlogId=other.new_key("blogs"))
    with pytest.raises(TranslationError):
        work.save()
    assert rows(versions, "posts") == [] and not versions.open


def test_concurrency_tokens(versions):
    work = UnitOfWork(versions, {"widgets": "Version"})
    work.modify("widgets", 1, original_token=1, Name="new", Version=2)
    work.save()
    assert rows(versions, "widgets") == [(1, "new", 2)]
    for change in (lambda w: w.modify("widgets", 1, original_token=1, Name="stale"), lambda w: w.remove("widgets", 1, original_token=1), lambda w: w.remove("widgets", 5, original_token=1)):
        work = UnitOfWork(versions, {"widgets": "Version"})
        change(work)
        with pytest.raises(ConcurrencyError):
            work.save()
    assert rows(versions, "widgets") == [(1, "new", 2)]


def add(versions, tx, name):
    work = UnitOfWork(versions)
    work.add("blogs", Id=work.new_key("blogs"), Name=name)
    work.save(tx)


def test_transactions_and_savepoints(versions):
    tx = versions.begin()
    add(versions, tx, "lost")
    assert tx.table("blogs").count() == 1 and rows(versions, "blogs") == []
    tx.rollback()
    tx.rollback()
    assert rows(versions, "blogs") == []
    tx = versions.begin()
    add(versions, tx, "kept")
    tx.savepoint("a")
    add(versions, tx, "undone")
    tx.rollback_to("a")
    tx.release("a")
    tx.commit()
    tx.commit()
    assert rows(versions, "blogs") == [(1, "kept")]
    with pytest.raises(TransactionError):
        tx.table("blogs")
    with pytest.raises(TransactionError):
        versions.join(tx.token)
    with pytest.raises(TransactionError):
        versions.begin().rollback_to("nothing")


def test_joined_transaction_is_not_owned(versions):
    tx = versions.begin()
    other = versions.join(tx.token)
    add(versions, other, "one")
    other.commit()
    assert rows(versions, "blogs") == [] and tx.table("blogs").count() == 1
    tx.commit()
    assert rows(versions, "blogs") == [(1, "one")]


def test_commits_of_one_table_conflict(versions):
    a, b = versions.begin(), versions.begin()
    add(versions, a, "a")
    add(versions, b, "b")
    a.commit()
    with pytest.raises(ConcurrencyError):
        b.commit()
    assert rows(versions, "blogs") == [(1, "a")]


def test_bulk_writes(versions):
    with versions.begin() as tx:
        for name in "abc":
            add(versions, tx, name)
        assert execute_update(tx, "blogs", lambda b: b.Name == "b", Name=lambda b: b.Name.upper()) == 1
        assert execute_update(tx, "blogs", None, Name=lambda b: b.Name.concat("!")) == 3
        assert execute_delete(tx, "blogs", lambda b: b.Name == "c!") == 1
        for bad in (lambda: execute_update(tx, "blogs", None), lambda: execute_update(tx, "blogs", None, Nothing=1), lambda: execute_update(tx, "blogs", None, Name=lambda b: print)):
            with pytest.raises(TranslationError):
                bad()
    assert rows(versions, "blogs") == [(1, "a!"), (2, "B!")]


def test_null_conditions_keep_rows(versions):
    with versions.begin() as tx:
        add(versions, tx, None)
        assert execute_delete(tx, "blogs", lambda b: b.Name != "x") == 1
    with versions.begin() as tx:
        add(versions, tx, None)
        assert execute_delete(tx, "blogs", lambda b: b.Name.contains("x")) == 0
    assert [r[1] for r in rows(versions, "blogs")] == [None]


@pytest.fixture
def dangling(spark, tmp_path, sf_dir):
    """Orders of which one in ten has a customer that does not exist, and customers of which one comes twice."""
    from pyspark.sql import functions as F

    for name in ("nation", "region", "events"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(str(tmp_path / "source" / f"{name}.parquet"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 10 == 0, 10**9).otherwise(F.col("o_custkey"))).write.parquet(str(tmp_path / "source" / "orders.parquet"))
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    customers.union(customers.where("c_custkey = 1")).write.parquet(str(tmp_path / "source" / "customer.parquet"))
    return Versions(spark, str(tmp_path / "versions"), str(tmp_path / "source"), DRIVER_MODEL)


def test_bulk_writes_keep_rows_whose_keys_dangle(dangling, spark, duck):
    before = dangling.table("orders")
    total = before.count()
    before.createOrReplaceTempView("o")
    dangling.table("customer").dropDuplicates(["c_custkey"]).createOrReplaceTempView("c")
    expected = spark.sql("SELECT count(*) FROM o JOIN c ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'").first()[0]
    assert 0 < expected < total
    with dangling.begin() as tx:
        assert execute_update(tx, "orders", lambda o: o.customer.c_mktsegment == "BUILDING", o_orderstatus="X") == expected
    assert dangling.table("orders").count() == total and dangling.table("orders").where("o_orderstatus = 'X'").count() == expected
    with dangling.begin() as tx:
        assert execute_update(tx, "orders", None, o_orderpriority=lambda o: o.customer.c_mktsegment) == total
    assert dangling.table("orders").where("o_orderpriority IS NULL").count() == before.where("o_custkey = 1000000000").count()
    with dangling.begin() as tx:
        assert execute_delete(tx, "orders", lambda o: o.customer.c_mktsegment == "BUILDING") == expected
    assert dangling.table("orders").count() == total - expected


def test_bulk_writes_of_derived_and_filtered_types_keep_other_rows(dangling):
    events, orders = dangling.table("events"), dangling.table("orders")
    clicks, total = events.where("event_type = 'click'").count(), events.count()
    with dangling.begin() as tx:
        assert execute_update(tx, "click_events", None, value=0.0) == clicks
        assert execute_delete(tx, "open_orders", None) == orders.where("o_orderstatus <> 'F'").count()
        assert execute_delete(tx, "click_events", None) == clicks
        with pytest.raises(TranslationError):
            execute_delete(tx, "customer_names", None)
    assert dangling.table("events").count() == total - clicks and dangling.table("orders").count() == orders.where("o_orderstatus = 'F'").count()


def test_racing_commits_give_one_winner(versions, monkeypatch):
    """Both pass the check before either publishes; each round one commit wins and the other is told."""
    publish = Versions.publish
    for round_ in range(4):
        gate, found = threading.Barrier(2), []

        def both(self, commit, paths, gate=gate):
            if threading.current_thread().name.startswith("racer") and not getattr(threading.current_thread(), "waited", False):
                threading.current_thread().waited = True
                gate.wait(60)
            return publish(self, commit, paths)

        monkeypatch.setattr(Versions, "publish", both)
        racing = [versions.begin(), versions.begin()]
        for k, tx in enumerate(racing):
            add(versions, tx, f"{round_}{k}")

        def commit(tx, found=found):
            try:
                tx.commit()
                found.append("done")
            except ConcurrencyError:
                found.append("conflict")

        threads = [threading.Thread(target=commit, args=(tx,), name=f"racer{k}") for k, tx in enumerate(racing)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert sorted(found) == ["conflict", "done"]
        assert len(rows(versions, "blogs")) == round_ + 1 and not versions.open


def test_commits_of_different_tables_both_win(versions, monkeypatch):
    a, b = versions.begin(), versions.begin()
    add(versions, a, "a")
    work = UnitOfWork(versions)
    work.add("tags", Id=1, Label="t")
    work.save(b)
    publish, first = Versions.publish, []

    def late(self, commit, paths):
        if not first:
            first.append(1)
            b.commit()  # takes the number that a was about to use
        return publish(self, commit, paths)

    monkeypatch.setattr(Versions, "publish", late)
    a.commit()
    assert rows(versions, "blogs") == [(1, "a")] and rows(versions, "tags") == [(1, "t")]


def test_deletes_go_first_dependents_before_principals(versions):
    work = UnitOfWork(versions)
    blog = work.new_key("blogs")
    work.add("blogs", Id=blog, Name="old")
    work.add("posts", Id=1, Heading="p", BlogId=blog)
    work.save()
    work = UnitOfWork(versions)
    work.remove("blogs", 1)
    work.remove("posts", 1)
    work.add("posts", Id=1, Heading="again", BlogId=7)
    work.add("blogs", Id=7, Name="new")
    work.save()
    assert work.steps == [("delete", "posts"), ("delete", "blogs"), ("write", "blogs"), ("write", "posts")]
    assert rows(versions, "blogs") == [(7, "new")] and rows(versions, "posts") == [(1, "again", 7)]


def test_a_value_in_a_document_is_written_with_its_siblings(spark, tmp_path):
    schema = "Id int, Doc struct<City: string, Lines: array<struct<Name: string, Size: int>>>"
    spark.createDataFrame([(1, ("A", [("x", 1), ("y", 2)])), (2, ("B", []))], schema).write.parquet(str(tmp_path / "source" / "owners.parquet"))
    versions = Versions(spark, str(tmp_path / "versions"), str(tmp_path / "source"), Model(EntityType("owners", "owners", ("Id",))))
    work = UnitOfWork(versions)
    work.modify_document("owners", 1, "Doc", ("Lines", 1, "Size"), 20)
    work.modify_document("owners", 1, "Doc", ("City",), "C")
    assert work.save() == {"owners": 1}
    found = {r["Id"]: r["Doc"] for r in versions.table("owners").collect()}
    assert found[1].asDict(recursive=True) == {"City": "C", "Lines": [{"Name": "x", "Size": 1}, {"Name": "y", "Size": 20}]} and found[2]["City"] == "B"
    for path in (("Lines", 5, "Size"), ("Nothing",)):
        work = UnitOfWork(versions)
        work.modify_document("owners", 1, "Doc", path, 0)
        with pytest.raises(TranslationError):
            work.save()
    work = UnitOfWork(versions)
    work.modify_document("owners", 9, "Doc", ("City",), "C")
    with pytest.raises(ConcurrencyError):
        work.save()
