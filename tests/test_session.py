import pytest

from queryset.errors import ConcurrencyError, TranslationError
from queryset.writes.session import Session
from test_writes import rows, versions  # noqa: F401


def test_tracked_edits_are_saved_by_column(versions):  # noqa: F811
    session = Session(versions)
    blog = session.add("blogs", Name="a")
    session.save()
    session.add("posts", Heading="p", BlogId=blog.Id)
    session.save()
    assert rows(versions, "blogs") == [(1, "a")] and rows(versions, "posts") == [(1, "p", 1)]
    fresh = Session(versions)
    (one,) = fresh.load(fresh.context.blogs)
    assert fresh.find("blogs", 1) is one and fresh.load(fresh.context.blogs)[0] is one and fresh.find("blogs", 9) is None
    one.Name = None
    assert fresh.changes() == {("blogs", (1,)): {"Name": None}}
    assert fresh.load(fresh.context.blogs)[0].Name is None  # the edit is not overwritten
    assert fresh.save() == {"blogs": 1} and fresh.changes() == {} and rows(versions, "blogs") == [(1, None)]
    post = fresh.find("posts", 1)
    assert [b.Id for b in fresh.load(fresh.related("posts", post, "blog"))] == [1]
    assert fresh.related("blogs", one, "posts").where(lambda p: p.Heading == "p").count() == 1
    assert fresh.related("posts", post, "tags").count() == 0
    fresh.remove("posts", post)
    assert fresh.find("posts", 1) is None
    fresh.save()
    assert rows(versions, "posts") == []


def test_untracked_rows_are_copies(versions):  # noqa: F811
    session = Session(versions)
    (a,), (b,) = session.load(session.context.widgets, tracking=False), session.load(session.context.widgets, tracking=False)
    assert a == b and a is not b and not session.rows
    with pytest.raises(TranslationError):
        session.load(session.context.widgets.select(lambda w: w.Name))


def test_stale_rows_and_keys_are_refused(versions):  # noqa: F811
    first, second = (Session(versions, {"widgets": "Version"}) for _ in range(2))
    a, b = first.find("widgets", 1), second.find("widgets", 1)
    a.Name, a.Version = "a", 2
    first.save()
    b.Name = "b"
    with pytest.raises(ConcurrencyError):
        second.save()
    a.Id = 5
    with pytest.raises(TranslationError):
        first.save()
    assert rows(versions, "widgets") == [(1, "a", 2)]


def test_a_nested_value_without_its_owner_is_not_tracked(spark, tmp_path):
    from queryset.sources.model import EntityType, Model
    from queryset.writes.versions import Versions

    spark.createDataFrame([(1, ("A",))], "Id int, Doc struct<City: string>").write.parquet(str(tmp_path / "source" / "owners.parquet"))
    session = Session(Versions(spark, str(tmp_path / "versions"), str(tmp_path / "source"), Model(EntityType("owners", "owners", ("Id",)))))
    with pytest.raises(TranslationError):
        session.load(session.context.owners.select(lambda o: o.Doc))
    (owner,) = session.load(session.context.owners)
    assert owner.Doc == {"City": "A"}
