from itertools import product

import pytest
from pyspark.sql import functions as F

from queryset.llm import mixing


def test_targets_share_the_excess():
    assert mixing.targets({"a": 100, "b": 100}, {"a": 1, "b": 3}, 3) == {"a": 50, "b": 150}
    found = mixing.targets({"a": 1, "b": 100, "c": 0}, {"a": 5, "b": 1, "c": 1}, 3)
    assert found["a"] == 3 and found["c"] == 0 and found["b"] == 98


def brute(supply, quota, members, repeats):
    """Least cost among the largest flows, by trying every flow of unit words."""
    best = (0, 0)
    arcs = [(p, s) for p in range(len(supply)) for s in members[p]]
    for flow in product(*(range(repeats * supply[p] + 1) for p, _ in arcs)):
        out = [sum(f for f, (p, _) in zip(flow, arcs) if p == q) for q in range(len(supply))]
        into = [sum(f for f, (_, s) in zip(flow, arcs) if s == t) for t in range(len(quota))]
        if all(o <= repeats * w for o, w in zip(out, supply)) and all(i <= q for i, q in zip(into, quota)):
            cost = sum(sum(min(max(o - k * w, 0), w) * k for k in range(repeats)) for o, w in zip(out, supply))
            best = max(best, (sum(out), -cost))
    return best


@pytest.mark.parametrize("case", [([2, 1], [3, 2], [[0], [0, 1]]), ([1, 2], [4, 1], [[0, 1], [0]]), ([2, 0, 1], [2, 3], [[0], [1], [0, 1]])])
def test_flow_is_largest_and_cheapest(case):
    supply, quota, members = case
    flow = mixing.min_cost_flow(supply, quota, members, 2)
    out = [sum(v for (p, _), v in flow.items() if p == q) for q in range(len(supply))]
    assert all(sum(v for (_, s), v in flow.items() if s == t) <= q for t, q in enumerate(quota))
    assert (sum(out), -sum(max(o - w, 0) for o, w in zip(out, supply))) == brute(supply, quota, members, 2)


def test_mix_comes_near_targets_and_repeats(spark, docs):
    frame = docs(*((k, "w " * (1 + k * 7 % 23), "en", f"s{k % 3}" if k % 10 else None) for k in range(600)))
    found = mixing.mix_documents(frame).toPandas()
    again = mixing.mix_documents(frame.repartition(7)).toPandas()
    assert sorted(map(tuple, found[["doc_id", "taken"]].values)) == sorted(map(tuple, again[["doc_id", "taken"]].values))
    assert (found.taken <= 3 * found["size"]).all() and len(found) == 600
    by = found.groupby("source", dropna=False).agg(size=("size", "sum"), source_size=("source_size", "max"), target=("target", "max"), taken=("taken", "sum"))
    assert (by["size"] == by.source_size).all() and abs(by.target.sum() - found["size"].sum()) < 1e-6
    assert ((by.target - by.taken).between(0, 3)).all()


def test_overlapping_sources_share_documents(spark):
    rows = spark.createDataFrame([(k, 10, ["a", "b"] if k < 50 else ["b"]) for k in range(100)], "doc_id long, size long, pattern array<string>")
    chosen, goal, routed = mixing.mix(rows, {"a": 1, "b": 1}, 3)
    assert goal == {"a": 750.0, "b": 750.0}
    assert sum(v for (_, s), v in routed.items() if s == "a") == 750 and sum(v for (_, s), v in routed.items() if s == "b") == 750
    assert abs(chosen.agg(F.sum("taken")).first()[0] - 1500) <= 20


def test_too_many_patterns_are_refused(spark):
    rows = spark.createDataFrame([(k, 1, [str(k)]) for k in range(5)], "doc_id long, size long, pattern array<string>")
    with pytest.raises(ValueError):
        mixing.mix(rows, max_patterns=4)


def test_odd_rows(spark, odd, empty):
    found = mixing.mix_documents(odd).collect()
    assert len(found) == odd.count() and mixing.mix_documents(empty).count() == 0
    assert all(r["taken"] == 0 for r in found if r["size"] == 0)
    assert mixing.mixed_documents(odd).columns == odd.columns


def test_small_source_does_not_depend_on_a_hot_one(spark, monkeypatch):
    """The hot source dealt the small one into buckets of a few rows, and a long document at the cut ended it short."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)
    small = [(k, 400 if k % 3 == 0 else 1 + k % 5, ["a"]) for k in range(60)]
    hot = [(1000 + k, 10, ["b"]) for k in range(900)]
    words, quota = sum(n for _, n, _ in small), 2501

    def taken(rows):
        frame = spark.createDataFrame(rows, "doc_id long, size long, pattern array<string>").withColumn("key", F.to_json("pattern"))
        plan = [(p, 0, quota, -(-sum(r[2] == [p] for r in rows) // 8)) for p in sorted({r[2][0] for r in rows})]
        plan = spark.createDataFrame(plan, "p string, base long, rest long, buckets long").select(F.to_json(F.array("p")).alias("key"), "base", "rest", "buckets")
        found = mixing._select(frame, plan, 17).collect()
        assert len(found) == len(rows)
        return {r["doc_id"]: r["taken"] for r in found if r["pattern"] == ["a"]}

    alone = taken(small)
    assert alone == taken(small + hot)
    left = quota - sum(alone.values())
    assert words > quota and left >= 0 and all(n > left for k, n, _ in small if not alone[k])


@pytest.mark.parametrize("seed", range(3))
def test_no_document_that_fits_is_left(spark, docs, monkeypatch, seed):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    frame = docs(*((k, "w " * (300 if k % 5 == 0 else 1 + k % 3), "en", "a" if k < 80 else "b") for k in range(600)))
    found = mixing.mix_documents(frame, seed=seed).toPandas()
    for _, rows in found.groupby("source"):
        left = rows.target.iloc[0] - rows.taken.sum()
        more = rows.copies > rows.copies.min()
        assert more.all() or not more.any() or (rows["size"][~more] > left).all()


def brute_selection(rows, rest, buckets):
    """Which of (doc_id, size, mark) get one copy more: whole buckets in order while all fit, then one by one."""
    dealt = {}
    for doc, size, mark in rows:
        dealt.setdefault(mark % buckets, []).append((mark, doc, size))
    took, left, whole = set(), rest, True
    for bucket in sorted(dealt):
        words = sum(size for *_, size in dealt[bucket])
        whole = whole and words <= left
        for _, doc, size in sorted(dealt[bucket]):
            if size <= left:
                took.add(doc)
                left -= size
    return took


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_overlapping_sources_equal_brute_force(spark, monkeypatch, seed):
    """Patterns over four sources: the flow is the cheapest, and within each pattern the selection is that of the seeded order."""
    import random

    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    made = random.Random(seed)
    patterns = [["a"], ["a", "b"], ["b", "c"], ["c"], ["a", "c", None]]
    rows = [(k, made.choice([1, 2, 5, 60]), made.choice(patterns)) for k in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, size long, pattern array<string>")
    chosen, goal, routed = mixing.mix(frame, {"a": 1, "b": 5, "c": 1, None: 2}, 3, seed)
    found = {r["doc_id"]: r["copies"] for r in chosen.collect()}
    keyed = frame.withColumn("key", F.to_json("pattern"))
    marks = {r["doc_id"]: r["mark"] for r in keyed.select("doc_id", F.xxhash64(F.lit(seed), "key", "doc_id", "size").alias("mark")).collect()}
    assert sum(routed.values()) == pytest.approx(min(sum(n for _, n, _ in rows) * 3, sum(goal.values())), abs=6)
    for pattern in patterns:
        own = [(k, n, marks[k]) for k, n, p in rows if p == pattern]
        words, total = sum(n for _, n, _ in own), sum(v for (p, _), v in routed.items() if list(p) == pattern)
        more = brute_selection(own, total % words, -(-len(own) // 7)) if total % words else set()
        assert {k: found[k] for k, *_ in own} == {k: total // words + (k in more) for k, *_ in own}


def test_flow_of_many_patterns_is_fast():
    import random
    import time

    made = random.Random(5)
    supply = [made.randrange(1, 10 ** made.randrange(1, 9)) for _ in range(2000)]
    members = [sorted(made.sample(range(12), made.randrange(1, 6))) for _ in supply]
    start = time.monotonic()
    flow = mixing.min_cost_flow(supply, [sum(supply) // 6] * 12, members, 3)
    assert time.monotonic() - start < 2 and sum(flow.values()) > sum(supply)


def test_rows_with_repeated_and_null_ids_keep_their_own_copies(spark, docs):
    """The words of the output are those that the mix takes, by source."""
    rows = [(1, "w " * 3, "en", "x"), (1, "w " * 500, "en", "y"), (None, "a b c", "en", "x"), (None, "d e", "en", "y"), (None, "d e", "en", "y"), (2, "w " * 40, "en", "y"), (2, "v " * 40, "en", "y"), (3, None, "en", None)]
    rows += [(10 + k, "w " * (1 + k % 9), "en", "xyz"[k % 3]) for k in range(60)]
    frame = docs(*rows)
    found = mixing.mix_documents(frame).groupBy("source").agg(F.sum("taken").alias("n"))
    out = mixing.mixed_documents(frame)
    got = mixing.sizes(out).groupBy("source").agg(F.sum("size").alias("n"))
    assert out.schema == frame.schema
    assert {r["source"]: r["n"] for r in got.collect()} == {r["source"]: r["n"] for r in found.collect() if r["n"]}


def test_mixed_documents_shuffle_no_texts(spark, sf_dir):
    """A text moves only if its bucket was filled one by one, and then by a broadcast of these buckets' rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = mixing.mixed_documents(docs)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
