import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from queryset.llm import simhash
from queryset.llm.components import connected_components
from queryset.llm.scratch import written


def union_find(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("kind", ["path", "star", "random", "clique"])
def test_components(spark, kind):
    made, n = random.Random(kind), 60
    pairs = {"path": [(k, k + 1) for k in range(n - 1)], "star": [(0, k) for k in range(1, n)], "random": [(made.randrange(n), made.randrange(n)) for _ in range(40)], "clique": [(a, b) for a in range(9) for b in range(9)]}[kind]
    label = union_find(n, pairs)
    edges = spark.createDataFrame([*pairs, *((b, a) for a, b in pairs[:5]), (None, 3)], "a long, b long")
    found = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert found == {x: label[x] for a, b in pairs if a != b for x in (a, b)}
    assert connected_components(edges.where("false")).count() == 0


def plain(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "ÀB cÉ d E", "a b c d", "the The THE the the the the the", "x y z " * 500])
def test_fingerprint(spark, text):
    assert simhash.fingerprint_of(text) == plain(text)
    if text and len(text.split()) == 4:
        row = spark.range(1).select(F.xxhash64(F.lit(text.replace("A", "a").replace("B", "b").replace("E", "e"))).alias("h")).first()
        assert row["h"] % (1 << 64) == plain(text)


@pytest.mark.parametrize(("count", "radius"), [(2, 4), (3, 4), (4, 4), (5, 4), (2, 3), (3, 6)])
def test_segments_find_every_link(count, radius):
    made = random.Random(count)
    for _ in range(300):
        a = made.getrandbits(64)
        b = a
        for bit in made.sample(range(64), radius):
            b ^= 1 << bit
        assert any((a ^ b) & mask in simhash._balls(mask, ball) for mask, ball in simhash.segments(count, radius))


def brute(prints):
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i][1] ^ prints[j][1]).bit_count() <= 4]
    label = union_find(len(prints), links)
    least = {}
    for k, (key, _) in enumerate(prints):
        if key is not None:
            least[label[k]] = min(least.get(label[k], key), key)
    return sorted(((key, fp, least.get(label[k])) for k, (key, fp) in enumerate(prints)), key=str)


def run(frame):
    return sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(frame).collect()), key=str)


def test_near_duplicates_equal_brute_force(docs):
    made, rows = random.Random(4), []
    for base in range(8):
        words = [f"w{made.randrange(10**6)}" for _ in range(120)]
        for _ in range(made.choice([1, 2, 12])):
            copy = list(words)
            for _ in range(made.randrange(4)):
                copy[made.randrange(len(copy))] = "changed"
            rows.append((len(rows), " ".join(copy)))
    rows += [(1000 + k, t) for k, t in enumerate(["", None, "short", "SHORT", "short"])]
    assert run(docs(*rows)) == brute([(k, plain(t)) for k, t in rows])


@pytest.mark.parametrize(("radius", "n"), [(1, 10), (2, 10**4), (4, 10), (4, 10**5), (4, 10**8), (6, 10**6)])
def test_some_segment_has_a_ball(radius, n):
    count = simhash.best_segments(n, radius)
    assert max(ball for _, ball in simhash.segments(count, radius)) >= 1


@pytest.mark.parametrize(("dense", "count"), [(0, 4), (3, 3), (10**9, 2), (10**9, 4), (64, 3)])
def test_dense_cluster_of_fingerprints(spark, monkeypatch, docs, dense, count):
    """Many fingerprints around few centres; links between them are chains as well."""
    monkeypatch.setattr(simhash, "DENSE", dense)
    monkeypatch.setattr(simhash, "best_segments", lambda *_: count)
    made = np.random.default_rng(8)
    centres = made.integers(0, 1 << 63, 5)
    values = [int(centres[k % 5]) for k in range(400)]
    for k in range(400):
        for bit in made.integers(0, 63, made.integers(0, 7)):
            values[k] ^= 1 << int(bit)
    frame = spark.createDataFrame(list(enumerate(values)), "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: frame)
    assert run(docs((0, ""))) == brute([(k, v) for k, v in enumerate(values)])


def test_odd_rows(odd, empty):
    assert run(odd) == brute([(r["doc_id"], plain(r["text"])) for r in odd.select("doc_id", "text").collect()])
    assert run(empty) == []
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 4, 5] and kept.where("doc_id IS NULL").count() == 2


def test_exploded_rows_are_not_broadcast(spark):
    """Spark takes probes for as few as their fingerprints; a broadcast of them does not fit the driver."""
    points = written(spark.range(1000).select(F.xxhash64("id").alias("fp"), F.xxhash64("id").alias("cluster"), F.lit(None).cast("long").alias("group")), "points")
    plan = lambda frame: frame._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan(simhash._star_links(points.select("fp"), 4))
    links = plan(simhash._index_links(points, 4, 3))
    assert links.count("SortMergeJoin") == 2 and links.count("BroadcastHashJoin") <= 1  # the small table of dense buckets
