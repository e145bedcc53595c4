"""Near copies are found by SimHash tables: odds of the tables, and links against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from queryset.llm import near_copies
from test_near_copies import made, shingles
from test_simhash import union_find


def values(segments):
    """What a set stands for in each table."""
    low = segments & 0xFFFFFFFF
    return [low, *(low ^ (1 << (segments >> (32 + 5 * k) & 31)) for k in range(near_copies.FLIPS))]


@pytest.mark.parametrize("width", [12, 16, 20])
@pytest.mark.parametrize(("a", "b", "common"), [(4, 5, 4), (5, 6, 5), (8, 10, 8), (12, 15, 12), (13, 14, 12), (67, 68, 60), (90, 90, 80), (400, 400, 356)])
def test_tables_miss_fewer_than_one_pair_in_a_million(width, a, b, common):
    """At the least similarity that links; pairs take the tables of the larger set."""
    some, hits = np.random.default_rng(a), []
    for _ in range(40):
        hashes = some.integers(0, 1 << 64, a + b - common, dtype="u8")
        one, other = (values(near_copies._print(x, width)[1]) for x in (hashes[:a], hashes[a - common :]))
        tables = near_copies.tables_for(b, width)
        hits.append(np.any([x[:tables] == y[:tables] for x in one for y in other], axis=0))
    odds = np.mean(hits)
    slack = 3 * np.sqrt(odds * (1 - odds) / np.size(hits))
    assert (1 - odds - slack) ** tables < 1e-6


@pytest.mark.parametrize("seed", [1, 2])
def test_links_equal_brute_force(spark, docs, monkeypatch, seed):
    """Each link, not only components: all pairs that are similar meet in a table and are verified."""
    monkeypatch.setattr(near_copies, "DENSE", 1000)
    some, texts = random.Random(seed), made(seed)
    for k in range(12):
        words = [f"v{some.randrange(5000)}" for _ in range(20 + 25 * k)]
        for copy in range(10):
            other = list(words)
            for _ in range(1 + copy % 5):
                other[some.randrange(len(other))] = f"x{some.randrange(5000)}"
            texts.append(" ".join(other))
    sets = [shingles(t) for t in texts]
    rows = near_copies.written(near_copies.sketches(docs(*enumerate(texts)).repartition(3)), "test")
    number = {r["digest"]: r["doc_id"] for r in rows.orderBy(F.desc("doc_id")).select("doc_id", "digest").collect()}
    points = near_copies.written(rows.dropDuplicates(["digest"]).drop("doc_id", "row", "marks"), "test")
    found = {tuple(sorted((number[r["a"]], number[r["b"]]))) for r in near_copies._links(rows, points).collect()}
    least = sorted(number.values())
    wanted = {(i, j) for i in least for j in least if i < j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    assert found == wanted and len(found) > 100


def test_candidates_are_simhash_buckets(docs):
    """Only sets of four shingles and more stand in tables, in each of their tables with the segment and its flips."""
    text = " ".join(f"w{k}" for k in range(200))
    rows = near_copies.sketches(docs((1, text), (2, "a b c"), (3, None)))
    keys = [r["key"] for r in near_copies._buckets(rows).collect()]
    width = near_copies.width_for(3)
    tables = near_copies.tables_for(196, width)
    assert len(keys) == len(set(keys)) == tables * (1 + near_copies.FLIPS)
    assert {k >> 32 for k in keys} == set(range(tables)) and max(k & 0xFFFFFFFF for k in keys) < 1 << width


def test_flips_within_a_part_are_not_moved(docs):
    """A set had a row for each value; now one for each part, and these hold the same values."""
    some = random.Random(5)
    texts = [" ".join(f"w{some.randrange(9000)}" for _ in range(20 + 30 * k)) for k in range(12)]
    rows = near_copies.sketches(docs(*enumerate(texts)))
    wanted = {(t << 32 | int(v), r["digest"]) for r in rows.collect() for t, x in enumerate(r["segments"]) for v in values(np.array(x))}
    found = near_copies._buckets(rows).collect()
    assert len(found) == len(wanted) and {(r["key"], r["digest"]) for r in found} == wanted
    assert near_copies._parted(rows).count() < 0.75 * len(wanted)


def test_pairs_of_a_group_that_is_not_linked_are_few(spark, docs, monkeypatch):
    """Sets around one text, each in its own words: all pairs of the group were near by their bits and moved to be compared."""
    some, texts = random.Random(7), []
    words = [f"w{some.randrange(900)}" for _ in range(160)]
    for k in range(240):
        other = list(words)
        for at in range(k % 3, 160, 160 // (2 + 5 * (k % 2))):
            other[at] = f"x{some.randrange(10**6)}"
        texts.append(" ".join(other))
    judged, similar = [], near_copies._similar

    def counted(pairs, *others):
        judged.append(pairs.count())
        return similar(pairs, *others)

    monkeypatch.setattr(near_copies, "_similar", counted)
    found = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs(*enumerate(texts))).collect()}
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    assert [found[k] for k in range(len(texts))] == union_find(len(texts), links)
    assert sum(judged) < 10 * len(texts)


def test_bits_of_negative_fingerprints(docs):
    """All 128 bits count, also where a fingerprint is a negative number."""
    some, pairs = random.Random(9), []
    for k in range(40):
        words = [f"v{some.randrange(9000)}" for _ in range(100)]
        pairs += [" ".join(words), " ".join([*words[:60], "x", *words[61:]])]
    rows = near_copies.sketches(docs(*enumerate(pairs)))
    number = {r["digest"]: r["doc_id"] for r in rows.select("doc_id", "digest").collect()}
    met = near_copies._met(rows).where("key IS NULL").collect()
    assert {(2 * k, 2 * k + 1) for k in range(40)} <= {tuple(sorted((number[r["a"]], number[r["b"]]))) for r in met}


def test_what_is_known_of_a_set_joins_it_once(spark, docs):
    """Places and clusters were joined to each row of a set and a bucket, about a hundred a set of a large group."""
    some, texts = random.Random(11), []
    words = [f"w{some.randrange(900)}" for _ in range(160)]
    for k in range(300):
        other = list(words)
        for _ in range(1 + k % 3):
            other[some.randrange(160)] = f"x{some.randrange(10**6)}"
        texts.append(" ".join(other))
    store, made = spark._jsparkSession.sharedState().statusStore(), 0
    before = store.executionsCount()
    assert {r["component_id"] for r in near_copies.near_copies(docs(*enumerate(texts))).collect()} == {0}
    run = store.executionsList(before, int(store.executionsCount() - before))
    for k in range(run.size()):
        values, nodes = store.executionMetrics(run.apply(k).executionId()), store.planGraph(run.apply(k).executionId()).allNodes()
        for node in (nodes.apply(n) for n in range(nodes.size())):
            metrics = node.metrics()
            if "Join" in node.name() and "[digest" in node.desc() and "LeftOuter" in node.desc():
                for metric in (metrics.apply(m) for m in range(metrics.size())):
                    if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                        made += int(values.apply(metric.accumulatorId()).replace(",", ""))
    assert len(texts) <= made <= 3 * len(texts)
