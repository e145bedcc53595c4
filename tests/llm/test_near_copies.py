import random

import pytest

import corpus_pipeline
from queryset.llm import near_copies, simhash
from test_simhash import union_find


def shingles(text):
    words = (text or "").lower().split()
    return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(texts):
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    return union_find(len(texts), links)


def made(seed):
    """Random texts, near copies with one to six changed words, and a group around one short text."""
    some = random.Random(seed)
    word = lambda: f"w{some.randrange(400)}"
    texts = [None, "", "one", "One", "a b c d"]
    for k in range(25):
        words = [word() for _ in range(some.randrange(20, 160))]
        for changed in range(some.randrange(5) if k else 40):
            other = list(words)
            for _ in range(1 + changed % 6):
                other[some.randrange(len(other))] = word()
            texts.append(" ".join(other))
    return texts


@pytest.mark.parametrize(("common", "dense"), [(0, 16), (200_000, 2)])
def test_near_copies_equal_brute_force(spark, docs, monkeypatch, common, dense):
    monkeypatch.setattr(near_copies, "COMMON", common)
    monkeypatch.setattr(near_copies, "DENSE", dense)
    monkeypatch.setattr(near_copies, "COUNTED", 2)
    texts = made(common)
    found = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs(*enumerate(texts)).repartition(5)).collect()}
    assert [found[k] for k in range(len(texts))] == brute(texts)


def test_large_group_around_one_text(spark, docs):
    """Most pairs of the group are below 0.8; links run through the text with few changes, or through chains."""
    some = random.Random(3)
    words = [f"w{some.randrange(900)}" for _ in range(150)]
    texts = []
    for k in range(300):
        other = list(words)
        for _ in range(k % 8):
            other[some.randrange(len(other))] = f"x{some.randrange(40)}"
        texts.append(" ".join(other))
    some.shuffle(texts)
    found = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs(*enumerate(texts))).collect()}
    assert [found[k] for k in range(len(texts))] == brute(texts)


def test_rows_that_differ_in_other_columns(spark):
    """Without source or lang; one row of the least id stays, whatever its other columns."""
    rows = [(1, "a b c d e f", 3), (1, "a b c d e f", 4), (2, "a b c d e f", 3), (1, "other words here", 5), (None, "a b c d e f", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, stars int")
    kept = sorted(map(tuple, near_copies.one_of_each(frame).select("doc_id", "text").collect()), key=str)
    assert kept == [(1, "a b c d e f"), (1, "other words here"), (None, "a b c d e f")]
    assert sorted(map(str, (r["doc_id"] for r in simhash.one_of_each(frame).collect()))) == ["1", "None"]


def test_stage_finds_copies_beyond_four_bits(spark, docs):
    """The stage searched four bits of four-word fingerprints, which keeps both of such a pair."""
    words = [f"v{k * k % 1009}" for k in range(100)]
    other = [*words[:50], "x", *words[51:90], "y", *words[91:]]
    texts = [" ".join(words), " ".join(other)]
    assert (simhash.fingerprint_of(texts[0]) ^ simhash.fingerprint_of(texts[1])).bit_count() > 4
    assert [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs(*enumerate(texts)), "").collect()] == [0]


def test_odd_rows(odd, empty):
    kept = near_copies.one_of_each(odd)
    assert kept.columns == odd.columns and near_copies.one_of_each(empty).count() == 0
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([None, None, 1, 4, 5], key=str)
