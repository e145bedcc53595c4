import hashlib
import random

import numpy as np
import pytest

from queryset.llm import recompression, substrings


def brute(rows, size):
    """Windows judged by (doc_id, start), null ids last."""
    first, split = {}, [((r[0] is None, r[0] or 0), (r[1] or "").encode().split()) for r in rows]
    for key, words in split:
        for k in range(len(words) - size + 1):
            window = tuple(words[k : k + size])
            first[window] = min(first.get(window, (key, k)), (key, k))
    out = []
    for (row, (key, words)) in zip(rows, split):
        gone = [False] * len(words)
        for k in range(len(words) - size + 1):
            if first[tuple(words[k : k + size])] < (key, k):
                gone[k : k + size] = [True] * size
        kept = b" ".join(w for w, x in zip(words, gone) if not x)
        out.append((row[0], len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(frame, size):
    return sorted((tuple(r)[:4] for r in substrings.deduplicated(frame, size).collect()), key=str)


def corpus(seed, n, alphabet):
    made = random.Random(seed)
    passages = [[made.choice(alphabet) for _ in range(made.randint(5, 60))] for _ in range(6)]
    rows = []
    for k in range(n):
        words = []
        for _ in range(made.randint(0, 6)):
            words += made.choice(passages) if made.random() < 0.5 else [made.choice(alphabet) for _ in range(made.randint(1, 30))]
        rows.append((k, " ".join(words)))
    return rows


@pytest.mark.parametrize(("size", "alphabet"), [(20, [f"w{k}" for k in range(300)]), (20, ["a", "b"]), (20, ["a"]), (5, ["x", "y", "z"]), (2, ["p", "q", "r", "s"]), (50, ["a", "b", "c"])])
def test_equals_brute_force(docs, size, alphabet):
    rows = corpus(size, 60, alphabet)
    assert run(docs(*rows).repartition(5), size) == brute(rows, size)


def test_small_chunks(docs, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_WORDS", 50)
    rows = corpus(9, 40, [f"w{k}" for k in range(50)])
    assert run(docs(*rows).coalesce(1), 20) == brute(rows, 20)


def test_driver_documents(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert run(frame, 20) == brute([(r["doc_id"], r["text"]) for r in frame.collect()], 20)


def test_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert run(odd, 20) == brute(rows, 20)
    assert run(empty, 20) == []


def test_rows_of_one_id_with_different_texts(docs):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = [(1, a), (1, b), (1, b + " " + a), (2, a + " x " + b)]
    assert run(docs(*rows), 20) == brute(rows, 20)


def test_symbols_of_equal_passages_are_equal():
    made = np.random.default_rng(5)
    passage = made.integers(0, 1 << 60, 200).astype(np.uint64)
    texts = [np.concatenate([made.integers(0, 1 << 60, k).astype(np.uint64), passage, made.integers(0, 1 << 60, 9).astype(np.uint64)]) for k in (0, 3, 50)]
    seen = []
    for words in texts:
        stack = recompression.levels(words, np.zeros(len(words), np.int64), 4)
        names, place = recompression.owners(stack, np.full(len(words), len(words)), 20)
        at = len(words) - 9 - 200
        inside = slice(at, at + 181)
        seen.append((names[inside].tolist(), (place[inside] - at).tolist()))
        assert all(len(a.name) <= len(b.name) for a, b in zip(stack[1:], stack))
    assert seen[0] == seen[1] == seen[2]
