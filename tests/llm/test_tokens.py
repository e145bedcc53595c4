import random
import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from queryset.llm import token_counts, token_files, tokens
from queryset.llm.scratch import new_path

PATH = tokens.default_path()


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 49407), max_size=1500))
def test_dac_round_trip_and_random_access(ids):
    ids = np.array(ids, "<u4")
    dac = token_files.Dac(token_files.pack(ids))
    assert len(dac) == len(ids) and np.array_equal(dac.all(), ids)
    for i in range(0, len(ids), 37):
        assert dac[i] == ids[i]
    with pytest.raises(IndexError):
        dac[len(ids)]


ALPHABET = list("aΣσBé́ \t\x1c\x85\xa0'sd1９.,!<|>İǅ한\U0001f600\x00\n") + ["<|endoftext|>", " 's", "'ll", "Word, word. ", "x" * 80]


def test_word_encoder_equals_the_library():
    encode, made = tokens.encoder(PATH), random.Random(1)
    texts = ["".join(made.choice(ALPHABET) for _ in range(made.randint(0, 20))) for _ in range(3000)]
    assert encode.encode_many(texts) == [encode.whole(t) for t in texts]
    assert encode.encode(None) == b""


def test_word_table_renews(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_WORDS", 40)
    encode = tokens.WordEncoder(PATH)
    texts = [" ".join(f"w{k * j % 91}x{k}" for k in range(12)) for j in range(30)]
    assert encode.encode_many(texts) == [encode.whole(t) for t in texts]
    assert len(encode.ids) <= 40


def expected(rows):
    encode, at, out = tokens.encoder(PATH), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        data = encode.whole(text or "") + np.array([1], "<u4").tobytes()
        out.append((key, at, len(data) // 4, zlib.crc32(data)))
        at += len(data) // 4
    return out


def test_token_files(spark, odd, empty, sf_dir):
    for frame in (odd, empty, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        found = sorted(map(tuple, token_files.token_output(frame, PATH).collect()), key=lambda r: r[1])
        assert found == expected([(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()])


def test_tokens_at_positions(spark, docs):
    frame, path = docs(*((k, f"some words of text {k} and a few more") for k in range(50))), new_path(spark, "test")
    token_files.write_tokens(frame, path, PATH, segment_tokens=64)
    ids = np.concatenate([np.frombuffer(tokens.encoder(PATH).whole(r["text"]) + np.array([1], "<u4").tobytes(), "<u4") for r in frame.orderBy("doc_id").collect()])
    asked = [0, 1, 63, 64, 65, 200, len(ids) - 1, len(ids), -1, None]
    found = token_files.tokens_at(spark, path, spark.createDataFrame([(a,) for a in asked], "position long"))
    assert {r["position"]: r["token"] for r in found.collect()} == {a: int(ids[a]) for a in asked[:7]}


def test_trees_count_edited_texts():
    made, count = random.Random(3), lambda texts: [len(x) // 4 for x in tokens.encoder(PATH).encode_many(texts)]
    words = ["a", "the", "word,", "x.", "É", "don't", "  ", "\n", "\t", "1234", "abcdefgh"]
    for _ in range(120):
        text = " ".join(made.choice(words) for _ in range(made.choice([0, 1, 5, 70, 400])))
        pieces = token_counts.cut(text)
        assert "".join(pieces) == text
        tree = token_counts.Tree([(len(p), n) for p, n in zip(pieces, count(pieces))])
        for _ in range(5):
            start = made.randint(0, len(text) + 3)
            end, insert = start + made.choice([0, 1, 5, 100, 1000]), made.choice(["", " ", "foo", " bar baz ", "qu\nx", " z" * 100])
            text, tree, _ = token_counts.apply_edit(text, tree, start, end, insert, count)
            assert tree.total == (len(text), count([text])[0])
            at = 0
            for size, _ in tree.leaves()[:-1]:
                at += size
                assert text[at - 1] in token_counts.SPACE


def test_an_edit_touches_few_nodes():
    """Thousands of edits that split and merge leaves, at one place and all over: sums hold, nodes touched by edit stay below the square of the path to the root."""
    made, count = random.Random(5), lambda texts: [len(x.split()) for x in texts]
    for spot in (lambda n: n // 3, lambda n: made.randint(0, n)):
        text = " ".join(f"w{k}" for k in range(64 * 1000))
        tree = token_counts.Tree([(len(p), n) for p, n in zip(token_counts.cut(text), count(token_counts.cut(text)))])
        size, path = tree.size, tree.size.bit_length() - 1
        tree.touched = 0
        for k in range(300):
            at = spot(len(text))
            text, tree, encoded = token_counts.apply_edit(text, tree, at, at + 600 * (k % 3 == 2), " more words" * 70 * (k % 3 != 2), count)
            assert encoded < 4000 and tree.total == (len(text), len(text.split()))
            assert tree.count == len(tree.leaves())
        assert tree.size == size and tree.touched / 300 < path**2
        tree.touched = 0
        text, tree, _ = token_counts.apply_edit(text, tree, 0, 1, "x", count)
        assert tree.touched <= 2 * path


def test_a_full_tree_grows():
    leaf, tree = (7, 1), token_counts.Tree([])
    tree.replace(0, 1, [leaf])
    for k in range(2, 300):
        at, _ = tree.find(7 * (k // 2))
        tree.replace(at, at + 1, [leaf, leaf])
        assert tree.total == (7 * k, k) and tree.count == k <= tree.size
    tree.replace(0, tree.size, [])
    assert tree.total == (0, 0) and tree.leaves() == [] and tree.count == 0


def test_recount_equals_whole_encoding_and_encodes_less(spark, docs, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    edits = frame.select("doc_id", F.lit(1).alias("seq"), (F.char_length("text") / 2).cast("int").alias("start"), (F.char_length("text") / 2 + 9).cast("int").alias("end"), F.lit("put in").alias("insert"))
    found = token_counts.recount(frame, token_counts.build(frame, PATH), edits, PATH).collect()
    encode, texts = tokens.encoder(PATH).encode, {r["doc_id"]: r["text"] for r in frame.collect()}
    for r in found:
        text = texts[r["doc_id"]]
        half = len(text) // 2
        edited = text[:half] + "put in" + text[half + 9 :]
        assert (r["n_tokens"], r["n_tokens_edited"], r["n_chars_edited"]) == (len(encode(text)) // 4, len(encode(edited)) // 4, len(edited))
    assert sum(r["n_chars_encoded"] for r in found) < sum(map(len, texts.values())) / 2


def test_recount_of_odd_rows(spark, odd, empty):
    edits = spark.createDataFrame([(4, 2, 0, 0, "first "), (4, 1, 3, 99, " last"), (1, 1, None, None, None), (99, 1, 0, 0, "x"), (None, 1, 0, 0, "x")], "doc_id long, seq int, start int, end int, insert string")
    trees = token_counts.build(odd.where("doc_id <> 5"), PATH)
    found = token_counts.recount(odd, trees, edits, PATH).collect()
    assert len(found) == odd.count() and token_counts.recount(empty, trees, edits, PATH).count() == 0
    assert [(r["n_tokens"], r["n_edits"], r["n_tokens_edited"]) for r in found if r["doc_id"] == 4] == [(1, 2, 3)] * 2
    assert [(r["n_tokens"], r["n_tokens_edited"]) for r in found if r["doc_id"] == 1] == [(0, 0)]
    assert [r["n_tokens"] > 0 for r in found if r["doc_id"] == 5] == [True]


def test_tokens_at_joins_by_equal_keys(spark, docs, tmp_path, monkeypatch):
    """Segments that cross blocks, repeated and odd positions; no nested loop join."""
    from queryset.llm import token_files, tokens

    monkeypatch.setattr(token_files, "PLACE_BLOCK", 64)
    monkeypatch.setattr(token_files, "ASKED", 8)
    path = str(tmp_path / "tokens")
    frame = docs(*((k, " ".join(f"word{k * j % 97}" for j in range(k % 40))) for k in range(60)))
    token_files.write_tokens(frame, path, tokens.default_path(), segment_tokens=100)
    ids = []
    for r in frame.orderBy("doc_id").collect():
        ids += [*np.frombuffer(tokens.encoder(tokens.default_path()).encode(r["text"]), "<u4").tolist(), 1]
    wanted = [0, 0, 5, 99, 100, 101, len(ids) - 1, len(ids), -1, None, *range(200, 260)]
    found = token_files.tokens_at(spark, path, spark.createDataFrame([(p,) for p in wanted], "position long"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    expected = sorted((p, ids[p]) for p in wanted if p is not None and 0 <= p < len(ids))
    assert sorted(map(tuple, found.collect())) == expected


def test_numbers_of_ids_without_ids():
    """Leaves were encoded one by one, and their ids were put together to be counted."""
    made, encode = random.Random(8), tokens.WordEncoder(PATH)
    letters = "abcxyzABÉéñçßİſ日本ю0123''<|>.,!?&-_`~\u0301\u00a0"
    words = ["".join(made.choice(letters) for _ in range(made.randrange(1, 9))) for _ in range(3000)] + ["cañón!!", "É.", "it's", "<|endoftext|>", "x" * 300, "..."]
    texts = ["", " \n ", None, *(" ".join(made.choices(words, k=made.randrange(1, 200))) for _ in range(60))]
    for text, runs in zip(texts, tokens.WordCounter(PATH).count_runs(texts, 64)):
        parts = (text or "").encode().split()
        assert runs == [len(encode.whole(b" ".join(parts[k : k + 64]).decode())) // 4 for k in range(0, len(parts), 64)]
    counter = tokens.counter(PATH)
    trees = [token_counts.Tree(x) for x in token_counts._leaves([x or "" for x in texts], counter.count_runs)]
    for text, tree in zip(texts, trees):
        pieces = token_counts.cut(text or "")
        assert tree.leaves() == [(len(x), len(encode.whole(x)) // 4) for x in pieces]


def test_edits_of_all_documents_are_counted_together():
    """Two edits of each document were two calls a document."""
    made, calls = random.Random(4), []
    texts = ["", *(" ".join(f"w{made.randrange(500)}" for _ in range(150)) for _ in range(40))]
    edits = [{"start": 5, "end": 40, "insert": "more words "}, {"start": 300, "end": 300, "insert": "x"}]

    def count(pieces):
        calls.append(len(pieces))
        return [sum(x) for x in tokens.counter(PATH).count_runs(pieces, 64)]

    rows = token_counts._together([token_counts._recounted(k, x, None, edits) for k, x in enumerate(texts)], count)
    assert len(calls) <= 4
    for k, (text, row) in enumerate(zip(texts, rows)):
        edited = text
        for e in edits:
            edited = edited[: e["start"]] + e["insert"] + edited[e["end"] :]
        assert row[:5] == (k, *count([text]), 2, *count([edited]), len(edited))
