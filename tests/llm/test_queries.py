import re
import struct
import sys
import zlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from queryset.llm import catalog, mixing, quality_classifier, tokens
from queryset.llm.scratch import written

sys.path.insert(0, __file__.rsplit("/", 2)[0])
from compare import duck_rows, spark_rows  # noqa: E402
from test_near_copies import brute as similar_components  # noqa: E402

SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, duck, sf_dir):
    assert spark_rows(catalog.queries()[name](spark, sf_dir)) == duck_rows(duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL)))
def test_query_has_a_row_for_each_row(name, spark, sf_dir):
    table = "pages" if name.startswith(("op5", "op9")) else "documents"
    assert catalog.queries()[name](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()


def words(text):
    return [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def contaminated(text, items):
    found, hit = bench_words(text), set()
    joined = {n: {} for n in {len(w) for w in items}}
    for n in joined:
        for k in range(len(found) - n + 1):
            joined[n].setdefault(tuple(found[k : k + n]), []).append(k)
    for window in items:
        for k in joined[len(window)].get(window, ()):
            hit.update(range(k, k + len(window)))
    return bool(hit) and 20 * len(hit) >= len(found)


def test_pipeline_stages(spark, sf_dir):
    """Each stage against plain Python over the stage's own input (the classifier against its query, which held-out accuracy tests)."""
    docs = source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf_dir), "test")
        seen.append(([r.asDict() for r in docs.collect()], out))
        docs = out
    assert all(out.schema == source.schema for _, out in seen[:4])
    rows = lambda frame: sorted(map(tuple, frame.select("doc_id", "text", "source").collect()))
    plain = lambda kept: sorted((r["doc_id"], r["text"], r["source"]) for r in kept)
    before, after = seen[0]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = {r["doc_id"] for r in quality_classifier.judged(source, labels).where("kept").collect()}
    assert rows(after) == plain(r for r in before if r["doc_id"] in kept)
    before, after = seen[1]
    before.sort(key=lambda r: r["doc_id"])
    label = similar_components([r["text"] for r in before])
    assert rows(after) == plain(r for k, r in enumerate(before) if label[k] == k)
    before, after = seen[2]
    items = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = bench_words(r["text"])
        items.update(tuple(w[k : k + 13]) for k in range(max(1, len(w) - 12)) if w)
    assert rows(after) == plain(r for r in before if not contaminated(r["text"], items))
    before, after = seen[3]
    by, total = {}, {}
    for r in before:
        by[r["source"]] = by.get(r["source"], 0) + len(words(r["text"]))
    order = sorted(by, key=lambda s: (s is None, s or ""))
    goal = mixing.targets(by, {s: 1 + k % 3 for k, s in enumerate(order)}, 3)
    times = {}
    for doc, text, origin in rows(after):
        total[origin] = total.get(origin, 0) + len(words(text))
        times[doc] = times.get(doc, 0) + 1
    own = {r["doc_id"]: (r["text"], r["source"]) for r in before}
    assert all(own[doc] == (text, origin) for doc, text, origin in rows(after)) and max(times.values()) <= 3
    for s in order:  # no document that has its words left out would fit
        left = goal[s] - total.get(s, 0)
        inside = [r for r in before if r["source"] == s and words(r["text"])]
        least = min((times.get(r["doc_id"], 0) for r in inside), default=0)
        assert left >= 0 and all(len(words(r["text"])) > left - 1 for r in inside if times.get(r["doc_id"], 0) == least < 3) or left < 1
    before, after = seen[4]
    encode, at = Tokenizer.from_file(tokens.default_path()), 0
    found = sorted(map(tuple, after.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == sorted(r["doc_id"] for r in before)
    texts = {r["doc_id"]: r["text"] for r in before}
    for doc, start, n, crc in found:
        ids = [*encode.encode(texts[doc] or "", add_special_tokens=False).ids, 1]
        assert (start, n, crc) == (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += n


def test_pipeline_on_odd_tables(spark, odd, empty, sf_dir):
    """Nulls, repeated ids and rows, clashing columns, and no rows at all: each stage but the first keeps columns and loses no clean document."""
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, odd, sf_dir).columns == odd.columns, name
        assert stage(spark, odd.limit(0), sf_dir).count() == 0
    ids = sorted((r["doc_id"] for r in corpus_pipeline.clean(spark, odd, sf_dir).collect()), key=str)
    assert ids == sorted((r["doc_id"] for r in odd.collect()), key=str)
    assert corpus_pipeline.encode(spark, odd, sf_dir).count() == odd.count()
    assert corpus_pipeline.classify(spark, empty, sf_dir).count() == 0 and corpus_pipeline.encode(spark, empty, sf_dir).count() == 0


def test_pipeline_runs(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
