"""URL filter: rules first, then naive Bayes over segmented host names and paths.

All words of a page corpus, with their counts, make a unigram model. Each distinct host
name meets those of its substrings that are words by a join, so the model has no size
limit, and a Viterbi search splits the name into its most probable words. Multinomial
naive Bayes over host words and path tokens, hashed into a fixed number of buckets,
learns from the urls that rules decide and judges the others.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queryset.llm.scratch import by_key, written
from queryset.llm.urls import host_of, path_of

BUCKETS = 1 << 16
#: Letters of the longest word of the model.
LONGEST_WORD = 24
#: Letters of the longest name that is split; no valid host has a longer one. A longer run counts as a token of its length.
LONGEST_NAME = 256
TOKEN = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7F]+")
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def rule_columns(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits ``host`` and ``path``; null if none does. Equal lengths go by the rule's text."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, kind in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``word, n`` over the visible text of all pages, words of 2 to LONGEST_WORD letters a-z."""
    visible = F.regexp_replace(F.coalesce(F.col(html_col), F.lit("")), r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<[^>]*>", " ")
    words = F.regexp_extract_all(F.lower(visible), F.lit("[a-z]+"), F.lit(0))
    return pages.select(F.explode(words).alias("word")).where(F.length("word").between(2, LONGEST_WORD)).groupBy("word").agg(F.count("*").alias("n"))


def segment(name: str, words: dict[str, float], longest: int = LONGEST_WORD) -> list[str]:
    """The most probable split of a name into words. An unknown run costs more by each letter."""
    unknown, letter = math.log(1e-7), math.log(1 / 30)
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        found = (-math.inf, 0)
        for start in range(max(0, end - longest), end):
            cost = best[start][0] + words.get(name[start:end], unknown + (end - start) * letter)
            if cost > found[0]:
                found = (cost, start)
        best.append(found)
    out, end = [], len(name)
    while end:
        out.append(name[best[end][1] : end])
        end = best[end][1]
    return out[::-1]


def split_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``name, words`` of distinct names: the most probable words of each, by the counts of all words.

    Substrings of names meet the counts by word; those that many names share meet them as
    hot keys, so no word makes one large task.
    """
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 1
    size = F.length("name")
    starts = names.where(size > 1).select("name", F.explode(F.sequence(F.lit(1), size - 1)).alias("at"))
    sizes = F.sequence(F.lit(2), F.least(F.lit(LONGEST_WORD), size - F.col("at") + 1))
    parts = written(starts.select("name", F.explode(sizes).alias("size"), "at").select("name", F.expr("substring(name, at, size)").alias("word")), "parts")
    asked = written(parts.groupBy("word").agg(F.count("*").alias("parts")).join(counts, "word"), "asked")
    hits = by_key(parts, asked, "word", "parts").groupBy("name").agg(F.collect_set(F.struct("word", "n")).alias("found"))

    def run(batches):
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            words = [segment(name, {r["word"]: math.log(r["n"] / total) for r in found or []}) for name, found in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["name", "words"])

    return names.join(hits, "name", "left").select("name", "found").mapInArrow(run, "name string, words array<string>")


def bucket(kind: str, token: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}:{token}".encode("utf-8", "surrogatepass"), 9) % BUCKETS


def url_tokens(host: str, path: str, names: dict[str, list[str]]) -> list[tuple[str, str]]:
    """Words of the host (kind h) and tokens of the path (kind p); digits count by their number."""
    out = []
    for part in TOKEN.findall(host):
        whole = part[0].isalpha() and len(part) <= LONGEST_NAME
        out += [("h", x) for x in (names.get(part) or segment(part, {}) if whole else [f"#{len(part)}"])]
    return out + [("p", f"#{len(x)}" if x[0].isdigit() else x) for x in TOKEN.findall(path.lower())]


def features(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, rule_verdict, buckets`` of every page, written. Names are split once by distinct name, hosts that hold many pages are no large task."""
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of("url").alias("host"), path_of("url").alias("path"))
    urls = written(urls, "urls")
    hosts = written(urls.groupBy("host").agg(F.count("*").alias("pages")), "hosts")
    found = F.array_distinct(F.regexp_extract_all("host", F.lit("[a-z]+"), F.lit(0)))
    named = written(hosts.select("host", F.explode(found).alias("name")).where(F.length("name") <= LONGEST_NAME), "names")
    names = written(named.groupBy("name").agg(F.count("*").alias("hosts")), "distinct")
    split = written(split_names(names.select("name"), written(word_counts(pages), "words")).join(names, "name"), "split")
    by_host = by_key(named, split, "name", "hosts").groupBy("host").agg(F.collect_list(F.struct("name", "words")).alias("names"))
    rows = by_key(urls, written(hosts.join(by_host, "host", "left"), "hosts"), "host", "pages")
    rule, verdict = rule_columns(rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("rule_verdict"), "names")

    def run(batches):
        for batch in batches:
            hosts, paths, names = (batch.column(k).to_pylist() for k in (1, 2, 5))
            found = [[bucket(*t) for t in url_tokens(host, path, {r["name"]: r["words"] for r in known or []})] for host, path, known in zip(hosts, paths, names)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(found, pa.list_(pa.int32()))], [*batch.schema.names[:5], "buckets"])

    schema = "page_id long, host string, path string, rule string, rule_verdict string, buckets array<int>"
    return written(rows.mapInArrow(run, schema), "features")


def class_counts(found: DataFrame) -> DataFrame:
    """``kind, bucket, n`` over the urls that a rule decides; bucket -1 counts urls."""
    decided = found.where("rule_verdict IN ('allow', 'block')")
    rows = decided.select(F.col("rule_verdict").alias("kind"), F.explode(F.concat(F.array(F.lit(-1)), "buckets")).alias("bucket"))
    return rows.groupBy("kind", "bucket").agg(F.count("*").alias("n"))


def naive_bayes(counts: list) -> np.ndarray:
    """Log odds of block against allow: the prior, then one value by bucket, with add-one smoothing. No examples give zeros."""
    sums = {k: np.zeros(BUCKETS + 1) for k in ("allow", "block")}
    for r in counts:
        sums[r["kind"]][r["bucket"] + 1] += r["n"]
    prior = math.log((sums["block"][0] + 1) / (sums["allow"][0] + 1))
    rate = {k: np.log((v[1:] + 1) / (v[1:].sum() + BUCKETS)) for k, v in sums.items()}
    return np.concatenate([[prior], rate["block"] - rate["allow"]])


def scored(found: DataFrame, weights: np.ndarray) -> DataFrame:
    """The rows with ``log_odds`` in place of ``buckets``."""
    shared = found.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        odds = shared.value
        for batch in batches:
            sums = [float(odds[0] + sum(odds[b + 1] for b in row)) for row in batch.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sums, pa.float64())], [*batch.schema.names[:5], "log_odds"])

    rows = found.select("page_id", "host", "path", "rule", "rule_verdict", "buckets")
    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, rule_verdict string, log_odds double")


def judged(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, log_odds`` of every page.

    Null urls and urls without :// have empty host and path, fit no rule and have no
    tokens: the prior decides. Log odds of block above zero block. Repeated rows each
    keep their row and weigh in the counts; without pages or rules all weights are zero
    and what no rule decides is allowed. Other columns are ignored.

    All that reaches the driver is the number of words and a count by class and bucket,
    at most 2 * (BUCKETS + 1) rows. Counts cover all pages.
    """
    found = features(pages, rules)
    rows = scored(found, naive_bayes(class_counts(found).collect()))
    by_method = F.when(F.col("log_odds") > 0, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", by_method).alias("verdict"), "log_odds")
