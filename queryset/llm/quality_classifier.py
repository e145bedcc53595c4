"""Ordinal quality classifier: cumulative-link regression over hashed text features.

Ratings are graded 0, 1, ..., K. One weight vector is shared by all grades and gives a
document's score; ordered thresholds turn it into P(rating <= k) = sigmoid(t_k - score),
so an expected grade and the probability of a rating of at least any grade follow.

Features are the distinct words of a text (lower case, hashed), their beginnings, and a
few shapes of the whole text in steps: capitals, marks, repetition, word length, length.
Only features that go together with the grade in the sample get a weight.
"""

from __future__ import annotations

import operator
import zlib
from itertools import chain
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM = 1 << 18
#: Bytes of words stay (A-Z lowered), other ASCII becomes a space.
WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
MARKS = b"!#$%&*<>|"
CAPITALS = bytes(range(0x41, 0x5B))
#: Words kept by one worker with their bucket or weight; beyond that the table starts anew.
MAX_WORDS = 100_000


def bucket(feature: bytes) -> int:
    return xxhash.xxh64_intdigest(feature, 8) % DIM


def _step(value: float, size: float, most: int) -> int:
    return min(most, int(value / size))


def shapes(data: bytes, words: list[bytes], n_distinct: int) -> list[bytes]:
    """Shapes of a text as features; a single one of a text without words."""
    if not words:
        return [b"\0empty"]
    size, n_words, n_letters = len(data), len(words), sum(map(len, words))
    again = sum(map(operator.eq, words, words[1:]))  # words that repeat the one before
    capitals, marks = size - len(data.translate(None, CAPITALS)), size - len(data.translate(None, MARKS))
    return [
        b"\0capitals%d" % _step(capitals / size, 0.05, 10),
        b"\0marks%d" % _step(marks / size, 0.02, 10),
        b"\0marked%d" % min(12, marks.bit_length()),
        b"\0again%d" % _step(again / n_words, 0.05, 10),
        b"\0distinct%d" % _step(n_distinct / n_words, 0.1, 9) + b" %d" % min(7, n_words.bit_length() // 2),
        b"\0letters%d" % _step(n_letters / n_words, 1, 15),
        b"\0words%d" % n_words.bit_length(),
    ]


class _Table(dict):
    """word -> value, computed when it is first met."""

    def __init__(self, value):
        self.value = value

    def __missing__(self, word: bytes):
        found = self[word] = self.value(word)
        return found


def _features(text: str | None) -> tuple[set[bytes], list[bytes]]:
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.translate(WORD_BYTES).split()
    distinct = set(words)
    return distinct, shapes(data, words, len(distinct))


def begins(word: bytes) -> list[bytes]:
    """A word and its beginnings of four and five bytes, which stems share."""
    return [word, *(word[:k] + b"\1" for k in (4, 5) if len(word) > k)]


@dataclass
class Model:
    weights: np.ndarray  # DIM values
    thresholds: np.ndarray  # ascending, one fewer than grades
    usual: float = 0.0  # nearly all sample rows of the best grade have it as p_top at least

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(rating >= k) for k = 1..K, by row."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -50, 50)))


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, rounds: int = 300, rate: float = 1.0, decay: float = 1e-4, least_rows: int = 8, most_z: float = 6.0, balance: float = 0.5) -> Model:
    """Maximum likelihood with a squared penalty, by Adagrad over all rows in every round.

    A feature keeps the weight zero if fewer than ``least_rows`` rows have it, or if their
    mean grade is less than some standard errors from that of all: ``most_z`` from 6,000
    rows on, fewer with the root of their number, 3.5 at least. ``balance`` 1
    lets grades weigh alike in sum, 0 as their rows. Thresholds are a first one and positive steps. A grade that no row has moves its
    thresholds nowhere; no rows at all give a model of score zero.
    """
    weights, first, steps = np.zeros(DIM), np.array(-1.0), np.full(n_grades - 2, 0.5)
    if not len(rows):
        return Model(weights, first + np.concatenate([[0], np.cumsum(np.exp(steps))]))
    index = np.concatenate(rows)
    lengths = np.array([len(r) for r in rows])
    n_rows = np.bincount(index, minlength=DIM)
    least_z = min(most_z, max(3.5, most_z * (len(rows) / 6000) ** 0.5))
    apart = (grades - grades.mean()) / max(grades.std(), 1e-9)
    common = (n_rows >= least_rows) & (np.abs(np.bincount(index, np.repeat(apart, lengths), DIM)) >= least_z * np.sqrt(np.maximum(n_rows, 1)))
    rows_of = np.repeat(np.arange(len(rows)), lengths)[common[index]]
    lengths = np.bincount(rows_of, minlength=len(rows)) + 1
    index = np.insert(index[common[index]], np.cumsum(lengths - 1) - (lengths - 1), DIM)  # DIM: a slot of weight zero, so that no row is empty
    counts = np.bincount(grades, minlength=n_grades)
    share = (len(rows) / (np.count_nonzero(counts) * np.maximum(counts, 1)))[grades] ** balance / len(rows)
    starts = np.cumsum(lengths) - lengths
    sums = [np.full(DIM, 1e-8), np.array(1e-8), np.full(n_grades - 2, 1e-8)]
    at = np.arange(len(rows))
    for _ in range(rounds):
        score = np.add.reduceat(np.append(weights, 0.0)[index], starts)
        edges = first + np.concatenate([[0], np.cumsum(np.exp(steps))])
        below = 1 / (1 + np.exp(-np.clip(edges[None, :] - score[:, None], -50, 50)))  # P(rating <= k)
        full = np.hstack([np.zeros((len(rows), 1)), below, np.ones((len(rows), 1))])
        p = np.maximum(full[at, grades + 1] - full[at, grades], 1e-9)
        slope = full * (1 - full)
        # Of the mean log likelihood: by score, and by each threshold.
        by_score = -(slope[at, grades + 1] - slope[at, grades]) / p * share
        by_edge = np.zeros((len(rows), n_grades + 1))
        by_edge[at, grades + 1] += slope[at, grades + 1] / p * share
        by_edge[at, grades] -= slope[at, grades] / p * share
        edge = by_edge[:, 1:-1].sum(axis=0)
        tail = np.cumsum(edge[::-1])[::-1]
        up = [np.bincount(index, np.repeat(by_score, lengths), DIM + 1)[:DIM] - decay * weights, edge.sum(), tail[1:] * np.exp(steps)]
        for k, g in enumerate(up):
            sums[k] = sums[k] + g * g
        weights = weights + rate * up[0] / np.sqrt(sums[0])
        first = first + rate * up[1] / np.sqrt(sums[1])
        steps = np.clip(steps + rate * up[2] / np.sqrt(sums[2]), -3, 3)
    return Model(weights, first + np.concatenate([[0], np.cumsum(np.exp(steps))]))


def hashed(rows: DataFrame) -> DataFrame:
    """``grade, buckets`` of ``grade, text``."""

    def run(batches):
        table = _Table(lambda word: [*map(bucket, begins(word))])
        for batch in batches:
            found = []
            for text in batch.column(1):
                words, extra = _features(text.as_py())
                found.append(sorted({*chain.from_iterable(map(table.__getitem__, words)), *map(bucket, extra)}))
            if len(table) > MAX_WORDS:
                table.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["grade", "buckets"])

    return rows.mapInArrow(run, "grade int, buckets array<int>")


def ratings(labels: DataFrame) -> DataFrame:
    """``doc_id, grade`` from quality and toxic (each 0 or 1): 2 good, 1 junk or toxic, 0 both. Rows with a null are no ratings."""
    grade = F.col("quality") + 1 - F.col("toxic")
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.cast("int").alias("grade")).where("doc_id IS NOT NULL AND grade IS NOT NULL")


def train(docs: DataFrame, rated: DataFrame, n_grades: int = 3, sample: int = 6000, seed: int = 8, keep_share: float = 0.97) -> Model:
    """Fit on at most ``sample`` rated documents, the first in the order of a seeded hash.

    The sample's size is a parameter, so what is broadcast (its ids and grades) and
    what is gathered (its hashed features) are bounded. ``keep_share`` of the sample's
    rows of the best grade have ``Model.usual`` as p_top at least.
    """
    order = F.xxhash64(F.lit(seed), "doc_id", "grade")
    chosen = rated.where(F.col("grade").between(0, n_grades - 1)).orderBy(order, "doc_id", "grade").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = texts.join(F.broadcast(chosen.select("doc_id", "grade")), "doc_id").select("grade", "text").limit(2 * sample)
    found = hashed(rows).toArrow()
    lists = found.column("buckets").combine_chunks() if found.num_rows else None
    grades = found.column("grade").to_numpy() if found.num_rows else np.zeros(0, np.int64)
    rows = np.split(lists.values.to_numpy(), lists.offsets.to_numpy()[1:-1]) if found.num_rows else []
    order = np.lexsort((np.array([zlib.crc32(r.tobytes()) for r in rows]), grades)) if len(rows) else []
    rows, grades = [rows[k] for k in order], grades[order] if len(rows) else grades
    model = fit(rows, grades, n_grades)
    best = [r for r, g in zip(rows, grades) if g == n_grades - 1]
    if best:
        model.usual = float(np.quantile(model.tails(np.array([_sum(model.weights, r) for r in best]))[:, -1], 1 - keep_share, method="lower"))
    return model


def _sum(weights: np.ndarray, buckets) -> float:
    """A score: only features with a weight are summed, in order, so all ways to a score agree to the last bit."""
    held = np.sort(np.asarray(buckets, np.int64))
    return float(weights[held[weights[held] != 0]].sum())


def _scorer(weights: np.ndarray):
    """Score of one text, with a table of the words that this task has met."""

    def weighed(word: bytes) -> tuple[int, ...]:
        return tuple(b for b in map(bucket, begins(word)) if weights[b])

    table = _Table(weighed)  # most words have no weight

    def score(text: str | None) -> float:
        words, extra = _features(text)
        held = set(chain.from_iterable(map(table.__getitem__, words))).union(map(bucket, extra))
        if len(table) > MAX_WORDS:
            table.clear()
        return _sum(weights, list(held))

    return score


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, expected_grade, p_top`` of every row, whole texts.

    ``p_top`` is the probability of the best grade. Null and empty texts are scored by
    their shape alone; repeated rows each keep their row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = _scorer(shared.value.weights)
        for batch in batches:
            found = np.array([score(x.as_py()) for x in batch.column(1)], float)
            tails = shared.value.tails(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1].copy())], ["doc_id", "score", "expected_grade", "p_top"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, expected_grade double, p_top double")


def filtered(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows whose best grade is likely enough (see ``judged``); nothing is joined back."""
    limit = min(least, model.usual)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches):
        score = _scorer(shared.value.weights)
        for batch in batches:
            found = np.array([score(x.as_py()) for x in batch.column(at)], float)
            yield batch.filter(pa.array(shared.value.tails(found)[:, -1] >= limit))

    return docs.mapInArrow(run, docs.schema)


def judged(docs: DataFrame, labels: DataFrame, least: float = 0.7, sample: int = 6000) -> DataFrame:
    """``doc_id, expected_grade, p_top, kept`` of every document.

    Kept: the best grade has a probability of at least ``least``, or of what nearly all
    good rows of the sample have, where that is less. So few or uninformative labels
    reject nothing.

    Null and empty texts are judged by their shape (no words); repeated rows each keep
    their row; labels with a null, or of unknown documents, teach nothing, and repeated
    labels count as often as they come; other columns are ignored; an empty table gives
    no rows. Without any label every document is kept.
    """
    model = train(docs, ratings(labels), sample=sample)
    limit = min(least, model.usual)
    return scores(docs, model).select("doc_id", "expected_grade", "p_top", (F.col("p_top") >= limit).alias("kept"))


def kept_documents(docs: DataFrame, labels: DataFrame, least: float = 0.7, sample: int = 6000) -> DataFrame:
    """The documents that the classifier keeps; rows and columns as they came."""
    model = train(docs, ratings(labels), sample=sample)
    return filtered(docs, model, least)
