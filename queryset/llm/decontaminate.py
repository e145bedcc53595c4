"""Benchmark decontamination with an Aho-Corasick automaton over normalised items.

Text is normalised byte by byte: A-Z become a-z, every other ASCII character that is
no digit or letter becomes a space, bytes of other characters stay. Words are joined
by single spaces with one at either end, so a match of " w1 w2 ... wn " is a match of
whole words. The automaton reads a text once; word positions of matches map back to
character offsets in the original text.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of words stay (A-Z lowered), others become a space.
WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
#: Automata that a worker keeps, and texts that it holds as Python objects at a time where it keeps all.
HELD, SLICE_ROWS = 2, 256
#: The same words in a text that is not lower-cased yet.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _words(text: str | None) -> list[bytes]:
    """After the translation the only ASCII white space left is the space."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def windows_of(words: list[bytes], size: int) -> list[list[bytes]]:
    """Every run of ``size`` words; of fewer words, but not none, the whole."""
    return [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []


class Automaton:
    """Windows of benchmark items as one automaton; each pattern holds its items and its number of words."""

    def __init__(self, items: list[tuple[str, str | None]], size: int):
        owners: dict[str, tuple[int, set]] = {}
        for item, text in items:
            for window in windows_of(_words(text), size):
                owners.setdefault((b" " + b" ".join(window) + b" ").decode("latin-1"), (len(window), set()))[1].add(item)
        self.trie = ahocorasick.Automaton()
        for pattern, (n, found) in owners.items():
            self.trie.add_word(pattern, (n, len(pattern), sorted(found)))
        self.empty = not owners
        if owners:
            self.trie.make_automaton()

    def scan(self, text: str) -> tuple[np.ndarray, set]:
        """(position of the space before its first word, words) of all occurrences in a joined text, and the items that occur."""
        if self.empty or not text:
            return NOTHING, set()
        ends, found = [], set()
        for end, (n, size, items) in self.trie.iter(text):
            ends.append((end - size + 1, n))
            found.update(items)
        return (np.array(ends, np.int64) if ends else NOTHING), found


NOTHING = np.zeros((0, 2), np.int64)


def blocks(benchmark: DataFrame, max_bytes: int, id_col: str = "item_id", text_col: str = "text"):
    """The benchmark in blocks of at most ``max_bytes`` of text (one item may be larger), one after the other; one block at least."""
    out, size = [], 0
    for row in benchmark.select(F.col(id_col).cast("string"), F.col(text_col)).toLocalIterator():
        n = len((row[1] or "").encode("utf-8", "surrogatepass"))
        if out and size + n > max_bytes:
            yield out
            out, size = [], 0
        out.append((str(row[0]) if row[0] is not None else "", row[1]))
        size += n
    yield out


class Shared:
    """The benchmark as broadcasts of a block each. The driver holds one block at a time; a Python worker builds automata as it needs them and keeps HELD."""

    built: dict = {}

    def __init__(self, benchmark: DataFrame, max_bytes: int):
        context = benchmark.sparkSession.sparkContext
        self.parts = [(uuid.uuid4().hex, context.broadcast(items)) for items in blocks(benchmark, max_bytes)]

    def automata(self, size: int):
        own = {(name, size) for name, _ in self.parts}
        for other in [k for k in Shared.built if k not in own]:
            del Shared.built[other]
        for name, items in self.parts:
            automaton = Shared.built.get((name, size)) or Automaton(items.value, size)
            if len(Shared.built) < HELD:
                Shared.built[name, size] = automaton
            yield automaton

    def scan(self, column, size: int):
        """For each text of an Arrow column: (text, number of words, (first word, words) of all occurrences, items that occur)."""
        step = SLICE_ROWS if len(self.parts) <= HELD else len(column)  # automata that are not kept are built once for a batch
        for at in range(0, len(column), max(1, step)):
            texts = [x.as_py() for x in column[at : at + step]]
            joined, counts = [], []
            for text in texts:
                words = _words(text)
                counts.append(len(words))
                joined.append((b" " + b" ".join(words) + b" ").decode("latin-1") if words else "")
            spans, items = [NOTHING] * len(texts), [set() for _ in texts]
            for automaton in self.automata(size):
                for k, text in enumerate(joined):
                    found, occurring = automaton.scan(text)
                    if len(found):
                        spans[k] = np.concatenate([spans[k], found])
                        items[k] |= occurring
            for k, text in enumerate(joined):
                if len(spans[k]):
                    spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), "u1") == 0x20)
                    spans[k][:, 0] = np.searchsorted(spaces, spans[k][:, 0])
            yield from zip(texts, counts, spans, items)


def _covered(spans: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in a span."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, spans[:, 0], 1)
    np.add.at(marks, spans[:, 0] + spans[:, 1], -1)
    return np.cumsum(marks)[:n] > 0


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


SCHEMA = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<first:long,last:long,start:long,end:long>>"


def matches(rows: DataFrame, shared: Shared, size: int) -> DataFrame:
    """For each row ``doc_id, text``: words, hit words, items that occur, and the hit runs.

    A run has its first and last word (exclusive) and the character offsets of the
    original text, so that it can be cut out.
    """

    def run(batches):
        for batch in batches:
            out = []
            for key, (text, n, at, items) in zip(batch.column(0).to_pylist(), shared.scan(batch.column(1), size)):
                spans, hits = [], 0
                if len(at):
                    runs = _runs(_covered(at, n))
                    hits = sum(b - a for a, b in runs)
                    places = [m.span() for m in WORD.finditer(text)]
                    spans = [{"first": a, "last": b, "start": places[a][0], "end": places[b - 1][1]} for a, b in runs]
                out.append({"doc_id": key, "n_words": n, "n_hit": hits, "items": sorted(items), "spans": spans})
            yield pa.RecordBatch.from_pylist(out, schema=_arrow)

    span = pa.struct([(x, pa.int64()) for x in ("first", "last", "start", "end")])
    _arrow = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(span))])
    return rows.mapInArrow(run, SCHEMA)


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, percent: int = 5, max_block_bytes: int = 512 << 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items, spans, contaminated``.

    A document is contaminated if it has a hit word and hit words are at least
    ``percent`` of its words. Null and empty texts have no words and no hits; null
    items have no windows; an empty benchmark hits nothing; repeated rows each keep
    their row; other columns are ignored.

    Documents are read once and nothing is shuffled, whatever the size of the benchmark.
    ``max_block_bytes`` limits the memory of one automaton (about 400 bytes a byte of
    text): a larger benchmark is cut into blocks, a worker keeps the automata of HELD
    blocks, and beyond that builds each anew for a batch of texts.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    hit = (F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * percent)
    return matches(rows, Shared(benchmark, max_block_bytes), size).withColumn("contaminated", hit)


def clean_documents(docs: DataFrame, benchmark: DataFrame, size: int = 13, percent: int = 5, max_block_bytes: int = 512 << 10) -> DataFrame:
    """The documents that are not contaminated, rows and columns as they came.

    The verdict is computed beside the row and nothing is joined back. Null and empty
    texts, repeated rows and an empty benchmark are as in ``contamination``: such rows
    stay. An empty table gives no rows.
    """
    shared, at = Shared(benchmark, max_block_bytes), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            kept = [not len(spans) or 100 * int(_covered(spans, n).sum()) < percent * n for _, n, spans, _ in shared.scan(batch.column(at), size)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
