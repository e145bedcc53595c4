"""Edit-aware token counts: a segment tree of pre-token leaves by document.

A leaf is a run of white-space-separated words with the space after them. Every leaf but
the last ends in white space, so words never cross leaves and the count of a document is
the sum over its leaves. Inner nodes hold the sums of characters and tokens below them:
an edit finds its leaves by descending, re-encodes these (and the next one, where the
edit removed the white space between), and updates the sums above them. Spare slots
between the leaves take those that an edit adds.
"""

from __future__ import annotations

import re
from itertools import islice, zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryset.llm import tokens

LEAF_WORDS = 64
SPACE = " \t\n\r\x0b\x0c"
LEAF = re.compile(rf"[{SPACE}]*+(?:[^{SPACE}]++[{SPACE}]++){{0,{LEAF_WORDS - 1}}}+[^{SPACE}]*+[{SPACE}]*+")


def cut(text: str) -> list[str]:
    """A text in leaves; an empty text has none."""
    return [m for m in LEAF.findall(text) if m]


def _leaves(texts: list[str], runs) -> list[list[tuple[int, int]]]:
    """Characters and tokens of the leaves of whole texts. A leaf is a run of LEAF_WORDS words, so ``runs`` counts the words of a text at once."""
    return [[*zip_longest(map(len, cut(x)), tokens_of, fillvalue=0)] for x, tokens_of in zip(texts, runs(texts, LEAF_WORDS))]


EMPTY = (0, 0)


class Tree:
    """Slots in heap order from ``size`` on, each a leaf or empty; node k has the children 2k and 2k + 1.

    A quarter of the slots at least are spare when a tree is built. More leaves than an
    edit found are spread over the narrowest stretch around them that has room, fuller
    stretches being allowed the narrower they are; so an edit costs the logarithm's square
    of the leaves on average. Only a tree that is full as a whole is built anew, wider.
    """

    def __init__(self, leaves: list[tuple[int, int]]):
        self.touched = 0  # nodes summed
        self._build(leaves)

    def _build(self, leaves: list[tuple[int, int]]) -> None:
        self.count = len(leaves)
        self.size = 1 << max(0, -(-4 * self.count // 3) - 1).bit_length()
        self.nodes = [EMPTY] * (2 * self.size)
        self._spread(0, self.size, leaves)

    @classmethod
    def of(cls, nodes: list[tuple[int, int]], count: int) -> Tree:
        """From stored nodes, without summing again."""
        tree = cls.__new__(cls)
        tree.nodes, tree.size, tree.count, tree.touched = nodes, len(nodes) // 2, count, 0
        return tree

    def _spread(self, low: int, high: int, leaves: list[tuple[int, int]]) -> None:
        """The leaves evenly over these slots, and the sums above them."""
        slots = [EMPTY] * (high - low)
        for k, leaf in enumerate(leaves):
            slots[k * len(slots) // len(leaves)] = leaf
        self.nodes[self.size + low : self.size + high] = slots
        low, high = (self.size + low) // 2, (self.size + high - 1) // 2
        while low:
            for k in range(low, high + 1):
                (a, b), (c, d) = self.nodes[2 * k], self.nodes[2 * k + 1]
                self.nodes[k] = (a + c, b + d)
            self.touched += high - low + 1
            low, high = low // 2, high // 2

    @property
    def total(self) -> tuple[int, int]:
        return self.nodes[1]

    def leaves(self, low: int = 0, high: int | None = None) -> list[tuple[int, int]]:
        return [x for x in self.nodes[self.size + low : self.size + (self.size if high is None else high)] if x[0]]

    def find(self, offset: int) -> tuple[int, int]:
        """The slot that holds a character, and the characters before it; the last leaf for the end of the text."""
        k, before = 1, 0
        offset = min(offset, max(0, self.total[0] - 1))
        while k < self.size:
            k *= 2
            if before + self.nodes[k][0] <= offset:
                before += self.nodes[k][0]
                k += 1
        return k - self.size, before

    def replace(self, first: int, last: int, new: list[tuple[int, int]]) -> None:
        """The leaves in slots first..last (exclusive) become ``new``."""
        self.count += len(new) - len(self.leaves(first, last))
        width, levels = 1, max(1, self.size.bit_length() - 1)
        low, high = first, last
        while True:
            before, after = self.leaves(low, first), self.leaves(last, high)
            room = high - low
            if len(before) + len(new) + len(after) <= room - room * (width.bit_length() - 1) // (8 * levels):
                return self._spread(low, high, before + new + after)
            if width >= self.size:
                return self._build(before + new + after)
            width *= 2
            low, high = first // width * width, -(-last // width) * width


def _edit(text: str, tree: Tree, start: int, end: int, insert: str):
    """A generator that yields the texts to count, is sent their counts, and returns what ``apply_edit`` does."""
    start = max(0, min(start, len(text)))
    end = max(start, min(end, len(text)))
    edited = text[:start] + insert + text[end:]
    if not tree.count:
        pieces = cut(edited)
        counts = yield pieces
        return edited, Tree([(len(x), n) for x, n in zip(pieces, counts)]), len(edited)
    first, before = tree.find(start)
    last, upto = tree.find(max(start, end - 1))
    upto += tree.nodes[tree.size + last][0]
    region = text[before:start] + insert + text[end:upto]
    last += 1
    while last < tree.size and region and region[-1] not in SPACE:  # the next leaf's first word is joined to it
        size = tree.nodes[tree.size + last][0]
        region, upto, last = region + text[upto : upto + size], upto + size, last + 1
    if start == len(text) and start == end and not insert:
        return edited, tree, 0
    pieces = cut(region)
    counts = yield pieces
    tree.replace(first, last, [(len(x), n) for x, n in zip(pieces, counts)])
    return edited, tree, len(region)


def _together(jobs: list, count) -> list:
    """What these generators return. The texts that all of them wait for are counted in one call."""
    found, waiting = [None] * len(jobs), [(k, None) for k in range(len(jobs))]
    while waiting:
        asked = []
        for k, counts in waiting:
            try:
                asked.append((k, jobs[k].send(counts)))
            except StopIteration as done:
                found[k] = done.value
        numbers = iter(count([x for _, texts in asked for x in texts]))
        waiting = [(k, [*islice(numbers, len(texts))]) for k, texts in asked]
    return found


def apply_edit(text: str, tree: Tree, start: int, end: int, insert: str, count) -> tuple[str, Tree, int]:
    """The edited text, its tree, and the characters that were encoded again. ``count`` gives the tokens of texts."""
    return _together([_edit(text, tree, start, end, insert)], count)[0]


def _recounted(key, text: str, stored: dict | None, edits: list):
    """A generator as ``_edit``: the row of ``recount`` of a document with the tree that was stored for it."""
    encoded = 0
    if stored is None:
        pieces = cut(text)
        counts = yield pieces
        tree = Tree([(len(x), n) for x, n in zip(pieces, counts)])
        encoded += len(text)
    else:
        tree = Tree.of([*zip(stored["chars"], stored["tokens"])], stored["n_leaves"])
    before = tree.total[1]
    for edit in edits:
        text, tree, size = yield from _edit(text, tree, edit["start"] or 0, edit["end"] or 0, edit["insert"] or "")
        encoded += size
    return key, before, len(edits), tree.total[1], len(text), encoded


def _counter(vocabulary: str):
    runs = tokens.counter(vocabulary).count_runs
    return lambda texts: [sum(x) for x in runs(texts, LEAF_WORDS)]


def build(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, n_leaves, chars, tokens`` (sums by node, in heap order): the tree of every document, as a table to keep beside the documents.

    ``text_hash`` ties a tree to the text that it was built from. Null and empty texts
    have a tree without leaves. Repeated rows give repeated trees.
    """

    def run(batches):
        runs = tokens.counter(vocabulary).count_runs
        for batch in batches:
            trees = [Tree(x) for x in _leaves([x or "" for x in batch.column(2).to_pylist()], runs)]
            sums = [pa.array([[n[k] for n in t.nodes] for t in trees], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([t.count for t in trees], pa.int32()), *sums], ["doc_id", "text_hash", "n_leaves", "chars", "tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, n_leaves int, chars array<int>, tokens array<int>")


def recount(docs: DataFrame, trees: DataFrame, edits: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_edits, n_tokens_edited, n_chars_edited, n_chars_encoded`` of every document.

    ``edits`` has ``doc_id, seq, start, end, insert``: in the order of ``seq`` (ties by the
    other columns), characters start..end (exclusive) of the text so far are replaced.
    Offsets beyond the text are cut to it, a null offset counts as 0, a null insert as empty. Documents without
    edits keep their count and are not encoded. A document without a tree of its present
    text gets one. Rows that share an id share its edits. Edits of unknown or null ids
    do nothing; a document without an id gets a tree of its own and no edits.
    """

    def run(batches):
        count = _counter(vocabulary)
        for batch in batches:
            jobs = []
            for key, text_hash, text, trees, found in zip(*(batch.column(k).to_pylist() for k in range(5))):
                stored = next((t for t in trees or [] if t["text_hash"] == text_hash), None)
                jobs.append(_recounted(key, text or "", stored, found or []))
            out = _together(jobs, count)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 6, names)

    names = ["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_chars_edited", "n_chars_encoded"]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    edit = F.struct("seq", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "insert")
    stored = trees.select(F.col("doc_id").alias("id"), F.struct("text_hash", "n_leaves", "chars", "tokens").alias("tree"))
    asked = edits.select(F.col("doc_id").cast("long").alias("id"), edit.alias("edit"))
    # Trees and edits meet by document before the texts join, which move once.
    beside = stored.unionByName(asked, allowMissingColumns=True).where("id IS NOT NULL").groupBy("id")
    beside = beside.agg(F.collect_set("tree").alias("trees"), F.sort_array(F.collect_list("edit")).alias("edits"))
    found = rows.join(beside, rows["doc_id"] == beside["id"], "left")
    return found.select("doc_id", "text_hash", "text", "trees", "edits").mapInArrow(run, ", ".join(f"{n} long" for n in names))
