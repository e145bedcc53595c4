"""Substring dedup: words under a window of words that also starts earlier are removed.

1. Every document is compressed by rounds of consistent naming of word runs and pairs
   (``recompression``). Each window is owned by one high-level symbol that it holds; equal
   windows are owned by equal symbols. Windows whose symbol occurs once in the corpus are
   unique, which settles most of a corpus with a row for each symbol, not for each word.
2. Symbols that are shared reveal candidates. Their documents are read again and each
   candidate window is verified by a hash of all its words within the symbol's group.
3. All but the first window of equal ones are marked, and the words below them removed.

Equal blocks and windows within one batch are settled before any shuffle, and of equal
names one by batch is shuffled by name, so a passage that very many documents share
reaches a task once by batch.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queryset.llm import recompression

WORD = r"[^\x20\x09-\x0D]+"
#: A block of windows in one long: start * PACK + number; a symbol owns at most ``size`` neighbouring windows.
PACK_BITS = 12
PACK = 1 << PACK_BITS
#: Words that one worker compresses at a time; a longer document is taken alone.
CHUNK_WORDS = 1 << 18
U = np.uint64


def _batch(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a batch, one after the other, and the number of words by row."""
    lists = batch.column(column)
    ends = lists.offsets.to_numpy()
    words = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]] if len(ends) > 1 else np.zeros(0, np.int64)
    return words.view(U), np.diff(ends)


def _chunks(counts: np.ndarray):
    """Ranges of rows of about CHUNK_WORDS words."""
    group = (np.cumsum(counts) - counts) // CHUNK_WORDS
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(counts)]
    return zip(edges[:-1], edges[1:])


def window_hashes(words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` words from each place on."""
    mixed, out = recompression.mix(words, 3), np.zeros(len(at), U)
    for k in range(size):
        out = out * recompression.MIX_B + mixed[at + k]
    return recompression.mix(out, 5)


def _blocks(words: np.ndarray, counts: np.ndarray, size: int, rounds: int):
    """(row, start in the row, windows, name) of maximal runs of windows with one owner, and the place of each block's first window."""
    doc = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    names, place = recompression.owners(recompression.levels(words, doc, rounds), np.repeat(ends, counts), size)
    fresh = np.ones(len(words), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (names[1:] != names[:-1])
    heads = np.flatnonzero(fresh)
    long = np.diff(np.append(heads, len(words)))
    keep = place[heads] >= 0
    heads, long = heads[keep], long[keep]
    rows = doc[heads]
    return rows, heads - (ends - counts)[rows], long, names[heads], heads


def _contents(words, heads, long, names, size) -> np.ndarray:
    """A hash of all words under each block and of its number of windows."""
    content = names ^ recompression.mix(long.astype(U), 7)
    mixed, reach = recompression.mix(words, 9), long + size - 1
    for k in range(int(reach.max(initial=0))):
        here = np.flatnonzero(k < reach)
        content[here] = content[here] * recompression.MIX_A + mixed[heads[here] + k]
    return recompression.mix(content, 11)


def _later_places(content, ids, starts) -> np.ndarray:
    """Entries of a batch whose content stands at an earlier place of the batch as well."""
    order = np.lexsort((starts, ids, content))
    same = np.zeros(len(order), bool)
    same[1:] = content[order][1:] == content[order][:-1]
    # Equal places (repeated rows of one document) are not earlier than each other.
    first = np.maximum.accumulate(np.where(~same, np.arange(len(order)), 0))
    later = (ids[order] != ids[order][first]) | (starts[order] != starts[order][first])
    out = np.zeros(len(order), bool)
    out[order] = same & later
    return out


def _spread(ids, starts) -> np.ndarray:
    """Values that deal rows out evenly."""
    return recompression.mix(ids.view(U) ^ starts.astype(U), 13)


def _anchors(rows: DataFrame, size: int, rounds: int) -> DataFrame:
    """``meet, name, id, tag, span, settled, shared``: the blocks of every document.

    Settled ones repeat an earlier block of their batch. Shared ones have a name that
    another place of their batch has. Of those one by batch goes where its name leads
    (``meet``), to tell the others; the rest is dealt out evenly.
    """

    def run(batches):
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            words, counts = _batch(batch, 2)
            parts, before = [], 0
            for a, b in _chunks(counts):
                n = int(counts[a:b].sum())
                if n:
                    part = words[before : before + n]
                    row, start, long, names, heads = _blocks(part, counts[a:b], size, rounds)
                    parts.append((row + a, start, long, names, _contents(part, heads, long, names, size)))
                before += n
            if not parts:
                continue
            row, start, long, names, content = map(np.concatenate, zip(*parts))
            settled = _later_places(content, ids[row], start)
            _, at, group, n = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
            shared = n[group] > 1
            stays = np.zeros(len(names), bool)
            stays[at] = True
            meet = np.where(stays, names, _spread(ids[row], start))
            columns = [meet.view(np.int64), names.view(np.int64), ids[row], tags[row], start * PACK + long, settled, shared]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["meet", "name", "id", "tag", "span", "settled", "shared"])

    return rows.select("id", "tag", "hashes").mapInArrow(run, "meet long, name long, id long, tag long, span long, settled boolean, shared boolean")


def _windows(rows: DataFrame, size: int) -> DataFrame:
    """``name, id, tag, span, hashes`` of the blocks asked for (column ``spans``).

    Windows that stand at an earlier place of the batch are settled here: they, and
    settled blocks, come as spans without hashes, dealt out evenly. The others come with
    a hash each, 0 in the place of a settled one.
    """

    def run(batches):
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            words, counts = _batch(batch, 2)
            ends = np.concatenate([[0], np.cumsum(counts)])
            offsets = batch.column(3).offsets.to_numpy()
            spans = batch.column(3).values
            for a, b in _chunks(counts):
                part = spans.slice(offsets[a], offsets[b] - offsets[a])
                row = np.repeat(np.arange(a, b), np.diff(offsets[a : b + 1]))
                name, span, settled = (part.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                yield _settle(words[ends[a] : ends[b]], ends[row] - ends[a], ids[row], tags[row], name, span, settled, size)

    return rows.select("id", "tag", "hashes", "spans").mapInArrow(run, "name long, id long, tag long, span long, hashes array<long>")


def _settle(words, base, ids, tags, name, span, settled, size) -> pa.RecordBatch:
    start, long = span // PACK, np.where(settled, 0, span % PACK)
    upto = np.cumsum(long)
    block = np.repeat(np.arange(len(span)), long)
    place = np.repeat(start - (upto - long), long) + np.arange(len(block))  # in the document
    hashes = window_hashes(words, base[block] + place, size)
    hashes[hashes == 0] = U(1)
    later = _later_places(hashes ^ recompression.mix(name.view(U)[block], 15), ids[block], place)
    gone = np.flatnonzero(later)
    hashes[gone] = 0
    lists = pa.ListArray.from_arrays(np.concatenate([[0], upto]).astype(np.int32), pa.array(hashes.view(np.int64)))
    open_ = np.flatnonzero(~settled)
    done = np.flatnonzero(settled)
    # Rows: open blocks with hashes, settled blocks, runs of settled windows of a block.
    heads = np.flatnonzero(np.diff(gone, prepend=-2) != 1) if len(gone) else gone
    heads = np.union1d(heads, np.flatnonzero(np.diff(block[gone]) != 0) + 1).astype(np.int64)
    runs, long_runs = gone[heads], np.diff(np.append(heads, len(gone)))
    none = pa.nulls(len(done) + len(runs), pa.list_(pa.int64()))
    rows = np.concatenate([done, block[runs]])
    spans = np.concatenate([span[done], place[runs] * PACK + long_runs])
    names = np.concatenate([name[open_], _spread(ids[rows], spans).view(np.int64)])
    where = np.concatenate([open_, rows])
    columns = [pa.array(names), pa.array(ids[where]), pa.array(tags[where]), pa.array(np.concatenate([span[open_], spans])), pa.concat_arrays([lists.take(pa.array(open_)), none])]
    return pa.RecordBatch.from_arrays(columns, ["name", "id", "tag", "span", "hashes"])


def _removals(docs: DataFrame, by: list[str], size: int, rounds: int) -> DataFrame:
    """``spans`` by document (columns ``by``): packed blocks of windows that also start earlier, by document."""
    hashes = F.transform(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))
    anchors = _anchors(docs.select("id", "tag", hashes.alias("hashes")), size, rounds)
    found = anchors.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("meet"))).where("settled OR shared OR n > 1")
    asked = found.groupBy(*by).agg(F.collect_list(F.struct("name", "span", "settled")).alias("spans"))
    again = docs.join(asked, by).select("id", "tag", hashes.alias("hashes"), "spans")
    blocks = _windows(again, size).repartition("name")
    windows = blocks.select("name", "id", "tag", "span", F.posexplode_outer("hashes").alias("at", "hash"))
    start = F.shiftright("span", PACK_BITS) + F.coalesce("at", F.lit(0))
    windows = windows.where("hash IS NULL OR hash <> 0").withColumn("start", start)
    # Equal places of repeated rows are one place: a window is removed if a lesser place has it. Settled blocks have no hash.
    earlier = F.dense_rank().over(Window.partitionBy("hash", "name").orderBy("id", "start")) > 1
    repeated = windows.withColumn("repeat", F.col("hash").isNull() | earlier).where("repeat")
    span = F.when(F.col("hash").isNull(), F.col("span")).otherwise(F.col("start") * PACK + 1)
    return repeated.groupBy(*by).agg(F.collect_list(span).alias("spans"))


def removed_words(n: int, spans: np.ndarray, size: int) -> np.ndarray:
    """Which of n words lie under the windows of packed blocks."""
    marks = np.zeros(n + 1, np.int64)
    start, long = spans // PACK, spans % PACK
    np.add.at(marks, start, 1)
    np.add.at(marks, start + long + size - 1, -1)
    return np.cumsum(marks)[:n] > 0


def deduplicated(docs: DataFrame, size: int = 20, with_text: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text`` of every row.

    A word is removed if a window of ``size`` words over it equals a window that starts
    at an earlier place: of a lesser doc_id, or earlier in the same document. Windows are
    judged on the input. Kept words are joined by single spaces.

    Null, empty and short texts lose nothing. Rows of one doc_id count as one document: a
    window is earlier than another only if its (doc_id, start) is less, so exact repeats
    of a row keep what one of them would keep. A null doc_id comes after all others. Other
    columns are ignored; an empty table gives no rows.
    """
    if not 1 <= size < PACK:
        raise ValueError(f"windows have 1 to {PACK - 1} words")
    rounds = max(1, int(np.log2(size)))
    last = F.lit((1 << 63) - 1)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), last).alias("id"), F.col(text_col).alias("text"))
    counts = rows.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")).first()
    # Rows that share an id are told apart by their text; else the id alone is the key, so that each table moves once for grouping and join.
    unique = counts["n"] == counts["ids"]
    rows = rows.select("id", (F.lit(0).cast("long") if unique else F.xxhash64("text")).alias("tag"), "text")
    by = ["id"] if unique else ["id", "tag"]
    removals = _removals(rows, by, size, rounds)
    joined = rows.join(removals, by, "left").select("id", "text", "spans")

    def run(batches):
        for batch in batches:
            out = []
            for key, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                n, kept = len(words), words
                if spans.is_valid:
                    gone = removed_words(n, spans.values.to_numpy(), size)
                    kept = [w for w, x in zip(words, gone.tolist()) if not x]
                joined = b" ".join(kept)
                out.append((key, n, n - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode("utf-8", "replace") if with_text else None))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    found = joined.mapInArrow(run, "id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return found.select(F.nullif("id", last).alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept_text")
