"""SimHash near-duplicates with multi-index hashing.

Fingerprints are 64 bits over word shingles. Two fingerprints link when they
differ in at most ``radius`` bits. The fingerprint is cut into segments; by the
pigeonhole principle two linked fingerprints differ in few bits within one
segment at least, so enumerating a small Hamming ball within each segment and
looking the values up in that segment's table finds every link. Complete
distances are verified on what the tables return.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queryset.llm.components import connected_components
from queryset.llm.scratch import by_key, free, row_hash, written

BITS = 64
SEED = 42
#: Clusters of more distinct fingerprints have a table of their own; results do not depend on it.
DENSE = 64
#: Id of rows without one; it counts for no minimum.
NO_ID = (1 << 63) - 1


def shingle_hashes(text: str | None, shingle_words: int) -> np.ndarray:
    """Hashes of all shingles of one text, in order; a text of fewer words is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
    if not words:
        return np.array([], "<u8")
    joined, k = b" ".join(words), min(shingle_words, len(words))
    ends = [x - 1 for x in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(x + 1 for x in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1 :])], dtype="<u8")


def fingerprint_of(text: str | None, shingle_words: int = 4) -> int:
    """Unsigned fingerprint of one text; a text without words has fingerprint zero."""
    return fingerprint_of_hashes(shingle_hashes(text, shingle_words))


def fingerprint_of_hashes(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (signed 64-bit) of every row, whole texts."""

    def run(batches):
        for batch in batches:
            values = [fingerprint_of(x.as_py(), shingle_words) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(values, "u8").view("i8"))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def segments(count: int, radius: int) -> list[tuple[int, int]]:
    """(mask, ball radius) by segment.

    With radius = count * q + rest, linked fingerprints differ in at most q bits in
    one of the first rest + 1 segments or in at most q - 1 in one of the others.
    """
    quotient, rest = divmod(radius, count)
    found, low = [], 0
    for k in range(count):
        width = BITS // count + (k < BITS % count)
        ball = quotient if k <= rest else quotient - 1
        if ball >= 0:
            found.append((((1 << width) - 1) << low, ball))
        low += width
    return found


def _balls(mask: int, ball: int) -> list[int]:
    bits = [1 << b for b in range(BITS) if mask >> b & 1]
    return [sum(c) for size in range(ball + 1) for c in combinations(bits, size)]


def best_segments(n: int, radius: int) -> int:
    """The number of segments with least expected probes plus candidates; every choice finds all links.

    No more segments than the radius, so that one segment at least has a ball to enumerate.
    """
    cost = lambda m: sum(len(_balls(mask, ball)) * (1 + n / 2 ** bin(mask).count("1")) for mask, ball in segments(m, radius))
    return min(range(max(1, radius // 2), max(1, radius) + 1), key=cost)


def _struct_array(rows: list[tuple[int, int, int]]):
    return F.array(*(F.struct(F.lit(t).alias("t"), F.lit(_signed(m)).alias("mask"), F.lit(_signed(x)).alias("flip")) for t, m, x in rows))


def _near(radius: int):
    return F.bit_count(F.col("f1").bitwiseXOR(F.col("f2"))) <= radius


def _star_links(points: DataFrame, radius: int) -> DataFrame:
    """Links between each fingerprint and two hubs of every half-width bucket that it is in.

    A bucket holds fingerprints with equal bits in two of four quarters; its hubs are
    its least and greatest fingerprint. Rows grow with the points, never with the
    square of a bucket, and join dense clusters before the complete search.
    """
    quarter = (1 << 16) - 1
    keys = [(t, quarter << 16 * i | quarter << 16 * j, 0) for t, (i, j) in enumerate(combinations(range(4), 2))]
    rows = points.select(F.col("fp").alias("f1"), F.explode(_struct_array(keys)).alias("k"))
    rows = rows.select("f1", F.col("k.t").alias("t"), F.col("f1").bitwiseAND(F.col("k.mask")).alias("key"))
    hubs = rows.groupBy("t", "key").agg(F.min("f1").alias("low"), F.max("f1").alias("high")).where("low <> high")
    hubs = hubs.select("t", "key", F.explode(F.array("low", "high")).alias("f2"))
    return rows.join(hubs.hint("merge"), ["t", "key"]).where((F.col("f1") != F.col("f2")) & _near(radius)).select(F.col("f1").alias("a"), F.col("f2").alias("b")).distinct()


def _with_dense(points: DataFrame, clusters: DataFrame, dense: int) -> DataFrame:
    """``fp, cluster, group``: the group is the cluster for members of clusters of over ``dense`` fingerprints, else null."""
    found = by_key(points.select("fp", "cluster"), clusters.select("cluster", "points"), "cluster", "points")
    return written(found.select("fp", "cluster", F.when(F.col("points") > dense, F.col("cluster")).alias("group")), "groups")


def _index_links(points: DataFrame, radius: int, count: int) -> DataFrame:
    """Links between clusters (column ``cluster``) that the segment tables show.

    Members of a dense cluster (column ``group``) stand in a table of their own within
    each bucket, which is asked by probes of other clusters only. So the work of a bucket
    never grows with the square of a dense cluster.
    """
    parts = segments(count, radius)
    tables = [(t, mask, 0) for t, (mask, _) in enumerate(parts)]
    probes = [(t, mask, x) for t, (mask, ball) in enumerate(parts) for x in _balls(mask, ball)]

    def keyed(rows, f, c):
        x = points.select(F.col("fp").alias(f), F.col("cluster").alias(c), "group", F.explode(_struct_array(rows)).alias("k"))
        return x.select(f, c, "group", F.col("k.t").alias("t"), F.col(f).bitwiseXOR(F.col("k.flip")).bitwiseAND(F.col("k.mask")).alias("key"))

    table, probe = keyed(tables, "f2", "c2"), keyed(probes, "f1", "c1").drop("group")
    links = _probed(probe, table.where("group IS NULL").drop("group"), ["t", "key"], radius)
    groups = written(table.where("group IS NOT NULL").select("t", "key", "group").distinct(), "dense")  # broadcast by its real size, if at all
    asked = probe.join(groups, ["t", "key"]).where("c1 <> group")
    links = links.union(_probed(asked, table.where("group IS NOT NULL"), ["t", "key", "group"], radius))
    return links.distinct()


def _probed(probe: DataFrame, table: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """Verified links that a table shows, each from the end with the lesser fingerprint.

    Spark takes exploded rows for as few as those they come from, so without the hint it
    broadcasts tables and probes of any size through the driver.
    """
    found = probe.join(table.hint("merge"), keys).where((F.col("f1") < F.col("f2")) & (F.col("c1") != F.col("c2")) & _near(radius))
    return found.select(F.col("c1").alias("a"), F.col("c2").alias("b"))


def near_duplicates(docs: DataFrame, radius: int = 4, shingle_words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` of every row; component_id is the least doc_id reachable over links.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows
    and repeated ids each keep their row. A null doc_id keeps its row and counts for no
    minimum (component_id is null if no other id is in the component). Other columns
    are ignored; an empty table gives no rows.

    Exact copies meet in one distinct fingerprint before any search. Dense clusters are
    joined through hubs, so that the complete multi-index search has to show links
    between different clusters only.
    """
    prints = written(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    points = prints.groupBy("fp").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("least"), F.count("*").alias("rows"))
    points = written(points, "points")
    stars = connected_components(_star_links(points.select("fp"), radius))
    joined = points.join(stars.withColumnRenamed("node", "fp"), "fp", "left").withColumn("cluster", F.coalesce("component", "fp")).drop("component")
    clusters = written(joined.groupBy("cluster").agg(F.count("*").alias("points"), F.min("least").alias("least")), "clusters")
    joined = written(joined, "clustered")
    links = _index_links(_with_dense(joined, clusters, DENSE), radius, best_segments(points.count(), radius))
    merged = connected_components(links).select(F.col("node").alias("cluster"), "component")
    label = clusters.join(merged, "cluster", "left").withColumn("component", F.coalesce("component", "cluster"))
    label = written(label, "labels")
    tops = label.groupBy("component").agg(F.count("*").alias("clusters"), F.min("least").alias("component_id"))
    label = by_key(label.select("cluster", "points", "component"), written(tops, "tops"), "component", "clusters")
    label = written(label.select("cluster", "points", "component_id"), "least")
    placed = by_key(joined.select("fp", "rows", "cluster"), label, "cluster", "points").select("fp", "rows", "component_id")
    found = by_key(prints, written(placed, "placed"), "fp", "rows")
    return found.select("doc_id", "fp", F.nullif("component_id", F.lit(NO_ID)).alias("component_id"))


def hex_fingerprint(column):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def one_of_each(docs: DataFrame, radius: int = 4, shingle_words: int = 4) -> DataFrame:
    """The documents, one of each near-duplicate component: the one with the least doc_id.

    Of repeated rows with that id the one with the least hash of all its columns stays.
    Rows without an id are all kept. Columns are those of the input, which may be any
    beside doc_id and text; an empty table gives no rows.
    """
    found = near_duplicates(docs, radius, shingle_words)
    key, row = free(docs, "_key"), free(docs, "_row")
    keep = found.where("doc_id = component_id").select(F.col("doc_id").alias(key)).distinct()
    kept = docs.join(keep, docs["doc_id"] == keep[key], "left_semi")
    first = kept.withColumn(row, F.row_number().over(Window.partitionBy("doc_id").orderBy(row_hash(docs)))).where(F.col(row) == 1).drop(row)
    return first.unionByName(docs.where("doc_id IS NULL"))
