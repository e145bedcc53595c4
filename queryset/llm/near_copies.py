"""Near copies: documents whose word shingle sets have a Jaccard similarity of 0.8 or more.

Candidates come from SimHash fingerprints by multi-index hashing. Texts this similar differ
in about 15 of 100 bits, so a fingerprint has as many bits as its tables need: it is cut
into segments, one by table, and each table is asked for a set's segment and for the
segment with one of its least certain bits flipped (bits whose votes were closest).
Sets of a bucket are held against each other by 128 bits within the task; groups join
through hubs first, and between clusters only sets that share one of their rarest shingles
meet. Candidates are held against 512 bits, and what is left is verified on complete sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queryset.llm.components import connected_components
from queryset.llm.scratch import by_key, free, row_hash, written
from queryset.llm.simhash import NO_ID, SEED, shingle_hashes

#: Tables by width of a segment, for sets of up to 5, 10, 80 and of more shingles (few shingles make bits less certain). A pair takes the tables of its larger set. So many miss a pair at a similarity of exactly 0.8 less often than once in a million, at the worst sizes of the class: simulated odds that a table shows it, less three standard errors, are 0.25, 0.35, 0.46, 0.58 at 12 bits and 0.011, 0.031, 0.042, 0.085 at 26.
SIZES = (5, 10, 80)
TABLES = {12: (48, 32, 23, 16), 14: (74, 49, 34, 23), 16: (125, 70, 49, 31), 18: (195, 104, 74, 43), 20: (292, 153, 104, 59), 22: (432, 223, 154, 81), 24: (751, 305, 225, 112), 26: (1221, 444, 319, 157)}
#: Bits of a segment that are flipped, one at a time, and sets that meet in a value of a segment by chance (at most twice as many, up to 26 bits).
FLIPS, LOAD = 3, 6
#: Two sets of a similarity of 0.8 differ in a bit with a probability of 0.1875 at most (sets of 4 and 5), of 0.1537 where both have SMALL shingles or more (0.152, the angle between the sets over pi, where sets are large). So they differ in more than RADIUS of 128 bits or WIDE_RADIUS of 512 (first of small sets, then of others) less often than once in ten million pairs.
SMALL, RADIUS, WIDE_RADIUS = 64, (49, 43), (144, 124)
#: Tables of one in so many are counted to find sets that are central in their groups, and so many of these are known to the tasks. Results do not depend on either: they only say through which set a group is joined first.
COUNTED, COMMON = 4, 200_000
#: So many rows of an id are broadcast at most (16 MB); more are shuffled.
BROADCAST_ROWS = 2_000_000
#: Buckets of up to so many sets are compared in full, by 128 bits; of larger ones all sets go on.
COMPARED = 64
#: All near pairs of a bucket are judged at once up to so many sets that have one; of more, by hubs first and then between clusters. Results do not depend on it.
DENSE = 2
#: A set that many pairs need is sent to so many tasks at most.
SALTS = 64

#: The finaliser of splitmix64, which makes further hashes of a hash.
STEP, MULTIPLIERS = 0x9E3779B97F4A7C15, ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1))
PRINTS = ("fp", *(f"fp{k}" for k in range(1, 8)))
SKETCH = f"doc_id long, row long, digest long, {', '.join(x + ' long' for x in PRINTS)}, n int, segments array<long>, marks array<int>"
#: A part is a table and the lowest bits of a segment. Flips of the other bits stay in it, so they are not moved. Of a row's code 26 bits are the value, three times 5 the flips (NONE: moved to another part) and the rest the size, up to MOST.
PART_BITS, VALUE_BITS, NONE, MOST = 6, 26, 31, (1 << 22) - 1
SIZE_AT = VALUE_BITS + 5 * FLIPS
PARTED = "part int, code long, digest long, fp long, fp1 long"
BUCKETED = "key long, digest long, fp long, fp1 long, n int, sets long"
#: Rows of a batch that a task returns.
BATCH = 1 << 15


def width_for(rows: int) -> int:
    """Bits of a segment, so that about LOAD of so many sets meet in a value by chance."""
    return next((w for w in TABLES if rows * (1 + FLIPS) <= 2 * LOAD << w), max(TABLES))


def tables_for(n: int, width: int) -> int:
    return TABLES[width][sum(n > size for size in SIZES)]


def _votes(hashes: np.ndarray, count: int) -> np.ndarray:
    """How many of the hashes have each bit set, over ``count`` times 64 bits: those of the hashes and of further hashes of them."""
    steps = np.array([k * STEP % 2**64 for k in range(count)], "u8")
    votes = np.zeros(64 * count, np.int64)
    for at in range(0, len(hashes), 255):  # so that sums fit bytes
        x = hashes[at : at + 255, None] + steps
        for shift, factor in MULTIPLIERS:
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x[:, 0] = hashes[at : at + 255]
        votes += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return votes


def _print(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 512 bits of a SimHash fingerprint, and its segments, each with the places of its least certain bits above it."""
    n = len(hashes)
    tables = tables_for(n, width)
    votes = 2 * _votes(hashes, max(len(PRINTS), -(-tables * width // 64))) - n
    cut = votes[: tables * width].reshape(tables, width)
    doubt = np.argsort(np.abs(cut - (n % 2 == 0)), axis=1, kind="stable")[:, :FLIPS]
    segments = ((cut > 0) << np.arange(width)).sum(axis=1) | (doubt << (32 + 5 * np.arange(FLIPS))).sum(axis=1)
    return np.packbits(votes[: 64 * len(PRINTS)] > 0, bitorder="little").view("<i8"), segments


def _sets(batch_column, shingle_words: int) -> list[np.ndarray]:
    return [np.unique(shingle_hashes(x.as_py(), shingle_words)) for x in batch_column]


def _lists(arrays: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays) if arrays else [], kind))


def sketches(docs: DataFrame, shingle_words: int = 5) -> DataFrame:
    """What the search needs of every row, from one pass over the whole texts.

    ``row`` is a hash of all columns, ``digest`` one of the set of shingles, ``fp`` to ``fp7`` the first
    512 bits of its fingerprint, ``n`` its size, ``segments`` those of the fingerprint (none for sets
    of fewer than four shingles, which are similar to equal sets only) and ``marks`` the sorted
    lower halves of all hashes. A text of fewer words is one shingle; a text without words has
    the empty set.
    """
    width = width_for(docs.count())

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = _sets(part.column(2), shingle_words)
                digests = np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in sets], "u8").view("i8")
                found = [_print(x, width) for x in sets]
                prints = np.array([x for x, _ in found], "i8").reshape(len(sets), len(PRINTS))
                segments = [x if len(s) > 3 else x[:0] for (_, x), s in zip(found, sets)]
                marks = [np.sort(np.unique(x.astype("<u4")).view("<i4")) for x in sets]
                columns = [part.column(0), part.column(1), pa.array(digests), *(pa.array(prints[:, k]) for k in range(len(PRINTS))), pa.array([len(x) for x in sets], pa.int32()), _lists(segments, pa.int64()), _lists(marks, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "digest", *PRINTS, "n", "segments", "marks"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash(docs).alias("row"), "text")
    return rows.mapInArrow(run, SKETCH)


def _radius(na, nb, radius: tuple[int, int]):
    return F.when(F.least(na, nb) < SMALL, radius[0]).otherwise(radius[1])


def _near(a: str, b: str):
    """What sets of a similarity of 0.8 fulfil: sizes within a fifth and 128 bits within the radius."""
    (na, fa, ga), (nb, fb, gb) = ([F.col(x.format(c)) for c in ("n", "fp", "fp1")] for x in (a, b))
    bits = F.bit_count(fa.bitwiseXOR(fb)) + F.bit_count(ga.bitwiseXOR(gb))
    return (5 * F.least(na, nb) >= 4 * F.greatest(na, nb)) & (bits <= _radius(na, nb, RADIUS))


def _checked(frame: DataFrame) -> DataFrame:
    """A written table of one or two ids a row, as a broadcast where it is small enough."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def _marks(sets: DataFrame, ends: DataFrame) -> DataFrame:
    """``digest, marks`` of the sets of a written table."""
    return sets.select("digest", "marks").join(_checked(ends.select("digest")), "digest", "left_semi").groupBy("digest").agg(F.first("marks").alias("marks"))


def _similar(pairs: DataFrame, sets: DataFrame, points: DataFrame) -> DataFrame:
    """Those of the pairs ``a, b`` whose complete sets have a similarity of 0.8 or more.

    Fingerprints of 512 bits say which sets have to be compared at all; only these move.
    Each pair is dealt by one of its sets and a salt, so a set of many pairs is no single task.
    """
    judged = pairs
    for end in "ab":
        # Pairs are exploded rows, which Spark takes for few and would broadcast.
        judged = judged.join(points.select(F.col("digest").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in ("n", *PRINTS))).hint("merge"), end)
    bits = sum(F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in PRINTS)
    judged = judged.where(bits <= _radius("n_a", "n_b", WIDE_RADIUS))
    both = pairs = written(judged.select("a", "b", F.pmod(F.xxhash64("a", "b"), F.lit(SALTS)).alias("salt")), "pairs")
    ends = written(pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct(), "ends")
    some = written(_marks(sets, ends), "compared", compact=True)
    for end in "ab":
        needed = pairs.select(end, "salt").distinct().join(some.select(F.col("digest").alias(end), F.col("marks").alias(f"marks_{end}")), end)
        both = both.join(needed, [end, "salt"])
    return both.where("9 * size(array_intersect(marks_a, marks_b)) >= 4 * (size(marks_a) + size(marks_b))").select("a", "b")


def _parted(points: DataFrame) -> DataFrame:
    """A row for each part that a set stands in by its segments, and by these with one uncertain bit flipped."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                packed = rows.column(4).flatten().to_numpy()
                times = np.diff(rows.column(4).offsets.to_numpy())
                table = np.arange(len(packed)) - np.repeat(np.cumsum(times) - times, times)
                row = np.repeat(np.arange(len(times)), times)
                value, places = packed & 0xFFFFFFFF, [packed >> (32 + 5 * k) & 31 for k in range(FLIPS)]
                code = value + sum(np.where(x < PART_BITS, NONE, x) << (VALUE_BITS + 5 * k) for k, x in enumerate(places))
                found, alone = [(table, row, code)], sum(NONE << (VALUE_BITS + 5 * k) for k in range(FLIPS))
                for x in places:
                    away = x < PART_BITS
                    found.append((table[away], row[away], (value ^ (1 << x))[away] + alone))
                table, row, code = (np.concatenate(x) for x in zip(*found))
                size = np.minimum(rows.column(3).to_numpy(), MOST).astype("i8")[row] << SIZE_AT
                part = (table << PART_BITS | code & ((1 << PART_BITS) - 1)).astype("i4")
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(code + size), *(pa.array(rows.column(k).to_numpy()[row]) for k in range(3))], ["part", "code", "digest", "fp", "fp1"])

    return points.where("n > 3").select("digest", "fp", "fp1", "n", "segments").mapInArrow(run, PARTED)


def _values(part: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys (table and value) of rows of parts, and the row of each."""
    value, found = code & ((1 << VALUE_BITS) - 1), [np.arange(len(code))]
    keys = [part.astype("i8") >> PART_BITS << 32 | value]
    for k in range(FLIPS):
        place = code >> (VALUE_BITS + 5 * k) & 31
        here = np.flatnonzero(place != NONE)
        keys.append(keys[0][here] ^ (1 << place[here]))
        found.append(here)
    return np.concatenate(keys), np.concatenate(found)


def _by_part(points: DataFrame, each, schema: str) -> DataFrame:
    """What ``each`` yields of the rows of whole parts (their columns as arrays)."""

    def run(batches):
        held = []
        for batch in batches:
            part = batch.column(0).to_numpy()
            last = int(np.searchsorted(part, part[-1])) if len(part) else 0
            if len(part) and held and held[-1].column(0)[-1].as_py() != part[-1]:
                held.append(batch.slice(0, last))
                yield from each(*(x.to_numpy() for x in pa.Table.from_batches(held).columns))
                held = [batch.slice(last)]
            elif len(part):
                held.append(batch)
        if held:
            yield from each(*(x.to_numpy() for x in pa.Table.from_batches(held).columns))

    return _parted(points).repartition("part").sortWithinPartitions("part").mapInArrow(run, schema)


def _buckets(points: DataFrame) -> DataFrame:
    """A row for each value that a set stands for in a table; ``sets`` is the size of the value's bucket."""

    def each(part, code, digest, fp, fp1):
        key, row = _values(part, code)
        _, of, sets = np.unique(key, return_inverse=True, return_counts=True)
        yield from _rows(key, [digest[row], fp[row], fp1[row]], code[row], sets[of])

    return _by_part(points, each, BUCKETED)


def _rows(key, columns, code, sets):
    for at in range(0, len(key), BATCH):
        some = slice(at, at + BATCH)
        arrays = [key[some], *(x[some] for x in columns), (code[some] >> SIZE_AT).astype("i4"), sets[some].astype("i8")]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], [x.split()[0] for x in BUCKETED.split(", ")])


def _met(points: DataFrame) -> DataFrame:
    """Sets that are near another one of their bucket; of buckets of DENSE such sets at most ``a, b``, the near pairs.

    ``sets`` says how many are near. A bucket of more than COMPARED sets is not compared: all of its sets go on.
    """
    dense, most = DENSE, max(COMPARED, DENSE)

    def each(part, code, digest, fp, fp1):
        key, row = _values(part, code)
        order = np.argsort(key, kind="stable")
        key, row = key[order], row[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        bucket = np.repeat(np.arange(len(starts)), sizes)
        n, end, large = code >> SIZE_AT, (starts + sizes)[bucket], sizes > most
        one, some, step = [], np.flatnonzero(~large[bucket]), 0
        while len(some):
            step += 1
            some = some[some + step < end[some]]
            i, j = row[some], row[some + step]
            least = np.minimum(n[i], n[j])
            # Of signed numbers numpy counts the bits of the absolute value.
            bits = sum(np.bitwise_count((x[i] ^ x[j]).view("u8")) for x in (fp, fp1))
            near = (5 * least >= 4 * np.maximum(n[i], n[j])) & (bits <= np.where(least < SMALL, *RADIUS))
            one.append((some[near], some[near] + step))
        a, b = (np.concatenate([np.zeros(0, "i8"), *x]).astype("i8") for x in (zip(*one) if one else ([], [])))
        sets = np.bincount(np.concatenate([a, b]), minlength=len(key))
        sets[large[bucket]] = sizes[bucket[large[bucket]]] - 1
        few = ~large & (np.add.reduceat(sets > 0, starts, dtype="i8") <= dense)
        few_pairs = few[bucket[a]]
        x, y = digest[row[a[few_pairs]]], digest[row[b[few_pairs]]]
        pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
        go_on = np.flatnonzero((sets > 0) & ~few[bucket])
        r = row[go_on]
        for batch in _rows(key[go_on], [digest[r], fp[r], fp1[r]], code[r], sets[go_on]):
            nothing = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([nothing, nothing, *batch.columns], ["a", "b", *batch.schema.names])
        for at in range(0, len(pairs), BATCH):
            part_of = pairs[at : at + BATCH]
            nulls = [pa.nulls(len(part_of), pa.int32() if "int" == kind else pa.int64()) for _, kind in (x.split() for x in BUCKETED.split(", "))]
            yield pa.RecordBatch.from_arrays([pa.array(part_of[:, 0].copy()), pa.array(part_of[:, 1].copy()), *nulls], ["a", "b", *(x.split()[0] for x in BUCKETED.split(", "))])

    return _by_part(points, each, f"a long, b long, {BUCKETED}")


def _gathered(rows: DataFrame) -> DataFrame:
    """One row by set, with the ``keys`` of its buckets: what is known of a set joins it once, not once a bucket.

    A set has at most 1 + FLIPS keys a table, however large its group. ``meets`` is the size of its buckets in the counted tables.
    """
    counted = F.pmod(F.shiftright("key", 32), F.lit(COUNTED)) == 0
    return rows.groupBy("digest").agg(*(F.first(c).alias(c) for c in ("n", "fp", "fp1")), F.sum(F.when(counted, F.col("sets"))).alias("meets"), F.collect_list("key").alias("keys"))


def _clustered(held: DataFrame, links: DataFrame) -> DataFrame:
    """``digest, cluster`` of the gathered sets, where one of their buckets has several clusters of the links."""
    by = Window.partitionBy("key")
    label = connected_components(links).select(F.col("node").alias("digest"), "component")
    found = held.select("digest", "keys").join(label, "digest", "left").select("digest", F.coalesce("component", "digest").alias("cluster"), F.explode("keys").alias("key"))
    found = found.withColumn("low", F.min("cluster").over(by)).withColumn("high", F.max("cluster").over(by)).where("low <> high")
    return found.select("digest", "cluster").distinct()


def _hub_pairs(rows: DataFrame) -> DataFrame:
    """Each set with the first set, by place, of its buckets."""
    by, at = Window.partitionBy("key"), F.struct("place", "digest", "n", "fp", "fp1")
    hubs = rows.withColumn("hub", F.min(at).over(by)).where((F.col("digest") != F.col("hub.digest")) & _near("{}", "hub.{}"))
    pairs = hubs.groupBy("digest", F.col("hub.digest").alias("hub")).agg(F.count("*").alias("shared"))
    # The hub that a set has most in common with stands for the others; the complete search finds what it leaves apart.
    best = pairs.groupBy("digest").agg(F.max_by("hub", F.struct("shared", "hub")).alias("hub"))
    return best.select(F.least("digest", "hub").alias("a"), F.greatest("digest", "hub").alias("b")).distinct()


def _with_place(held: DataFrame) -> DataFrame:
    """A row for each bucket of the gathered sets, with ``place``, which is least for sets that meet most others."""
    some = held.where("meets IS NOT NULL").select("digest", (-F.col("meets")).alias("place"))
    known = written(some.orderBy("place", "digest").limit(COMMON), "central")
    placed = held.drop("meets").join(F.broadcast(known), "digest", "left")
    return placed.select("digest", "n", "fp", "fp1", F.coalesce("place", F.lit(0)).alias("place"), F.explode("keys").alias("key"))


def _apart(dense: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of sets of different clusters that may still be similar, by their rarest marks.

    Marks are put in one order, those of fewest sets first. Similar sets have their first common mark
    among the first fifth of either, and what comes after it must be enough for a similarity of 0.8. Many
    sets around one text that are not similar to it differ in more marks than that, which are first
    in the order and rare; so they do not meet.
    """
    known = written(dense, "apart")
    some = _marks(sets, known).join(known, "digest").withColumn("size", F.size("marks"))
    marks = some.select("digest", "cluster", "size", F.explode("marks").alias("mark"))
    often = marks.groupBy("mark").agg(F.count("*").alias("often")).where("often > 1")
    marks = marks.join(often.hint("merge"), "mark").groupBy("digest", "cluster", "size").agg(F.sort_array(F.collect_list(F.struct("often", "mark"))).alias("shared"))
    # Marks of one set only are first and meet nothing; they count for the places of the others.
    alone = F.col("size") - F.size("shared")
    first = F.greatest(F.floor(F.col("size") / 5).cast("int") + 1 - alone, F.lit(0))
    placed = marks.select("digest", "cluster", "size", alone.alias("alone"), F.posexplode(F.slice("shared", F.lit(1), first)).alias("at", "x"))
    placed = placed.select("digest", "cluster", F.col("x.mark").alias("mark"), "size", (F.col("size") - F.col("alone") - F.col("at")).alias("rest"))
    by = Window.partitionBy("mark")
    placed = placed.withColumn("low", F.min("cluster").over(by)).withColumn("high", F.max("cluster").over(by)).where("low <> high").drop("low", "high")
    placed = written(placed, "placed")
    left, right = (placed.select("mark", *(F.col(c).alias(c + x) for c in ("digest", "cluster", "size", "rest"))) for x in "12")
    pairs = left.join(right.hint("merge"), "mark").where("digest1 < digest2 AND cluster1 <> cluster2 AND 9 * least(rest1, rest2) >= 4 * (size1 + size2)")
    return pairs.select(F.col("digest1").alias("a"), F.col("digest2").alias("b")).distinct()


def _links(sets: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs of digests; equal sets are one before any search."""
    met = written(_met(points), "met")
    small, dense = met.where("key IS NULL").select("a", "b").distinct(), met.where("key IS NOT NULL").drop("a", "b")
    if dense.isEmpty():
        return _similar(small, sets, points)
    held = written(_gathered(dense), "held")
    # The central set of a group stands near most others; what it leaves apart is searched in full.
    links = written(_similar(small.union(_hub_pairs(_with_place(held))).distinct(), sets, points), "links")
    return links.union(_similar(_apart(_clustered(held, links), sets), sets, points))


def _placed(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``doc_id, row, label`` of every row; the label (struct of the least id and a digest) is the component's."""
    sets = written(sketches(docs, shingle_words), "sketches", compact=True)
    points = sets.groupBy("digest").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("least"), F.count("*").alias("rows"), *(F.first(c).alias(c) for c in ("n", *PRINTS, "segments")))
    points = written(points.withColumn("node", F.struct("least", "digest")).drop("least"), "points")
    links = _links(sets, points)
    for end in "ab":
        links = links.join(points.select(F.col("digest").alias(end), F.col("node").alias(f"node_{end}")), end)
    label = connected_components(links.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    found = points.join(label, "node", "left").select("digest", "rows", F.coalesce("component", "node").alias("label"))
    return by_key(sets.select("doc_id", "row", "digest"), written(found, "labels"), "digest", "rows").select("doc_id", "row", "label")


def near_copies(docs: DataFrame, shingle_words: int = 5) -> DataFrame:
    """``doc_id, component_id`` of every row; component_id is the least doc_id reachable over links.

    Rows link when the Jaccard similarity of their shingle sets is 0.8 or more. Null and
    empty texts are copies of each other. Repeated rows and repeated ids each keep their
    row. A null doc_id keeps its row and counts for no minimum. Other columns are
    ignored; an empty table gives no rows.

    Equal sets are one before any search. Shingles of many sets join these through hubs
    first, so that the complete search compares different clusters only.
    """
    return _placed(docs, shingle_words).select("doc_id", F.nullif("label.least", F.lit(NO_ID)).alias("component_id"))


def one_of_each(docs: DataFrame, shingle_words: int = 5) -> DataFrame:
    """The documents, one of each component of near copies: the one with the least doc_id.

    Of several rows of the component with that id the one with the least hash of all its
    columns stays, of equal rows one. Rows without an id are all kept. Columns, which may
    be any beside doc_id and text, are those of the input; an empty table gives no rows.
    """
    placed = _placed(docs, shingle_words).where("doc_id IS NOT NULL AND doc_id = label.least")
    rows = placed.groupBy("label", "doc_id", "row").agg(F.count("*").alias("rows"))
    key, row = free(docs, "_key"), free(docs, "_row")
    keep = rows.groupBy("label").agg(F.min_by(F.struct("doc_id", "row", "rows"), "row").alias("k"))
    keep = written(keep.select(F.col("k.doc_id").alias(key), F.col("k.row").alias(row), F.col("k.rows").alias("rows")), "keep")
    marked = docs.withColumn(row, row_hash(docs))

    def kept(which: str) -> DataFrame:
        some = keep.where(which).select(key, F.col(row).alias(f"{row}k")).distinct()
        return marked.join(some, (marked["doc_id"].cast("long") == some[key]) & (marked[row] == some[f"{row}k"]), "left_semi")

    repeated = kept("rows > 1").dropDuplicates(["doc_id", row])
    return kept("rows = 1").unionByName(repeated).drop(row).unionByName(docs.where("doc_id IS NULL"))
