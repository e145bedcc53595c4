"""Token-id output as directly addressable codes (DAC).

An id is cut into chunks of eight bits, lowest first. Level k holds the k-th chunk of
every id that has one, in order; a continuation bitmap by level says which ids go on to
the next level, and a rank directory counts the set bits before each block of the
bitmap. The chunk of an id on the next level is found by its rank, so any token is read
with a few array look-ups and no block is ever decoded.

Files are written by Spark as a table of segments in ascending document order: each row
has one DAC image of about ``segment_tokens`` ids, the ids and lengths of its documents,
and its place (part, segment). Task commits make the write safe against lost or
repeated tasks, on any file system that Spark reaches.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queryset.llm import tokens
from queryset.llm.scratch import new_path

END_ID = 1
CHUNK = 8
RANK_BLOCK = 512
#: Texts that one worker holds as Python objects at a time.
SLICE_ROWS = 500
MAGIC = b"DAC1"


def pack(ids: np.ndarray) -> bytes:
    """The DAC image of unsigned 32-bit ids."""
    rest, levels = ids.astype("<u4"), []
    while len(rest) or not levels:
        more = rest >> CHUNK != 0
        bits = np.packbits(more, bitorder="little")
        blocks = -(-len(more) // RANK_BLOCK)
        counts = np.add.reduceat(more, np.arange(0, len(more), RANK_BLOCK), dtype=np.int64) if len(more) else np.zeros(0, np.int64)
        directory = np.concatenate([[0], np.cumsum(counts)[:-1]])[:blocks] if blocks else np.zeros(0)
        levels.append((len(rest), (rest & 255).astype("u1").tobytes(), bits.tobytes(), directory.astype("<u4").tobytes()))
        rest = rest[more] >> CHUNK
    head = struct.pack("<4sI", MAGIC, len(levels)) + b"".join(struct.pack("<I", n) for n, *_ in levels)
    return head + b"".join(chunks + bits + directory for _, chunks, bits, directory in levels)


class Dac:
    """Reads a DAC image in place."""

    def __init__(self, image: bytes):
        magic, count = struct.unpack_from("<4sI", image)
        if magic != MAGIC:
            raise ValueError("not a DAC image")
        sizes, at = struct.unpack_from(f"<{count}I", image, 8), 8 + 4 * count
        self.levels = []
        for n in sizes:
            n_bits, n_blocks = -(-n // 8), -(-n // RANK_BLOCK)
            chunks = np.frombuffer(image, "u1", n, at)
            bits = np.frombuffer(image, "u1", n_bits, at + n)
            directory = np.frombuffer(image, "<u4", n_blocks, at + n + n_bits)
            self.levels.append((chunks, bits, directory))
            at += n + n_bits + 4 * n_blocks

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        """One token: a chunk and a rank by level."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, directory) in enumerate(self.levels):
            value |= int(chunks[i]) << CHUNK * k
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            first = i // RANK_BLOCK * RANK_BLOCK // 8
            whole = int(np.bitwise_count(bits[first : i >> 3]).sum())
            i = int(directory[i // RANK_BLOCK]) + whole + (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
        return value

    def all(self) -> np.ndarray:
        """Every id, for sequential readers."""
        out = None
        for k in range(len(self.levels) - 1, -1, -1):
            chunks, bits, _ = self.levels[k]
            values = chunks.astype("<u4")
            if out is not None:
                more = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
                values[more] |= out << CHUNK
            out = values
        return out


SEGMENTS = "part int, segment int, doc_ids array<long>, doc_tokens array<long>, n_tokens long, codes binary"


def write_tokens(docs: DataFrame, path: str, vocabulary: str, segment_tokens: int = 1 << 18, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text and write the token table to ``path``.

    Documents are range-partitioned by id and sorted within partitions (ties in the order
    of text; null ids first), so parts and segments ascend with the ids. Null and empty
    texts hold the end id alone; repeated rows are written as often as they come. An
    empty table writes no segment.
    """

    def run(batches):
        encode, part = tokens.encoder(vocabulary).encode_many, TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        segment, ids, lengths, data, size = 0, [], [], [], 0

        def row():
            image = pack(np.frombuffer(b"".join(data), "<u4"))
            return pa.RecordBatch.from_pylist([{"part": part, "segment": segment, "doc_ids": ids, "doc_tokens": lengths, "n_tokens": size, "codes": image}], schema=_arrow)

        for part_of in (batch.slice(at, SLICE_ROWS) for batch in batches for at in range(0, len(batch), SLICE_ROWS)):
            for key, one in zip(part_of.column(0).to_pylist(), encode(part_of.column(1).cast(pa.binary()).to_pylist())):
                one += end
                ids.append(key)
                lengths.append(len(one) // 4)
                data.append(one)
                size += len(one) // 4
                if size >= segment_tokens:
                    yield row()
                    segment, ids, lengths, data, size = segment + 1, [], [], [], 0
        if ids:
            yield row()

    _arrow = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("codes", pa.binary())])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    ordered.mapInArrow(run, SEGMENTS).write.parquet(path)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part, segment, n_tokens, seg_start``: ids before each segment. Only one row a part meets in one task."""
    rows = spark.read.schema(SEGMENTS).parquet(path).select("part", "segment", "n_tokens")
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = F.sum("part_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("within", F.coalesce(within, F.lit(0))).join(parts, "part").select("part", "segment", "n_tokens", (F.col("part_start") + F.col("within")).alias("seg_start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` by document, decoded from the files."""

    def run(batches):
        for batch in batches:
            for part, segment, ids, lengths, codes in zip(*(batch.column(k) for k in range(5))):
                data, lengths = Dac(codes.as_py()).all().astype("<u4").tobytes(), lengths.as_py()
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(lengths)
                columns = [pa.array([part.as_py()] * n, pa.int32()), pa.array([segment.as_py()] * n, pa.int32()), ids.values, pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "segment", "doc_id", "local", "n_tokens", "ids_crc32"])

    rows = spark.read.schema(SEGMENTS).parquet(path).select("part", "segment", "doc_ids", "doc_tokens", "codes")
    found = rows.mapInArrow(run, "part int, segment int, doc_id long, local long, n_tokens long, ids_crc32 long")
    starts = segment_starts(spark, path).select("part", "segment", "seg_start")
    return found.join(starts, ["part", "segment"]).select("doc_id", (F.col("seg_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


#: Positions and segments meet in blocks of so many ids of the corpus, and the positions of a segment are asked for in groups of at most so many.
PLACE_BLOCK, ASKED = 1 << 18, 1 << 12


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """``position, token`` for positions of the whole corpus (column ``position``), by random access.

    Positions meet their segment by the block of ids that both are in, so by equal keys.
    Images of segments that nobody asks for are left behind at the read side of the join;
    no segment is decoded. Repeated positions each give a row; null positions and such
    outside the corpus give none; an empty table of positions gives no rows.
    """
    block = F.lit(PLACE_BLOCK)
    wanted = positions.select(F.col("position").cast("long").alias("position")).where("position >= 0")
    wanted = wanted.withColumn("block", F.floor(F.col("position") / block))
    last = F.floor((F.col("seg_start") + F.col("n_tokens") - 1) / block)
    starts = segment_starts(spark, path).where("n_tokens > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("seg_start") / block), last)))
    placed = wanted.join(starts, "block").where("position >= seg_start AND position < seg_start + n_tokens")
    placed = placed.select("part", "segment", "position", (F.col("position") - F.col("seg_start")).alias("local"))
    # A segment that very many ask for goes to several tasks.
    placed = placed.withColumn("group", F.floor(F.row_number().over(Window.partitionBy("part", "segment").orderBy("position")) / F.lit(ASKED)))
    asked = placed.groupBy("part", "segment", "group").agg(F.collect_list(F.struct("position", "local")).alias("asked"))
    codes = spark.read.schema(SEGMENTS).parquet(path).select("part", "segment", "codes")

    def run(batches):
        for batch in batches:
            for image, asked in zip(batch.column(0), batch.column(1)):
                dac, asked = Dac(image.as_py()), asked.as_py()
                yield pa.RecordBatch.from_pylist([{"position": x["position"], "token": dac[x["local"]]} for x in asked], schema=_arrow)

    _arrow = pa.schema([("position", pa.int64()), ("token", pa.int64())])
    return codes.join(asked, ["part", "segment"]).select("codes", "asked").mapInArrow(run, "position long, token long")


def token_output(docs: DataFrame, vocabulary: str, path: str | None = None) -> DataFrame:
    """Write the documents' tokens and return what the files hold by document."""
    spark = docs.sparkSession
    path = path or new_path(spark, "tokens")
    write_tokens(docs, path, vocabulary)
    return read_documents(spark, path)
