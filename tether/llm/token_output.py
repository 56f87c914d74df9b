"""Token ids as fixed-width bit-packed blocks.

Every id takes the fewest bits that hold the vocabulary. Documents go in ascending doc_id order (nulls first) into
blocks of whole documents; a block is a Parquet row with its packed ids, the documents' lengths and its place in the
part, so Spark's committed writes, any file system and column pruning come for free. ``parts`` gives each part's place
in the whole. A document is found by its block and offset, and numpy unpacks a block at once.

Defined results: a null text counts as empty and holds only the end id; very long texts are encoded whole, and a block ends
after them; rows with equal doc_id are ordered by a hash of their texts; repeated rows are written as often as they occur; an
empty table gives files without rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import scratch, table
from .tokenize import BareBpe, encoder

MODEL = "word_bpe_49k.json"
END = 2
BLOCK_IDS = 1 << 18
#: Input bytes a task sorts and encodes at most, about.
PART_BYTES = 256 << 20


def id_bits(vocabulary: int) -> int:
    """The fewest bits that hold the ids from 0 to vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids (unsigned) at ``bits`` bits each, lowest bit first."""
    if bits in (8, 16, 32):  # the same layout, without a detour over single bits
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=bits, bitorder="little")
    return np.packbits(spread.reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids number start to stop of a block, read from the bytes that hold them only."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", stop - start, start * bits // 8).astype("<u4")
    first, last = start * bits // 8, -(-stop * bits // 8)
    flat = np.unpackbits(np.frombuffer(data, np.uint8, last - first, first), bitorder="little")
    at = start * bits - first * 8
    spread = flat[at : at + (stop - start) * bits].reshape(-1, bits)
    wide = np.zeros((stop - start, 32), np.uint8)
    wide[:, :bits] = spread
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)


def input_bytes(docs: DataFrame) -> int:
    """Size of docs as the optimiser estimates it (of files: their length); 0 where it has no idea."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


BLOCKS = "part int, block long, start_in_part long, n_ids long, bits int, doc_ids array<{kind}>, lengths array<long>, packed binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = END, block_ids: int = BLOCK_IDS) -> None:
    """Encode docs (doc_id, text) with a tokenizers file and write their blocks to path."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(input_bytes(docs) / PART_BYTES))
    order = [F.col("doc_id").asc_nulls_first(), F.col("__h"), F.col("__i")]
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("__h"), F.monotonically_increasing_id().alias("__i"))
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    tail = np.array([end], "<u4").tobytes()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(BareBpe, tokenizer)
        bits = id_bits(words.library.get_vocab_size())
        part, block, start = TaskContext.get().partitionId(), 0, 0
        doc_ids, held, total = [], [], 0

        def row() -> pa.RecordBatch:
            packed = pack(np.frombuffer(b"".join(held), "<u4"), bits)
            values = [part, block, start, total, bits, doc_ids, [len(x) // 4 for x in held], packed]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        schema = None
        for batch in batches:
            schema = schema or pa.schema(
                [
                    ("part", pa.int32()),
                    ("block", pa.int64()),
                    ("start_in_part", pa.int64()),
                    ("n_ids", pa.int64()),
                    ("bits", pa.int32()),
                    ("doc_ids", pa.list_(batch.schema.field("doc_id").type)),
                    ("lengths", pa.list_(pa.int64())),
                    ("packed", pa.binary()),
                ]
            )
            texts = batch.column("text").to_pylist()
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.each(texts), strict=True):
                doc_ids.append(doc_id)
                held.append(ids + tail)
                total += len(ids) // 4 + 1
                if total >= block_ids:
                    yield row()
                    block, start = block + 1, start + total
                    doc_ids, held, total = [], [], 0
        if held:
            yield row()

    ordered.mapInArrow(blocks, BLOCKS.format(kind=kind)).write.parquet(path)


def with_starts(blocks: DataFrame) -> DataFrame:
    """blocks with start, the ids of all blocks before. Parts are as many as write tasks, a few bytes each."""
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = (
        blocks.groupBy("part")
        .agg(F.sum("n_ids").alias("n"))
        .select(F.col("part").alias("__part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    )
    return blocks.join(F.broadcast(parts), F.col("part") == F.col("__part")).withColumn("start", F.col("__before") + F.col("start_in_part")).drop("__part", "__before")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    blocks = with_starts(spark.read.parquet(path)).select("start", "bits", "n_ids", "doc_ids", "lengths", "packed")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, bits, n_ids = (batch.column(k)[i].as_py() for k in range(3))
                doc_ids, lengths = batch.column("doc_ids")[i].values, batch.column("lengths")[i].values.to_numpy()
                ids = unpack(batch.column("packed")[i].as_buffer(), bits, 0, n_ids)
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(start + ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return blocks.mapInArrow(documents, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def fetch(spark: SparkSession, path: str, start: int, n: int) -> np.ndarray:
    """Ids number start to start + n of the whole: only the blocks that hold them are read, only those ids unpacked."""
    blocks = with_starts(spark.read.parquet(path))
    rows = blocks.where((F.col("start") < start + n) & (F.col("start") + F.col("n_ids") > start)).select("start", "n_ids", "bits", "packed")
    found = sorted(rows.collect(), key=lambda r: r.start)
    parts = [unpack(bytes(r.packed), r.bits, max(0, start - r.start), min(r.n_ids, start + n - r.start)) for r in found]
    return np.concatenate(parts) if parts else np.zeros(0, "<u4")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-blocks")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(MODEL))
    return read_documents(spark, path)
