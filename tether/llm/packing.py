"""Best-fit packing by minimum bin slack.

Only the number of pieces of each length decides how full sequences can be, and there are at most ``capacity``
lengths, so the plan is made on a histogram of bounded size, whatever the number of documents. For each sequence the
longest piece left is set, and a subset-sum dynamic programme over bitsets, with every length as often as it is left,
finds the fullest combination beside it; the combination is used as often as its pieces suffice and removed. Pieces
then take their places by their rank among those of their length, counted in short windows.

Defined results: a null text counts as empty (only the end id, length 1); very long texts are cut into pieces, all of which are
packed; bytes that are no UTF-8 count as replacement characters; null doc_ids and repeated rows are packed like others; pieces of one length are interchangeable; an empty table gives
an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import materialize, table, texts
from .tokenize import SpacedBpe, encoder

MODEL = "byte_bpe_50k.json"
CAPACITY = 2048
END = 0
#: Pieces of a length that are ranked in one window, about; a length with more has several blocks, by hash.
BLOCK = 20_000


def cut(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of a document's pieces: full ones, after a first that takes the rest."""
    return [n % capacity] * (n % capacity > 0) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    tail = np.array([end], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(SpacedBpe, tokenizer)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(words.each(texts(batch.column("text")))):
                ids, at = memoryview(ids + tail), 0
                for k, n in enumerate(cut(len(ids) // 4, capacity)):
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(ids[at * 4 : (at + n) * 4]))
                    at += n
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def fullest(left: dict[int, int], room: int) -> dict[int, int]:
    """Of the lengths in left (length to count), the combination with the largest sum up to room; longer ones preferred.

    Bit s of a bitset is set if sum s can be reached. Counts are split into powers of two, one shift each.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for n in sorted((x for x in left if x <= room), reverse=True):
        count, times = min(left[n], room // n), 1
        while count:
            times = min(times, count)
            steps.append((n, times, reach))
            reach |= (reach << (n * times)) & mask
            count -= times
            times *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used: dict[int, int] = {}
    for n, times, before in reversed(steps):
        if not before >> total & 1:
            used[n] = used.get(n, 0) + times
            total -= n * times
    return used


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Combinations (length to count) and how many sequences hold each; together they use up counts."""
    left = {n: c for n, c in counts.items() if c}
    made = []
    while left:
        longest = max(left)
        left[longest] -= 1
        beside = fullest({n: c for n, c in left.items() if c}, capacity - longest)
        left[longest] += 1
        combination = {longest: 1}
        for n, c in beside.items():
            combination[n] = combination.get(n, 0) + c
        times = min(left[n] // c for n, c in combination.items())
        made.append((combination, times))
        for n, c in combination.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
    return made


class Places:
    """Where the pieces of a plan go: arrays of runs, sorted by length and by first rank among its pieces."""

    def __init__(self, made: list[tuple[dict[int, int], int]]):
        runs, used, sequence = [], {}, 0
        for combination, times in made:
            offset = 0
            for n, c in sorted(combination.items(), reverse=True):
                runs.append((n, used.get(n, 0), c, sequence, offset))
                used[n] = used.get(n, 0) + c * times
                offset += n * c
            sequence += times
        runs.sort()
        self.sequences = sequence
        self.length, self.rank, self.each, self.first, self.offset = np.array(runs, np.int64).reshape(-1, 5).T.copy()
        self.key = (self.length << 44) + self.rank

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """sequence_id and offset of pieces, by length and rank."""
        run = np.searchsorted(self.key, (length << 44) + rank, side="right") - 1
        beyond = rank - self.rank[run]
        return self.first[run] + beyond // self.each[run], self.offset[run] + beyond % self.each[run] * length


def place(cuts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """cuts (doc_id, piece, start, length, ...) with sequence_id and offset. cuts is read more than once."""
    lengths = {r.length: r.n for r in cuts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    blocks = {n: -(-c // BLOCK) for n, c in lengths.items() if c > BLOCK} or {0: 1}
    most = F.coalesce(F.create_map(*[F.lit(x) for kv in blocks.items() for x in kv])[F.col("length").cast("int")], F.lit(1))
    order = ["doc_id", "start", *[c for c in ("piece", "ids_crc32") if c in cuts.columns]]
    blocked = cuts.withColumn("__block", F.pmod(F.xxhash64(*order), most).cast("int"))
    counted = materialize(blocked.groupBy("length", "__block").agg(F.count("*").alias("n")), "packing-counts")
    places = cuts.sparkSession.sparkContext.broadcast(Places(plan(lengths, capacity)))
    before = W.partitionBy("length").orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    starts = counted.select(
        F.col("length").alias("__l"), F.col("__block").alias("__b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")
    )
    rank = F.row_number().over(W.partitionBy("length", "__block").orderBy(*order)) - 1
    ranked = (
        blocked.withColumn("__rank", rank)
        .join(starts, (F.col("length") == F.col("__l")) & (F.col("__block") == F.col("__b")))
        .withColumn("__rank", F.col("__rank") + F.col("__before"))
        .select(*cuts.columns, "__rank")
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.value.find(batch.column("length").to_numpy(), batch.column("__rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cuts.schema)
    return ranked.mapInArrow(assign, f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of docs (doc_id, text)."""
    return place(materialize(pieces(docs, tokenizer, capacity, end), "packing-pieces"), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
