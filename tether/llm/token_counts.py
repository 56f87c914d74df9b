"""Token counts by a two-tier lookup, without shuffling words.

Tier one is a broadcast table from frequent word to its number of pieces. It is found by heavy hitters: every task
counts the words of its texts and reports those with at least ``share`` of them, so at most 1 / share rows a task are
summed, and the ``table_words`` most frequent are encoded once. Tier two is each worker's bounded cache, where words
that the table misses are encoded when first met; it lives on from task to task. Both only save time: counts are those of the library.

Defined results: a null text counts as empty (0 bytes, 0 tokens); very long texts are counted whole; null doc_ids and
repeated rows are returned as they are; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .tokenize import WHOLE, PieceCounts, encoder

MODEL = "piece_bpe_32k.model"
#: Words a task may hold while it counts; beyond, the rarest go, which can only thin out tier one.
HELD = 500_000


def frequent_words(docs: DataFrame, share: float = 5e-5, table_words: int = 30_000, longest: int = 40) -> list[str]:
    """The most frequent words of all texts, at most table_words of at most longest characters each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        total = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    found = text.replace("\n", " \n").split(" ")
                    total += len(found)
                    seen.update(found)
                if len(seen) > HELD:
                    seen = Counter({w: n for w, n in seen.items() if n > share * total / 2})
        often = [(w, n) for w, n in seen.items() if n >= max(2, share * total) and 0 < len(w) <= longest]
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array([w for w, _ in often], pa.string()), "n": pa.array([n for _, n in often], pa.int64())}
        )

    hitters = docs.select("text").mapInArrow(count, "word string, n long")
    top = hitters.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(table_words)
    return [r.word for r in top.collect()]


def token_counts(docs: DataFrame, path: str, limit: int = 4096, share: float = 5e-5, table_words: int = 30_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row of docs."""
    words = frequent_words(docs, share, table_words)
    lengths = {w: n for w, n in zip(words, PieceCounts(path).encode_words(words), strict=True) if n != WHOLE}
    tier_one = docs.sparkSession.sparkContext.broadcast(lengths)
    number = uuid.uuid4().int

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(PieceCounts, path, number, tier_one.value)
        for batch in batches:
            counts = pa.array(words.each(batch.column("text").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), counts], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sized = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = sized.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
