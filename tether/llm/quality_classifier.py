"""Quality classifier: a factorisation machine on hashed words, structure statistics and metadata of the text.

Every feature has a weight and a short vector; a text's score adds the weights and the inner products of all pairs of
vectors, each times the features' values. The sum over pairs is half of (square of the sum less sum of the squares),
so scoring takes time linear in the number of features. It is trained on at most ``sample`` labelled rows outside the
held-out third, chosen by a hash of doc_id; scoring covers every whole text.

Only the text is an input: label, lang, source and doc_id never are. doc_id only decides who is held out.

Defined results: null and empty texts are scored from their (zero) statistics; very long texts are read whole, bytes that are
no UTF-8 as they are; a null doc_id
is not held out and never trains; if a doc_id has several labels the lowest counts, and if it has several texts the one whose
features come first trains; without labels every score is 0.5; a score of 0.5 counts as label 1; repeated rows are scored
alike; an empty table gives an empty result; other columns, whatever their names, are ignored by ``score`` and stay as they
were in ``keep_good``.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_bytes

#: Slots of hashed words; a power of two.
SLOTS = 1 << 14
FACTORS = 6
#: Labelled rows that train the model at most.
SAMPLE = 12_000
_SYMBOLS, _CAPITALS, _DIGITS = b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
#: Bytes that begin no character.
_CONTINUING = bytes(range(0x80, 0xC0))
_MARKS = b".,;:!?\"'()[]{}-_/\\@^~`+="
STATISTICS = (
    "log_words",
    "log_bytes",
    "bytes_a_char",
    "word_length",
    "symbols",
    "capitals",
    "digits",
    "marks",
    "shouts",
    "bars",
    "distinct",
    "distinct_words_root",
    "top_word",
    "repeated_lines",
    "log_words_a_line",
)


def features(text: str | bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots (sorted) and their word counts, and the statistics, of a whole text."""
    data = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
    found = Counter(data.split())
    n = sum(found.values())
    size = len(data) - data.count(b" ") - data.count(b"\n") or 1
    share = lambda chars: (len(data) - len(data.translate(None, chars))) / size
    lines = [x for x in data.split(b"\n") if x.strip()]
    statistics = np.array(
        [
            np.log1p(n),
            np.log1p(len(data)),
            len(data) / max(1, len(data.translate(None, _CONTINUING))),
            size / max(1, n),
            share(_SYMBOLS),
            share(_CAPITALS),
            share(_DIGITS),
            share(_MARKS),
            data.count(b"!") / size,
            data.count(b"|") / size,
            len(found) / max(1, n),
            len(found) / max(1, n) ** 0.75,
            max(found.values(), default=0) / max(1, n),
            1 - len(set(lines)) / max(1, len(lines)),
            np.log1p(n / max(1, len(lines))),
        ],
        np.float32,
    )
    slots = np.fromiter((zlib.crc32(w) & (SLOTS - 1) for w in found), np.int64, len(found))
    slots, where = np.unique(slots, return_inverse=True)
    counts = np.bincount(where, weights=np.fromiter(found.values(), np.float64, len(found)), minlength=len(slots))
    return slots, counts.astype(np.float32), statistics


@dataclass
class Machine:
    """Weights and vectors of SLOTS word slots and then the statistics, which are scaled by centre and spread."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray

    def inputs(self, slots: np.ndarray, counts: np.ndarray, statistics: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and values: word counts at length one, scaled statistics."""
        words = counts / max(1e-9, float(np.sqrt((counts * counts).sum())))
        scaled = np.clip((statistics - self.centre) / self.spread, -6, 6) * 0.5
        return np.concatenate([slots, np.arange(SLOTS, SLOTS + len(scaled))]).astype(np.int32), np.concatenate([words, scaled])

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        """Probability of label 1."""
        scaled = self.vectors[at] * x[:, None]
        total = scaled.sum(axis=0)
        z = self.bias + float(self.weights[at] @ x) + 0.5 * float((total * total).sum() - (scaled * scaled).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 6, step: float = 0.1, decay: float = 1e-4) -> Machine:
    """A machine fitted to rows of features by logistic loss, with AdaGrad over small batches in a fixed order."""
    width = SLOTS + len(STATISTICS)
    rng = np.random.default_rng(7)
    blank = np.zeros(len(STATISTICS), np.float32)
    machine = Machine(0.0, np.zeros(width, np.float32), rng.normal(0, 0.01, (width, FACTORS)).astype(np.float32), blank, blank + 1)
    if not len(rows):
        machine.vectors[:] = 0
        return machine
    statistics = np.stack([r[2] for r in rows])
    machine.centre, machine.spread = statistics.mean(axis=0), statistics.std(axis=0) + 1e-6
    given = [machine.inputs(*r) for r in rows]
    bias_seen, w_seen, v_seen = 1e-6, np.full(width, 1e-6, np.float32), np.full((width, FACTORS), 1e-6, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(given))
        for batch in np.array_split(order, max(1, len(order) // 128)):
            at = np.concatenate([given[i][0] for i in batch])
            x = np.concatenate([given[i][1] for i in batch])
            ends = np.cumsum([len(given[i][0]) for i in batch])
            row = np.repeat(np.arange(len(batch)), np.diff(ends, prepend=0))
            first = np.append(0, ends[:-1])
            v = machine.vectors[at]
            scaled = v * x[:, None]
            total = np.add.reduceat(scaled, first)
            squares = np.add.reduceat((scaled * scaled).sum(axis=1), first)
            z = machine.bias + np.add.reduceat(machine.weights[at] * x, first) + 0.5 * ((total * total).sum(axis=1) - squares)
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]
            e = (error[row] * x / len(batch)).astype(np.float32)
            used, where = np.unique(at, return_inverse=True)
            dw = np.bincount(where, weights=e, minlength=len(used)) + decay * machine.weights[used]
            dv = np.stack([np.bincount(where, weights=e * (total[row, f] - scaled[:, f]), minlength=len(used)) for f in range(FACTORS)], 1)
            dv += decay * machine.vectors[used]
            w_seen[used] += dw * dw
            v_seen[used] += dv * dv
            machine.weights[used] -= (step * dw / np.sqrt(w_seen[used])).astype(np.float32)
            machine.vectors[used] -= (step * 0.5 * dv / np.sqrt(v_seen[used])).astype(np.float32)
            db = float(error.mean())
            bias_seen += db * db
            machine.bias -= step * db / bias_seen**0.5
    return machine


def held_out(doc_id: Column) -> Column:
    """True for the third of documents whose labels never train."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Train on at most sample labelled rows; what reaches the driver is their sparse features, a few kB each."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    one = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = one.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample)  # at most sample small rows

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(x) for x in text_bytes(batch.column("text"))]
            packed = [r[0].astype("<u2").tobytes() + r[1].astype("<f4").tobytes() + r[2].astype("<f4").tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array([len(r[0]) for r in rows], pa.int32()), pa.array(packed, pa.binary())],
                ["doc_id", "quality", "n", "packed"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    known = docs.select("doc_id", "text").join(F.broadcast(chosen.withColumn("quality", F.col("quality").cast("int"))), "doc_id")
    found = known.select("doc_id", "text", "quality").mapInArrow(extract, f"doc_id {kind}, quality int, n int, packed binary")
    rows = found.groupBy("doc_id").agg(F.min(F.struct("quality", "n", "packed")).alias("r")).select("doc_id", "r.*").orderBy("doc_id").toArrow()
    unpacked = []
    for n, packed in zip(rows.column("n").to_pylist(), rows.column("packed"), strict=True):
        data = packed.as_buffer()  # views of what came from Arrow
        unpacked.append((np.frombuffer(data, "<u2", n), np.frombuffer(data, "<f4", n, 2 * n), np.frombuffer(data, "<f4", -1, 6 * n)))
    return train(unpacked, rows.column("quality").to_numpy().astype(np.float32))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            scores = [m.score(*m.inputs(*features(x))) for x in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(apply, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, known: DataFrame | None = None) -> DataFrame:
    """The rows of docs, all columns as they were, whose score is at least 0.5.

    The labelled rows that train are those of ``known``, by default of docs itself. Where docs were filtered before, known
    has to be the table before that, or labels of the filtered kind are missing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs if known is None else known, labels, sample))

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            at = batch.schema.get_field_index("text")
            kept = [m.score(*m.inputs(*features(x))) >= 0.5 for x in text_bytes(batch.column(at))]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(good, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
