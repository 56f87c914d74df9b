"""SimHash near-duplicates of a stated similarity: op10's trie join with a wide bit budget, then an exact comparison.

Near-copies are texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more. Equal sets are one class,
so copies cost nothing. A class has a fingerprint of 128 bits, in which two sets at 0.8 differ in 15 % of the bits (19 %
for the smallest sets), some up to 32. No block of bits that long agrees for certain, so shards are tables that each
sample some of the 128 bits, as many tables as find a pair at 0.8 with probability 0.99. Shards keep about the same
size however many classes there are: the key grows with their logarithm, and the tables with it. Within a shard the
binary trie self-join of op10 finds the pairs within 32 bits. They make candidate groups, a spanning forest of links each.

A candidate group's shingle sets then meet in one task, once, where the trie join runs over the group and each pair within
the budget that is not joined already is compared exactly (in large groups, if 1024 bits of fingerprint differ in no more
than pairs at 0.8 do). Groups of over CROWD classes are dealt anew into tables of
longer keys first. Groups of near-copies are the connected components of the links that hold.

Defined results: words are compared without regard to ASCII case; a text of at most five words is one shingle; null texts
and texts without words are equal; very long texts are compared whole, bytes that are no UTF-8 as they are; the row with the smallest doc_id of a group is kept,
one without doc_id only if none has one, then that of the smallest text hash; so every group keeps one row, whether ids are
null or repeated, and different texts under one doc_id all stay; repeated rows of the kept text leave one of them, any; an
empty table gives an empty result; other columns stay as they are, and may have any name but ``__key``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_bytes
from .components import components
from .simhash_dedup import _LOWER, Forest, shard_links, trie_join
from .tables import Tables, bits_of, mixed

SHINGLE = 5
#: Least Jaccard similarity of near-copies, as a ratio of integers.
NEAR = (4, 5)
WIDTH = 128
#: Differing bits within which pairs are compared exactly.
BUDGET = 32
#: Share of bits in which two large sets of similarity 0.8 differ: the angle between them over pi.
DIFFER = math.acos(8 / 9) / math.pi
#: A pair at 0.8 meets in a shard within the budget with a probability of 0.99; nearer pairs are found more surely.
TABLES = Tables(WIDTH, DIFFER, 0.99, BUDGET)
#: Classes that a shard holds on average.
SHARD = 256
#: Classes of a candidate group whose shingles meet in one task.
CROWD = 4096
#: Runs of this many classes are compared at once: a budget this wide prunes nothing near the leaves.
LEAF = 128
#: Words of the fingerprint by which pairs of sets of LARGE shingles or more, in groups of as many, are tried before the exact
#: comparison, and their bit budget: three deviations more than two sets at 0.8 differ on average.
FINE, LARGE = 16, 64
FINE_BUDGET = math.ceil(64 * FINE * DIFFER + 3 * math.sqrt(64 * FINE * DIFFER * (1 - DIFFER)))
_FACTORS = np.random.default_rng(11).integers(0, 2**63, FINE, np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = [int(x) | 1 for x in np.random.default_rng(13).integers(0, 2**63, SHINGLE)]


#: Bytes of a text that are hashed at once, up to the next white space.
STRETCH = 1 << 20
_RANDOM = np.random.default_rng(12)
_BYTES = _RANDOM.integers(0, 2**64, 256, np.uint64)
_BASE = np.uint64(_RANDOM.integers(0, 2**63) | 1)
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, _BASE, np.uint64))


_POWERS = _powers(256)


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word: random values of its bytes times the powers of a random odd number, added and mixed."""
    found = []
    at = 0
    while at < len(data):
        end = at + STRETCH
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        part = np.frombuffer(data, np.uint8, min(end, len(data)) - at, at)
        at = end
        inside = ~_SPACE[part]
        first = np.flatnonzero(inside & np.append(True, ~inside[:-1]))
        if not len(first):
            continue
        letters = part[inside]
        starts = np.append(0, np.cumsum(inside))[first]  # of words among the letters
        sizes = np.diff(starts, append=len(letters))
        place = np.arange(len(letters)) - np.repeat(starts, sizes)
        powers = _POWERS if sizes.max() <= len(_POWERS) else _powers(int(sizes.max()))
        found.append(mixed(np.add.reduceat(_BYTES[letters] * powers[place], starts) + sizes.astype(np.uint64)))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingles(text: str | bytes | None) -> np.ndarray:
    """Sorted hashes of the text's distinct five-word shingles, one at least."""
    data = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
    words = word_hashes(data.translate(_LOWER))
    n = max(1, len(words) - SHINGLE + 1)
    total = np.full(n, min(len(words), SHINGLE), np.uint64)
    for i in range(min(SHINGLE, len(words))):
        total += words[i : i + n] * np.uint64(_ODD[i])
    total = np.sort(mixed(total))
    return total[np.append(True, total[1:] != total[:-1])]


def wide_fingerprint(hashes: np.ndarray, words: int = WIDTH // 64) -> np.ndarray:
    """The set's fingerprint, in words of 64 bits: a bit is set where over half of the shingles have it."""
    ones = np.zeros(64 * words, np.int64)
    for at in range(0, len(hashes), 1 << 13):
        part = hashes[at : at + (1 << 13)]
        each = mixed(part[:, None] * _FACTORS[None, :words]).astype("<u8")
        ones += np.unpackbits(each.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")


def _words_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column("f1").to_numpy(), batch.column("f2").to_numpy()], 1)


def candidate_groups(classes: DataFrame) -> DataFrame:
    """(node, component) of the classes (node, f1, f2) that have another one within the budget."""
    key_bits = max(0, round(math.log2(max(1, classes.count()) / SHARD)))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = TABLES.keys(bits_of(_words_of(batch)), key_bits, np.zeros(batch.num_rows, np.uint64))
            rows = np.repeat(np.arange(len(keys)), keys.shape[1])
            columns = [pa.array(keys.reshape(-1)), *[batch.column(c).take(pa.array(rows)) for c in ("node", "f1", "f2")]]
            yield pa.RecordBatch.from_arrays(columns, ["key", "node", "f1", "f2"])

    placed = classes.select("node", "f1", "f2").mapInArrow(dealt, "key long, node long, f1 long, f2 long")
    links = placed.repartition("key").sortWithinPartitions("key").mapInArrow(shard_links(BUDGET, LEAF), "a long, b long")
    return components(links.distinct())


def near(a: set[int], b: set[int]) -> bool:
    """Whether two sets of shingles have the least similarity."""
    if NEAR[1] * min(len(a), len(b)) < NEAR[0] * max(len(a), len(b)):
        return False
    both = len(a & b)
    return NEAR[1] * both >= NEAR[0] * (len(a) + len(b) - both)


def _verified(nodes: list[int], words: list[tuple[int, int]], packed: list[bytes]) -> list[tuple[int, int]]:
    """Links that span the groups of near-copies among some classes."""
    values = np.array(words, np.int64).view(np.uint64).reshape(-1, 2)
    order = np.lexsort((values[:, 1], values[:, 0]))
    own = [np.frombuffer(packed[k], "<u8") for k in order.tolist()]
    sizes = np.array([len(x) for x in own])
    fine = np.stack([wide_fingerprint(x, FINE) for x in own]) if len(own) >= LARGE else None
    forest, sets = Forest(len(nodes)), {}

    def set_of(k: int) -> set[int]:
        if k not in sets:
            sets[k] = set(own[k].tolist())
        return sets[k]

    for i, j in trie_join(values[order], BUDGET, None, LEAF, forest.groups):
        i, j = forest.open(i, j)
        low, high = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
        likely = NEAR[1] * low >= NEAR[0] * high
        distance = np.bitwise_count(values[order[i]] ^ values[order[j]]).sum(axis=1, dtype=np.int64)
        if fine is not None:
            far = np.concatenate([np.bitwise_count(fine[i[at : at + 8192]] ^ fine[j[at : at + 8192]]).sum(axis=1, dtype=np.int64) for at in range(0, len(i) + 1, 8192)])
            likely &= (low < LARGE) | (far <= FINE_BUDGET)
        i, j, distance = i[likely], j[likely], distance[likely]
        for part in np.array_split(np.argsort(distance, kind="stable"), 1 + len(i) // 4096):  # the nearest join first
            forest.join_if(i[part], j[part], lambda x, y: near(set_of(x), set_of(y)))
    return [(nodes[order[a]], nodes[order[b]]) for a, b in forest.links().tolist()]


def _group_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, node, f1, f2, packed) in the order of key to links (a, b), a key at a time."""

    def links(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    held: tuple[list, list, list] = ([], [], [])
    last = None
    for batch in batches:
        for key, node, f1, f2, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != last:
                if len(held[0]) > 1:
                    yield links(_verified(*held))
                held, last = ([], [], []), key
            held[0].append(node)
            held[1].append((f1, f2))
            held[2].append(packed)
    if len(held[0]) > 1:
        yield links(_verified(*held))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, f1, f2, component, n, text) to (key, node, f1, f2, packed), once for a group of at most CROWD, else once a table."""
    for batch in batches:
        names = ("node", "f1", "f2", "component", "n")
        for node, f1, f2, component, n, text in zip(*(batch.column(c).to_pylist() for c in names), text_bytes(batch.column("text")), strict=True):
            # near-copies agree in most bits, so that a bit halves a shard but half the way
            bits = 0 if n <= CROWD else min(40, math.ceil(2 * math.log2(n / CROWD)))
            keys = TABLES.keys(bits_of(np.array([[f1, f2]], np.int64)), bits, np.array([component], np.uint64))[0]
            k = len(keys)
            packed = shingles(text).astype("<u8").tobytes()
            columns = [pa.array(keys), *[pa.array([x] * k, pa.int64()) for x in (node, f1, f2)], pa.array([packed] * k, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "node", "f1", "f2", "packed"])


def near_groups(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component) of the classes (node, id, t, f1, f2) that have near-copies; texts (doc_id, t, text)."""
    groups = candidate_groups(classes)
    sizes = groups.groupBy(F.col("component").alias("__c")).agg(F.count("*").alias("n"))
    members = groups.join(sizes, F.col("component") == F.col("__c")).select(F.col("node").alias("__node"), "component", "n")
    wanted = classes.join(members, F.col("node") == F.col("__node")).select(_row_key(F.col("t"), F.col("id")).alias("__wanted"), "node", "f1", "f2", "component", "n")
    rows = texts.join(wanted, _row_key(F.col("t"), F.col("doc_id")) == F.col("__wanted")).select("node", "f1", "f2", "component", "n", "text")
    # a text under a repeated doc_id comes as often as its rows; equal members are harmless, and go here where they are many
    sets = rows.dropDuplicates(["node"]).mapInArrow(_packed, "key long, node long, f1 long, f2 long, packed binary")
    placed = sets.repartition("key").sortWithinPartitions("key")
    return components(placed.mapInArrow(_group_links, "a long, b long").distinct())


def _row_key(t: Column, id_: Column) -> Column:
    """One key for a text's hash and a doc_id that may be null."""
    return F.unhex(F.md5(F.concat(t, F.coalesce(id_.cast("string"), F.lit("none")).cast("binary"))))


def _text_hash(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs, all columns as they were, with one row of each group of near-copies."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(x) for x in text_bytes(batch.column("text"))]
            words = np.array([wide_fingerprint(s) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
            hashes = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            columns = [batch.column("doc_id"), batch.column("t"), hashes, pa.array(words[:, 0]), pa.array(words[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "t", "h", "f1", "f2"])

    texts = docs.select("doc_id", _text_hash(F.col("text")).alias("t"), "text")
    rows = materialize(texts.mapInArrow(signed, f"doc_id {kind}, t binary, h binary, f1 long, f2 long"), "near-signatures")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("t").alias("t"))).alias("x")
    once = rows.groupBy("h").agg(best, F.first("f1").alias("f1"), F.first("f2").alias("f2"))
    classes = materialize(once.select(F.monotonically_increasing_id().alias("node"), "x", "x.id", "x.t", "f1", "f2"), "near-classes")
    found = near_groups(texts, classes).withColumnRenamed("node", "__node")
    group = classes.join(found, F.col("node") == F.col("__node"), "left")
    kept = group.groupBy(F.coalesce("component", "node").alias("c")).agg(F.min("x").alias("x")).select("x.t", "x.id")
    kept = materialize(kept.select(_row_key(F.col("t"), F.col("id")).alias("__kept")), "near-kept")
    # one shuffle of the texts: the semi-join and the removal of repeated rows deal by the same key
    marked = docs.withColumn("__key", _row_key(_text_hash(F.col("text")), F.col("doc_id")))
    return marked.join(kept, F.col("__key") == F.col("__kept"), "left_semi").dropDuplicates(["__key"]).drop("__key")
