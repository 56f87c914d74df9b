"""SimHash near-duplicates by a binary trie self-join.

A document's fingerprint has a bit set where over half of its shingles' hashes have it. Fingerprints link at ``most``
or fewer differing bits. Equal fingerprints form a class. For the join, every class goes to most + 1 shards, one for
each of as many bit blocks: two fingerprints within the budget agree on one block at least, so they meet in a shard.
Within a shard the fingerprints form a binary trie; the join starts with the pair (root, root), walks both tries down
together a bit at a time, adds differing bits and drops a pair beyond the budget. Shards with very many classes
are divided once more, in the same lossless way, over the remaining bits.

A shard reports a spanning forest of its links, so its output is no larger than its input however close a group of
fingerprints is, and pairs of subtrees that hang together already are not walked; components are found from these.

Defined results: null texts and texts without words have fingerprint zero and link like any other; very long texts are
hashed whole, in pieces of bounded memory; rows without doc_id link like any other, so they can bridge two groups, but are
no group's smallest id: a group of such rows only has a null component_id; ties of ones and zeros in a bit give zero;
repeated rows are returned as often as they occur; an empty table gives an empty result; other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table
from .components import components

SEED = 42
SHINGLE = 3
MOST = 3
BITS = 64
#: Classes in a shard from which it is divided once more.
SHARD = 2000
#: Node pairs that are walked at once.
FRONTIER = 1 << 18
#: Rows of a matrix of distances.
BLOCK = 512
#: Classes that a task joins at a time, rounded up to whole shards.
CHUNK = 1 << 17
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The text's 64-bit fingerprint."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return 0
    if len(found) <= size:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*[found[i:] for i in range(size)], strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at : at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_ = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(set_.view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as signed 64-bit integer) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py(), size) for x in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(compute, f"doc_id {kind}, fp long")


def blocks(bits: list[int], parts: int) -> list[list[int]]:
    """bits, dealt into ``parts`` runs of about the same length."""
    edges = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def _block_value(fp: str, bits: list[int]) -> str:
    """SQL: the bits (a run) of fp as a number."""
    return f"(shiftrightunsigned({fp}, {bits[0]}) & {(1 << len(bits)) - 1}L)"


def trie_join(
    values: np.ndarray, most: int = MOST, starts: np.ndarray | None = None, leaf: int = 1, groups: Callable[[], np.ndarray] | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions (i < j) in values that differ in at most ``most`` bits.

    values: distinct uint64 in order, or rows of several, the highest word first. They are one trie, or several that begin
    at ``starts`` and are joined each with itself. A node is a run of values with a common prefix. Pairs of nodes are kept
    as arrays of run bounds and walked depth first in pieces of FRONTIER pairs, so memory is bounded whatever the number of
    pairs. Two runs of at most ``leaf`` values are compared at once. ``groups`` gives the group of each position so far: a
    pair of runs that lies in one group is left out.
    """
    n = len(values)
    if n < 2:
        return
    words = [np.ascontiguousarray(w) for w in values.reshape(n, -1).T]
    at = np.zeros(1, np.int64) if starts is None else starts
    ends = np.append(at[1:], n)
    tops = [np.stack([at, ends, at, ends, np.zeros_like(at), np.zeros_like(at)], 1)[ends - at > 1]]
    while tops:
        pairs = tops.pop()
        if len(pairs) > FRONTIER:
            tops += [pairs[FRONTIER:], pairs[:FRONTIER]]
            continue
        if groups is not None and len(pairs):
            group = groups()
            turns = np.append(0, np.cumsum(group[1:] != group[:-1]))
            a, b = pairs[:, 0], pairs[:, 2]
            even = (turns[a] == turns[pairs[:, 1] - 1]) & (turns[b] == turns[pairs[:, 3] - 1])
            pairs = pairs[~(even & (group[a] == group[b]))]
        if not len(pairs):
            continue
        depth = int(pairs[0, 5])
        sizes = pairs[:, 1:4:2] - pairs[:, 0:4:2]
        last = (sizes <= (leaf if depth < len(words) * BITS else n)).all(axis=1)
        yield from _near_pairs(words, pairs[last], most)
        pairs = pairs[~last]
        if not len(pairs):
            continue
        bit = np.uint64(1) << np.uint64(BITS - 1 - depth % BITS)
        a0, a1, b0, b1, d = pairs[:, 0], pairs[:, 1], pairs[:, 2], pairs[:, 3], pairs[:, 4]
        # within a run the bits above are equal, so the run splits where this bit becomes one
        ones = np.concatenate([[0], np.cumsum((words[depth // BITS] & bit) != 0)])
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        same = (a0 == b0) & (a1 == b1)
        left = np.stack([a0, am, b0, bm, d], 1)
        right = np.stack([am, a1, bm, b1, d], 1)
        cross = np.stack([a0, am, bm, b1, d + 1], 1)
        back = np.stack([am, a1, b0, bm, d + 1], 1)[~same]
        down = np.concatenate([left, right, cross, back])
        down = down[(down[:, 0] < down[:, 1]) & (down[:, 2] < down[:, 3]) & (down[:, 4] <= most)]
        if len(down):
            tops.append(np.column_stack([down, np.full(len(down), depth + 1)]))


def _near_pairs(words: list[np.ndarray], runs: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i < j) within the budget of every two runs (start, end, start, end, ...)."""
    single = (runs[:, 1] - runs[:, 0] == 1) & (runs[:, 3] - runs[:, 2] == 1)
    i, j = runs[single, 0], runs[single, 2]
    far = sum(np.bitwise_count(w[i] ^ w[j]).astype(np.uint16) for w in words)
    near = (far <= most) & (i < j)
    if near.any():
        yield i[near], j[near]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for a0, a1, b0, b1 in runs[~single, :4].tolist():
        for a in range(a0, a1, BLOCK):  # a block of the matrix of distances at a time
            end = min(a + BLOCK, a1)
            far = np.bitwise_count(words[0][a:end, None] ^ words[0][None, b0:b1])
            for w in words[1:]:
                far += np.bitwise_count(w[a:end, None] ^ w[None, b0:b1])
            i, j = np.nonzero(far <= most)
            if not len(i):
                continue
            i, j = i + a, j + b0
            if a0 == b0:
                i, j = i[i < j], j[i < j]
            found.append((i, j))
            held += len(i)
            if held > FRONTIER:
                yield tuple(np.concatenate(x) for x in zip(*found, strict=True))
                found, held = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Forest:
    """Union-find over positions; keeps the links that joined two groups."""

    def __init__(self, n: int):
        self.up = np.arange(n)
        self.kept: list[np.ndarray] = []

    def links(self) -> np.ndarray:
        """Rows (a, b): as many as positions less groups."""
        return np.concatenate([np.zeros((0, 2), np.int64), *self.kept])

    def groups(self) -> np.ndarray:
        """The group of every position: its smallest position."""
        while (self.up[self.up] != self.up).any():
            self.up = self.up[self.up]
        return self.up

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return int(i)

    def open(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs whose ends are in different groups."""
        group = self.groups()
        apart = group[i] != group[j]
        return i[apart], j[apart]

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        """Join the groups of pairs: every group goes under one smaller one that it is paired with, until none is apart."""
        i, j = self.open(i, j)
        while len(i):
            a, b = self.up[i], self.up[j]
            high, first = np.unique(np.maximum(a, b), return_index=True)
            self.up[high] = np.minimum(a, b)[first]
            self.kept.append(np.stack([i[first], j[first]], 1))
            i, j = self.open(i, j)

    def join_if(self, i: np.ndarray, j: np.ndarray, test: Callable[[int, int], bool]) -> None:
        """Join the groups of pairs that pass test, in order; those that are joined already need not take it."""
        made = []
        for x, y in zip(*(e.tolist() for e in self.open(i, j)), strict=True):
            a, b = self.top(x), self.top(y)
            if a != b and test(x, y):
                self.up[max(a, b)] = min(a, b)
                made.append((x, y))
        if made:
            self.kept.append(np.array(made))


def _forest_links(keys: np.ndarray, words: np.ndarray, nodes: np.ndarray, most: int, leaf: int) -> np.ndarray:
    """Links between nodes, as rows (a, b), that span the linked nodes of every shard; words: rows of fingerprint words."""
    order = np.lexsort((*words.T[::-1], keys))
    keys, words, nodes = keys[order], words[order], nodes[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    forest = Forest(len(nodes))
    for i, j in trie_join(words, most, starts, leaf, forest.groups):
        forest.join(i, j)
    return nodes[forest.links()]


def shard_links(most: int = MOST, leaf: int = 1) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (key, node, words of the fingerprint) in the order of key to links (a, b), a chunk of whole shards at a time."""

    def links(rows: np.ndarray) -> pa.RecordBatch:
        found = _forest_links(rows[0], np.ascontiguousarray(rows[2:].T).view(np.uint64), rows[1], most, leaf)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0
        for batch in batches:
            held.append(np.stack([c.to_numpy() for c in batch.columns]))
            n += batch.num_rows
            if n >= CHUNK:
                rows = np.concatenate(held, axis=1)
                cut = int(np.searchsorted(rows[0], rows[0, -1]))  # the last shard may go on
                if cut:
                    yield links(np.ascontiguousarray(rows[:, :cut]))
                held, n = [rows[:, cut:]], 0
        if held and held[0].shape[1] + n:
            yield links(np.concatenate(held, axis=1))

    return join


def near_links(classes: DataFrame, shard: int = SHARD) -> DataFrame:
    """Links (a, b) between the distinct fingerprints fp of classes that span every group of linked ones."""
    parts = MOST + 1
    whole = list(range(BITS))
    keys = [F.struct(F.lit(k).alias("k"), F.expr(_block_value("fp", bits)).alias("v")) for k, bits in enumerate(blocks(whole, parts))]
    dealt = classes.select("fp", F.explode(F.array(*keys)).alias("x")).select("fp", "x.k", "x.v")
    # at most (MOST + 1) * 2 ** 16 keys, whatever the number of documents
    crowded = dealt.groupBy("k", "v").agg(F.count("*").alias("n")).where(F.col("n") > shard).select("k", "v", F.lit(True).alias("crowded"))
    dealt = dealt.join(F.broadcast(crowded), ["k", "v"], "left")
    again = []
    for k, bits in enumerate(blocks(whole, parts)):
        rest = [x for x in whole if x not in bits]
        # the remaining bits are two runs at most; number them in one word by closing the gap
        closed = f"((fp & {(1 << bits[0]) - 1}L) | shiftleft(shiftrightunsigned(fp, {bits[-1]} + 1), {bits[0]}))" if bits[-1] < BITS - 1 else f"(fp & {(1 << bits[0]) - 1}L)"
        sub = [F.struct(F.lit(i).alias("k2"), F.expr(_block_value(closed, b)).alias("v2")) for i, b in enumerate(blocks(list(range(len(rest))), parts))]
        again.append(F.when((F.col("k") == k) & F.col("crowded"), F.array(*sub)))
    once = F.array(F.struct(F.lit(-1).alias("k2"), F.lit(0).cast("long").alias("v2")))
    placed = dealt.select("fp", "k", "v", F.explode(F.coalesce(*again, once)).alias("y"))
    key = F.expr("shiftleft(k * 8L + y.k2 + 1, 40) | shiftleft(v, 20) | y.v2")
    return (
        placed.select(key.alias("key"), F.col("fp").alias("node"), "fp")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(shard_links(), "a long, b long")
        .distinct()
    )


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row of docs."""
    printed = materialize(fingerprints(docs), "fingerprints")
    classes = materialize(printed.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-classes")
    found = components(near_links(classes.select("fp"))).withColumnRenamed("component", "__group")
    grouped = materialize(
        classes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "rep", F.coalesce("__group", "fp").alias("__group")), "fingerprint-groups"
    )
    # min skips nulls: a group's id is null only where none of its rows has one
    least = grouped.groupBy(F.col("__group").alias("__g")).agg(F.min("rep").alias("component_id"))
    named = grouped.join(least, F.col("__group") == F.col("__g")).select(F.col("fp").alias("__fp"), "component_id")
    named = materialize(named, "fingerprint-components")
    return printed.join(named, F.col("fp") == F.col("__fp")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"))
