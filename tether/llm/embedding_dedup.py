"""Embedding near-duplicates by collision-counting projections.

Vectors of one label are compared; equal vectors form a class, which counts as often as it has members. Every class is
projected on random lines. Its side of WIDTH of them (the sign) deals it into cells: tables that sample as many signs as
leave about CELL classes to share a key, and as many tables as find a pair at the threshold. The places on LINES further
lines travel with it as 4-bit levels. Within a cell the first line is sorted, each class is the centre of a window of REACH levels on it,
and for the pairs in the windows the collisions on all lines are counted; what reaches the calibrated count is a candidate.
Candidates make groups, a spanning forest of links each, however many pairs a close group has.

A group's vectors then meet in one task, once, where the windows are counted again and each pair that reaches the count is
verified by its cosine in double precision; groups of over CROWD classes are dealt into cells of their own first, and a
pair counts in the first table in which it meets. A task reports the number of links of each class and a spanning forest.

A pair just at the threshold is found with probability 0.998 or more, nearer ones more surely: lines are random, and 0.999 is
for the tables, 0.999 for the count, and the windows of REACH levels miss some 0.00003. The work grows a little faster
than the number of classes, as the tables grow with the logarithm of the label's size; a hot label only has longer keys.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite component, and those without a
label, link with nothing and are their own component; vectors of different lengths never link; vectors without vec_id link
and count like any other and can bridge two groups, but are no component's smallest id: a group of such vectors only has a
null component_id; ties of cosine with the threshold link; repeated rows count as vectors of their own; an empty table gives
an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table
from .components import components
from .simhash_dedup import Forest
from .tables import Tables

COSINE = 0.93
SEED = 11
#: Lines whose sides make the keys of cells, and lines whose places are counted.
WIDTH, LINES = 128, 32
#: Levels of a line: steps of this many deviations of a pair at the threshold; windows reach WINDOW levels to either side.
STEP, WINDOW = 1.0, 2
#: Levels to either side on the sorted line within which pairs are counted at all: one line decides here, so it reaches further.
REACH = 4
#: Classes that share a cell on average.
CELL = 512
#: Vectors of a label from which the keys' length is fitted, at most about.
SAMPLE = 1000
#: Classes of a candidate group that meet in one task.
CROWD = 4096
#: Sorted classes whose windows are counted at once.
BLOCK = 128


def tables(cosine: float = COSINE) -> Tables:
    """The cells' tables: a pair at the threshold meets with probability 0.999."""
    return Tables(WIDTH, math.acos(cosine) / math.pi, 0.999, WIDTH)


def least_count(recall: float = 0.999) -> int:
    """The largest count of collisions that a pair at the threshold attains with probability recall.

    A pair's places differ by a normal variable of one deviation, STEP levels are one deviation, and the boundaries of the
    levels lie anywhere: a difference of x levels collides surely up to WINDOW, and then with a chance that falls to none
    at WINDOW + 1.
    """
    grid = np.linspace(0, 8, 8001)
    density = 2 * np.exp(-grid * grid / 2) / math.sqrt(2 * math.pi)
    p = float((density * np.clip(WINDOW + 1 - grid / STEP, 0, 1)).sum() * (grid[1] - grid[0]))
    tail = 0.0
    for k in range(LINES, -1, -1):
        tail += math.comb(LINES, k) * p**k * (1 - p) ** (LINES - k)
        if tail >= recall:
            return k
    return 0


@cache
def _lines(length: int) -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(length, WIDTH + LINES))


def projected(vectors: np.ndarray, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray]:
    """Signs (rows by WIDTH, uint8) and levels (rows by LINES, 0 to 15) of unit vectors."""
    places = vectors @ _lines(vectors.shape[1])
    step = STEP * math.sqrt(2 * (1 - cosine))
    levels = np.clip(np.floor(places[:, WIDTH:] / step) + 8, 0, 15).astype(np.uint8)
    return (places[:, :WIDTH] > 0).astype(np.uint8), levels


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one, safe for the largest and smallest numbers."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def colliding(levels: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows whose levels collide on ``least`` lines or more; each pair once."""
    order = np.argsort(levels[:, 0], kind="stable")
    lines = np.ascontiguousarray(levels[order].T).astype(np.int8)
    half = LINES // 2
    for at in range(0, len(order), BLOCK):
        stop = min(at + BLOCK, len(order))
        # the windows on the sorted line, on the side of the larger places
        end = int(np.searchsorted(lines[0], int(lines[0, stop - 1]) + REACH, side="right"))
        missed = np.zeros((stop - at, end - at), np.uint8)
        for line in lines[:half]:
            missed += np.abs(line[at:stop, None] - line[None, at:end]) > WINDOW
        i, j = np.nonzero(missed <= LINES - least)
        near = i < j
        i, j = i[near] + at, j[near] + at
        if not len(i):
            continue
        rest = (np.abs(lines[half:, i] - lines[half:, j]) > WINDOW).sum(axis=0)
        close = missed[i - at, j - at] + rest <= LINES - least
        yield order[i[close]], order[j[close]]


def packed(levels: np.ndarray) -> np.ndarray:
    """Levels as two int64 a row."""
    return (levels[:, ::2] | levels[:, 1::2] << 4).view("<i8")


def unpacked(words: np.ndarray) -> np.ndarray:
    pairs = np.ascontiguousarray(words, "<i8").view(np.uint8)
    return np.stack([pairs & 15, pairs >> 4], 2).reshape(len(words), LINES)


def _matrix(column: pa.Array) -> np.ndarray:
    """A batch's lists of one length, as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose vectors have one length."""
    lengths = batch.column("width").to_numpy()
    for n in np.unique(lengths):
        yield batch.filter(pa.array(lengths == n))


def fitted_bits(vectors: np.ndarray, n: int, cosine: float = COSINE) -> int:
    """Length of the keys with which one of n vectors like these shares a cell with CELL others on average, at most 24."""
    words = np.packbits(projected(unit(vectors), cosine)[0], axis=1, bitorder="little").view(np.uint64)
    far = np.zeros(WIDTH + 1)
    for row in range(len(words) - 1):
        far += np.bincount(np.bitwise_count(words[row] ^ words[row + 1 :]).sum(axis=1), minlength=WIDTH + 1)
    meet = tables(cosine).meeting
    for bits in range(25):
        if n * sum(c * meet(d, bits) for d, c in enumerate(far.tolist())) <= CELL * far.sum():
            return bits
    return 24


def candidate_groups(compared: DataFrame, cosine: float = COSINE) -> tuple[DataFrame, DataFrame]:
    """(node, component) of the classes (node, label, width, embedding) with a candidate; and lid, the number of each label and width."""
    sizes = compared.groupBy("label", "width").agg(F.count("*").alias("__n"))
    sizes = materialize(sizes.withColumn("lid", F.monotonically_increasing_id()), "vector-labels")
    of = sizes.select(F.col("label").alias("__l"), F.col("width").alias("__w"), "__n", "lid")
    numbered = compared.join(of, (F.col("label") == F.col("__l")) & (F.col("width") == F.col("__w")))
    some = numbered.where((F.col("__n") > CELL) & (F.pmod(F.xxhash64("node"), F.col("__n")) < SAMPLE)).select("lid", "__n", "embedding")

    def fit(rows: pa.Table) -> pa.Table:
        vectors = _matrix(rows.column("embedding").combine_chunks())
        return pa.table({"lid": rows.column("lid").slice(0, 1), "key_bits": pa.array([fitted_bits(vectors, rows.column("__n")[0].as_py(), cosine)], pa.int32())})

    bits = materialize(some.groupBy("lid").applyInArrow(fit, "lid long, key_bits int"), "vector-keys").withColumnRenamed("lid", "__lid")
    given = numbered.join(bits, F.col("lid") == F.col("__lid"), "left").select("node", "lid", "width", "embedding", F.coalesce("key_bits", F.lit(0)).alias("key_bits"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_length(batch):
                signs, levels = projected(unit(_matrix(part.column("embedding"))), cosine)
                places, lengths = packed(levels), part.column("key_bits").to_numpy()
                node, lid = part.column("node").to_numpy(), part.column("lid").to_numpy().astype(np.uint64)
                for b in np.unique(lengths):
                    own = np.flatnonzero(lengths == b)
                    keys = tables(cosine).keys(signs[own], int(b), lid[own])
                    at = np.repeat(own, keys.shape[1])
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys.reshape(-1), node[at], places[at, 0], places[at, 1])], ["key", "node", "p1", "p2"])

    least = least_count()

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_keys(batches):
            node = rows.column("node").to_numpy()
            levels = unpacked(np.stack([rows.column("p1").to_numpy(), rows.column("p2").to_numpy()], 1))
            forest = Forest(len(node))
            for i, j in colliding(levels, least):
                forest.join(i, j)
            ends = node[forest.links()]
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    placed = given.mapInArrow(deal, "key long, node long, p1 long, p2 long").repartition("key").sortWithinPartitions("key")
    return components(placed.mapInArrow(links, "a long, b long").distinct()), numbered.select("node", "lid")


def _whole_keys(batches: Iterator[pa.RecordBatch], *also: str) -> Iterator[pa.Table]:
    """The rows of each key (and columns also), two at least, of batches in their order."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        values = np.stack([batch.column(c).to_numpy() for c in ("key", *also)])
        edges = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            now = tuple(values[:, a].tolist())
            if now != last and sum(x.num_rows for x in held) > 1:
                yield pa.Table.from_batches(held)
            held = [*held, batch.slice(a, b - a)] if now == last else [batch.slice(a, b - a)]
            last = now
    if sum(x.num_rows for x in held) > 1:
        yield pa.Table.from_batches(held)


def verified_links(vectors: np.ndarray, cosine: float = COSINE, key_bits: int = 0, number: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows that are candidates and have the cosine; of those, in a table, which meet in no earlier one."""
    a = unit(vectors)
    signs, levels = projected(a, cosine)
    earlier = tables(cosine).sampled(key_bits)[:number]
    for i, j in colliding(levels, least_count()):
        for at in range(0, len(i), 1 << 14):
            x, y = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
            near = np.einsum("nd,nd->n", a[x], a[y]) >= cosine
            x, y = x[near], y[near]
            for bits in earlier:
                new = (signs[x][:, bits] != signs[y][:, bits]).any(axis=1)
                x, y = x[new], y[new]
            if len(x):
                yield x, y


def _group_links(cosine: float):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (key, lid, key_bits, number, node, n, embedding) to (a, b, n): links a-b of the forest, and for a (b null) its linked vectors."""
        for rows in _whole_keys(batches, "lid"):
            node, copies = rows.column("node").to_numpy(), rows.column("n").to_numpy()
            vectors = _matrix(rows.column("embedding").combine_chunks())
            forest, near = Forest(len(node)), np.zeros(len(node))
            for i, j in verified_links(vectors, cosine, rows.column("key_bits")[0].as_py(), rows.column("number")[0].as_py()):
                near += np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
                forest.join(i, j)
            kept, some = node[forest.links()], near > 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([kept[:, 0], node[some]])),
                    pa.array(np.concatenate([kept[:, 1], node[some]]), mask=np.append(np.zeros(len(kept), bool), np.ones(some.sum(), bool))),
                    pa.array(np.concatenate([np.zeros(len(kept)), near[some]]).astype(np.int64)),
                ],
                ["a", "b", "n"],
            )

    return links


def found_links(compared: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(a, b, n) of the classes (node, label, width, embedding, n): links that span the groups, and (b null) linked vectors of a."""
    groups, labels = candidate_groups(compared, cosine)
    sizes = groups.groupBy(F.col("component").alias("__c")).agg(F.count("*").alias("size"))
    members = groups.join(sizes, F.col("component") == F.col("__c")).select(F.col("node").alias("__node"), "component", "size")
    rows = compared.join(members, F.col("node") == F.col("__node")).join(labels.withColumnRenamed("node", "__m"), F.col("node") == F.col("__m"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Once for a group of at most CROWD, else once a table."""
        for batch in batches:
            for part in _by_length(batch):
                size = part.column("size").to_numpy()
                lengths = np.where(size <= CROWD, 0, np.minimum(24, np.ceil(2 * np.log2(size / CROWD)))).astype(np.int32)
                signs, _ = projected(unit(_matrix(part.column("embedding"))), cosine)
                for b in np.unique(lengths).tolist():
                    own = np.flatnonzero(lengths == b)
                    keys = tables(cosine).keys(signs[own], b, part.column("component").to_numpy()[own].astype(np.uint64))
                    for k in range(keys.shape[1]):
                        same = part.take(pa.array(own))
                        columns = [pa.array(np.ascontiguousarray(keys[:, k])), same.column("lid"), pa.array(np.full(len(own), b, np.int32)), pa.array(np.full(len(own), k, np.int32))]
                        yield pa.RecordBatch.from_arrays([*columns, *[same.column(c) for c in ("node", "n", "embedding")]], ["key", "lid", "key_bits", "number", "node", "n", "embedding"])

    kind = compared.schema["embedding"].dataType.simpleString()
    dealt = rows.select("component", "size", "lid", "width", "node", "n", "embedding").mapInArrow(
        deal, f"key long, lid long, key_bits int, number int, node long, n long, embedding {kind}"
    )
    placed = dealt.repartition("key").sortWithinPartitions("key", "lid")
    return placed.mapInArrow(_group_links(cosine), "a long, b long, n long")


def usable(label: Column, embedding: Column) -> Column:
    """True for vectors that can link."""
    odd = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(label.isNotNull() & ~odd & F.exists(embedding, lambda x: x != 0), F.lit(False))


def embedding_dedup(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of vectors (vec_id, embedding, label)."""
    own = vectors.select("vec_id", "label", "embedding")
    good = own.where(usable(F.col("label"), F.col("embedding")))
    once = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    classes = materialize(once.withColumns({"node": F.monotonically_increasing_id(), "width": F.size("embedding")}), "vector-classes")
    found = materialize(found_links(classes.select("node", "label", "width", "embedding", "n"), cosine), "vector-links")
    degrees = found.where("b IS NULL").groupBy(F.col("a").alias("__a")).agg(F.sum("n").alias("__near"))
    groups = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "__node")
    grouped = materialize(
        classes.select("node", "rep", "n")
        .join(degrees, F.col("node") == F.col("__a"), "left")
        .join(groups, F.col("node") == F.col("__node"), "left")
        .select("node", "rep", (F.col("n") - 1 + F.coalesce("__near", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("__group")),
        "vector-groups",
    )
    # min skips nulls: a group's id is null only where none of its rows has one
    least = grouped.groupBy(F.col("__group").alias("__g")).agg(F.min("rep").alias("component_id"))
    named = grouped.join(least, F.col("__group") == F.col("__g")).select(F.col("node").alias("__n"), "n_links", "component_id")
    described = classes.join(named, F.col("node") == F.col("__n")).select(F.col("label").alias("__l"), F.col("embedding").alias("__e"), "n_links", "component_id")
    judged = good.join(described, (F.col("label") == F.col("__l")) & (F.col("embedding") == F.col("__e"))).select(
        "vec_id", "n_links", "component_id"
    )
    alone = own.where(~usable(F.col("label"), F.col("embedding"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return judged.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


ORACLE = f"""WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e,
  sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_inner_product(a.e, b.e) / (a.norm * b.norm) >= {COSINE}),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a)
SELECT m.vec_id, coalesce(n, 0)::BIGINT AS n_links, c.component_id, m.vec_id = c.component_id AS kept
FROM embeddings m LEFT JOIN (SELECT a, count(*) AS n FROM p GROUP BY a) d ON m.vec_id = d.a
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON m.vec_id = c.a"""
