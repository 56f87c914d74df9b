"""Mixing sources to target weights by systematic sampling.

Targets: sources in code point order (null last) weigh 5, 2, 1 and so on in turn and share the total size; a target
stops at ``most`` times its source's size and the rest of the total is shared anew by weight (water filling, closed
form over the sorted saturation levels). Sampling: every document of a source is expected target / source_size times.
The expected copies are summed along the source's documents in size order, one random offset per source is added, and a
document is taken once for each integer that its interval crosses, so a source's documents of every size are taken in
proportion and reruns agree.

A running sum of documents balances words up to the largest document. So the smallest documents, a quarter of the source's
words, come last: their expected copies are what is left of the target once the others are sampled, shared by their
words. What a source misses is then about one of these small documents, not of the largest.

The running sum is made of three short windows (documents of a block, blocks of a size class, classes of a source), so
no window holds a whole source. Blocks go by a hash of doc_id and text, so null or repeated ids are spread.

Defined results: a null text has size 0; a source without words has target 0 and none of its documents is taken; very long
texts are documents like others; documents of one size are ordered by doc_id, null first, then by the hash, and equal rows
are sampled one by one; an empty table gives an empty result. Input columns named like an output column of ``place`` are
replaced; ``mixture`` returns all columns as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import materialize, n_words, table

WEIGHTS = (5.0, 2.0, 1.0)
#: Blocks of a size class, by hash of doc_id.
BLOCKS = 256


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """(source, source_size) with target and rate, one row per source; sources are few, so one task orders them."""
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighted = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn + 1))
    cap = F.col("source_size") * most
    by_level = W.orderBy((cap / F.col("w")), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    filled = weighted.withColumns(
        {
            "pos": F.row_number().over(by_level),
            "level": (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
            / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))),
        }
    )
    open_ = F.col("level") <= cap / F.col("w")
    water = F.min(F.when(open_, F.struct("pos", "level"))).over(everything)["level"]
    return filled.withColumn("water", water).select(
        "source",
        "source_size",
        F.when(open_, F.col("w") * F.col("water")).otherwise(cap.cast("double")).alias("target"),
    ).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))


def _class(size: Column) -> Column:
    """Size classes of a sixteenth to a thirty-second of the size; a larger size never has a smaller class."""
    e = F.length(F.bin(size))
    return (e * 16 + F.expr("shiftright(__size, greatest(length(bin(__size)) - 5, 0))")).cast("int")


#: Share of a source's words in the small documents that are sampled last.
LAST = 0.25


def _offset(source: Column) -> Column:
    """The random start of a source, from 0 to 1."""
    return F.conv(F.substring(F.md5(F.coalesce(source, F.lit("\x00"))), 1, 8), 16, 10).cast("double") / 4294967296.0


def _crossed(most: int) -> Column:
    """Integers between the running sums of expected copies before and after a document."""
    at = F.col("__start") + F.col("__rank")
    n = F.floor(F.col("__u") + F.col("__rate") * (at + 1)) - F.floor(F.col("__u") + F.col("__rate") * at)
    return F.greatest(F.least(n, F.lit(most)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """The source as a text that is never null, so that windows and joins deal rows out alike and texts move once."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def row_hash() -> Column:
    """60 bits of a hash of doc_id and text."""
    both = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col("text"), F.lit("")))
    return F.conv(F.substring(F.md5(both), 1, 15), 16, 10).cast("long")


def _sized(docs: DataFrame, size: Column) -> DataFrame:
    """docs with __h (of its text unless it has one), __source, __size, its __class and the document's __block."""
    hashed = docs if "__h" in docs.columns else docs.withColumn("__h", row_hash())
    sized = hashed.withColumns({"__source": _key(F.col("source")), "__size": size.cast("long")})
    return sized.withColumns({"__class": _class(F.col("__size")), "__block": (F.col("__h") % BLOCKS).cast("int")})


def _ranked(sized: DataFrame, starts: DataFrame) -> DataFrame:
    """sized with its place among the documents of its source."""
    rank = F.row_number().over(W.partitionBy("__source", "__class", "__block").orderBy("__size", "doc_id", "__h")) - 1
    same = (F.col("__source") == F.col("__s")) & (F.col("__class") == F.col("__c")) & (F.col("__block") == F.col("__b"))
    return sized.withColumn("__rank", rank).join(starts, same).drop("__source", "__s", "__c", "__b", "__h")


def plan(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """For every block of documents: where it starts in its source, and the source's size, target, rate and offset.

    sizes: doc_id, source, size and __h, as of ``word_sizes``; it is read more than once.
    """
    sized = _sized(sizes, F.col("size"))
    blocks = sized.groupBy("source", "__source", "__class", "__block").agg(F.count("*").alias("n"), F.sum("__size").alias("s"))
    blocks = materialize(blocks, "mix-blocks")
    preceding = lambda *keys: W.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(W.unboundedPreceding, -1)
    before = lambda c, *keys: F.coalesce(F.sum(c).over(preceding(*keys)), F.lit(0))
    classes = (
        blocks.groupBy("__source", "__class")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        .withColumns({"__before": before("n", "__source", "__class"), "__below": before("s", "__source", "__class")})
        .select("__source", "__class", "s", "__before", "__below")
    )
    targets = source_targets(blocks.groupBy("source").agg(F.sum("s").alias("source_size")), weights, most)
    starts = classes.join(targets, F.col("__source") == _key(F.col("source"))).select(
        F.col("__source").alias("__s"),
        F.col("__class").alias("__c"),
        "__before",
        F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"),
        F.col("rate").alias("__rate"),
        _offset(F.col("source")).alias("__u"),
        (F.col("__below") < LAST * F.col("source_size")).alias("__last"),
        "s",
    )
    within = blocks.withColumn("__in", before("n", "__source", "__class", "__block")).drop("s")
    columns = ["__s", "__c", F.col("__block").alias("__b"), (F.col("__before") + F.col("__in")).alias("__start"), "__source_size", "__target", "__rate", "__u", "__last"]
    starts = starts.withColumn("__small", F.sum(F.when(F.col("__last"), F.col("s")).otherwise(0)).over(W.partitionBy("__s")))
    starts = within.join(starts, (F.col("__source") == F.col("__s")) & (F.col("__class") == F.col("__c"))).select(*columns, "__small")
    starts = materialize(starts, "mix-starts")
    first = _ranked(sized, starts.where("NOT __last")).groupBy(_key(F.col("source")).alias("__o")).agg(F.sum(_crossed(most) * F.col("__size")).alias("__t"))
    rest = (F.col("__target") - F.coalesce("__t", F.lit(0))) / F.col("__small")
    rate = F.when(F.col("__last") & (F.col("__small") > 0), F.least(F.greatest(rest, F.lit(0.0)), F.lit(float(most)))).otherwise(F.col("__rate"))
    planned = starts.join(first, F.col("__s") == F.col("__o"), "left").withColumn("__rate", rate)
    return materialize(planned.drop("__o", "__t", "__small", "__last"), "mix-plan")


def place(docs: DataFrame, size: Column, planned: DataFrame, most: int = 3) -> DataFrame:
    """docs with size, source_size, target, copies and taken (copies times size), as planned from the same documents."""
    outputs = ("size", "source_size", "target", "copies", "taken")
    placed = _ranked(_sized(docs, size).drop(*outputs), planned).withColumn("copies", _crossed(most))
    return placed.withColumns(
        {
            "size": F.col("__size"),
            "source_size": F.col("__source_size"),
            "target": F.col("__target"),
            "taken": F.col("copies") * F.col("__size"),
        }
    ).drop("__size", "__class", "__block", "__start", "__rank", "__source_size", "__target", "__rate", "__u")


def word_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and __h (the row's hash) of every row, written to the shared folder."""
    return materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), row_hash().alias("__h")), "mix-sizes")


def mixture(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """The mix itself: every row of docs as often as it is taken, with its own columns."""
    planned = plan(word_sizes(docs), weights, most)
    whole = docs.select("doc_id", "source", n_words(F.col("text")).alias("__words"), row_hash().alias("__h"), F.struct("*").alias("__doc"))
    mixed = place(whole, F.col("__words"), planned, most)
    return mixed.where("copies > 0").select("__doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("__doc.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = word_sizes(table(spark, sf_dir, "documents"))
    return place(sizes, F.col("size"), plan(sizes)).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = f"""WITH d AS (SELECT doc_id, source, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS h,
  len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w FROM s),
f AS (SELECT *, row_number() OVER b AS pos,
  (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / (sum(w) OVER () - coalesce(sum(w) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM w WINDOW b AS (ORDER BY 3 * source_size / w, source NULLS LAST)),
l AS (SELECT level AS water FROM f WHERE level <= 3 * source_size / w ORDER BY pos LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN level <= 3 * source_size / w THEN w * water ELSE 3.0 * source_size END::DOUBLE AS target FROM f, l),
c AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
  length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 5, 0)) AS cls, h % {BLOCKS} AS blk,
  ('0x' || substr(md5(coalesce(d.source, chr(0))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT source, cls, coalesce(sum(s) OVER (PARTITION BY source ORDER BY cls ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT source, cls, sum(size) AS s FROM c GROUP BY source, cls) z),
r AS (SELECT c.*, below < {LAST} * source_size AS last_, row_number() OVER (PARTITION BY c.source ORDER BY c.cls, blk, size, doc_id NULLS FIRST, h) - 1 AS k
  FROM c JOIN k ON c.source IS NOT DISTINCT FROM k.source AND c.cls = k.cls),
a AS (SELECT source, sum(CASE WHEN last_ THEN size ELSE 0 END)::DOUBLE AS small,
  coalesce(sum(CASE WHEN NOT last_ THEN greatest(least(floor(u + rate * (k + 1)) - floor(u + rate * k), 3), 0) * size END), 0)::DOUBLE AS t FROM r GROUP BY source),
x AS (SELECT r.* EXCLUDE (rate), CASE WHEN last_ AND small > 0 THEN least(greatest((target - t) / small, 0.0), 3.0) ELSE rate END AS rate
  FROM r JOIN a ON r.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target, (greatest(least(floor(u + rate * (k + 1)) - floor(u + rate * k), 3), 0) * size)::BIGINT AS taken FROM x"""
