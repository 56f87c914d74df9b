"""Similarity of two texts, from Columns to Column; two empty sides count as equal unless said otherwise."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from . import text as T

#: Buckets of hashed character grams.
CHAR_BUCKETS = 1 << 14


def jaro(a: str, b: str) -> float:
    """Jaro similarity of two normalised texts; half a transposition counts as half."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    taken: set[int] = set()
    common = []
    for i, ch in enumerate(a):
        at = b.find(ch, max(0, i - reach), max(0, i + reach + 1))
        while at in taken:
            at = b.find(ch, at + 1, i + reach + 1)
        if at >= 0:
            taken.add(at)
            common.append(ch)
    if not common:
        return 0.0
    n = len(common)
    swapped = sum(x != b[k] for x, k in zip(common, sorted(taken), strict=True)) / 2
    return (n / len(a) + n / len(b) + (n - swapped) / n) / 3


#: Pairs that this worker has computed; it starts anew beyond the bound.
_known: dict[tuple[str, str], float] = {}
_MOST_KNOWN = 300_000


@pandas_udf(DoubleType())
def _jaro(a: pd.Series, b: pd.Series) -> pd.Series:
    if len(_known) > _MOST_KNOWN:
        _known.clear()
    pairs = list(zip(a, b, strict=True))
    for pair in set(pairs).difference(_known):
        _known[pair] = jaro(*pair)
    return pd.Series([_known[p] for p in pairs], dtype="float64")


def jaro_similarity(a: Column, b: Column) -> Column:
    """Jaro similarity; no built-in function computes it, so an Arrow UDF does, once per distinct pair of a batch."""
    return _jaro(T.norm(a), T.norm(b))


def jaro_winkler(a: Column, b: Column, p: float = 0.1, most: int = 4) -> Column:
    """Jaro similarity raised by the length of the common start, however low it is."""
    return jaro_winkler_normed(T.norm(a), T.norm(b), p, most)


def jaro_winkler_normed(x: Column, y: Column, p: float = 0.1, most: int = 4) -> Column:
    """jaro_winkler of texts that norm has already been applied to."""
    j = _jaro(T.norm(x), T.norm(y))
    start = F.lit(0)
    for k in range(1, most + 1):
        same = (F.length(x) >= k) & (F.length(y) >= k) & (F.substring(x, 1, k) == F.substring(y, 1, k))
        start = start + same.cast("int")
    return j + start * F.lit(p) * (1 - j)


def levenshtein_dist(a: Column, b: Column) -> Column:
    return F.levenshtein(T.norm(a), T.norm(b))


def lev_sim(a: Column, b: Column) -> Column:
    """One less the edit distance over the longer length."""
    return lev_sim_normed(T.norm(a), T.norm(b))


def lev_sim_normed(x: Column, y: Column) -> Column:
    """lev_sim of texts that norm has already been applied to."""
    longest = F.greatest(F.length(x), F.length(y))
    return (
        F.when(longest == 0, F.lit(1.0))
        .when((x == "") | (y == ""), F.lit(0.0))
        .otherwise(1 - levenshtein_dist(x, y) / longest)
    )


def overlap_ratio(a: Column, b: Column) -> Column:
    """Common elements over all elements of two arrays without repeats."""
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))
    )


def token_jaccard(a: Column, b: Column) -> Column:
    return overlap_ratio(T.tokens_set(a), T.tokens_set(b))


def idf(texts: Column, df: DataFrame, max_vocab: int = 200_000) -> DataFrame:
    """token, df, idf over the non-empty texts; the max_vocab most frequent tokens, ties by token."""
    tokens = df.select(T.tokens_set(texts).alias("t")).where(F.size("t") > 0)
    n = tokens.agg(F.count("*").alias("n"))
    counts = tokens.select(F.explode("t").alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    top = counts.orderBy(F.desc("df"), "token").limit(max_vocab)
    # n is one row
    return top.crossJoin(F.broadcast(n)).select("token", "df", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def _unit(entries: Column) -> Column:
    """Map from array of (key, weight) structs, scaled to length one."""
    size = F.sqrt(F.aggregate(entries, F.lit(0.0), lambda s, e: s + e["w"] * e["w"]))
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["k"], e["w"] / size)))


def tfidf_vectors(df: DataFrame, key: str, text: Column, weights: DataFrame) -> DataFrame:
    """key, vec: a unit map from token to weight for every key, empty if no token has a weight. One vector a record."""
    tokens = df.select(key, F.explode(T.tokens_word(text)).alias("token"))
    counted = tokens.groupBy(key, "token").agg(F.count("*").alias("tf")).join(weights, "token")
    vectors = (
        counted.select(key, F.struct(F.col("token").alias("k"), (F.col("tf") * F.col("idf")).alias("w")).alias("e"))
        .groupBy(key)
        .agg(F.sort_array(F.collect_list("e")).alias("es"))
        .select(key, _unit(F.col("es")).alias("vec"))
    )
    empty = F.create_map().cast("map<string,double>")
    return df.select(key).distinct().join(vectors, key, "left").withColumn("vec", F.coalesce("vec", empty))


def char_table(spark: SparkSession) -> DataFrame:
    """gram, bucket for every gram of one to three of A-Z and 0-9: a table of fixed size, from its rule."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    grams = [*letters, *[a + b for a in letters for b in letters], *[a + b + c for a in letters for b in letters for c in letters]]
    bucket = lambda g: int.from_bytes(hashlib.blake2b(g.encode(), digest_size=4).digest(), "little") % CHAR_BUCKETS
    return spark.createDataFrame(pd.DataFrame({"gram": grams, "bucket": [bucket(g) for g in grams]}), "gram string, bucket int")


def char3_vectors(df: DataFrame, key: str, text: Column) -> DataFrame:
    """key, vec: a unit map from hashed three-character gram to weight for every key."""
    grams = df.select(key, F.explode(T.char_ngrams(text, 3)).alias("gram"))
    counted = grams.join(F.broadcast(char_table(df.sparkSession)), "gram").groupBy(key, "bucket").agg(F.count("*").alias("tf"))
    vectors = (
        counted.select(key, F.struct(F.col("bucket").alias("k"), F.col("tf").cast("double").alias("w")).alias("e"))
        .groupBy(key)
        .agg(F.sort_array(F.collect_list("e")).alias("es"))
        .select(key, _unit(F.col("es")).alias("vec"))
    )
    empty = F.create_map().cast("map<int,double>")
    return df.select(key).distinct().join(vectors, key, "left").withColumn("vec", F.coalesce("vec", empty))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two unit maps, from 0 to 1."""
    common = F.array_intersect(F.map_keys(a), F.map_keys(b))
    dot = F.aggregate(common, F.lit(0.0), lambda s, k: s + F.element_at(a, k) * F.element_at(b, k))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot)))
    )


def zip_num_sim(a: Column, b: Column) -> Column:
    """One less the difference of the first five digits over 10,000, not below 0; 0 if a side has no five digits."""
    number = lambda c: F.when(F.length(T.norm(c)) >= 5, F.substring(T.norm(c), 1, 5).try_cast("int"))
    gap = F.abs(number(a) - number(b))
    return F.coalesce(F.greatest(F.lit(0.0), 1 - gap / 10_000), F.lit(0.0))
