"""Profiling and simple tests of tables; every operator is one or two aggregations, whatever the number of rows."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def quantile(c: str | Column, q: float, accuracy: int | None = None) -> Column:
    """A quantile: exact (its buffer grows with the distinct values), or with ``accuracy`` from a sketch of bounded size."""
    return F.percentile(c, F.lit(q)) if accuracy is None else F.percentile_approx(c, F.lit(q), F.lit(accuracy)).cast("double")


def long_form(df: DataFrame, columns: list[str]) -> DataFrame:
    """(col, value) with one row per cell; values as text."""
    cells = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(cells).alias("x")).select("x.col", "x.value")


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(col, value, n) of the non-null values."""
    return long_form(df, columns).where("value IS NOT NULL").groupBy("col", "value").agg(F.count("*").alias("n"))


def missingness(df: DataFrame, dataset: str) -> DataFrame:
    """dataset, col, n_missing, missing_rate of every column, in one pass."""
    sums = df.agg(F.count("*").alias("n"), *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("col"), F.coalesce(F.col(c), F.lit(0)).alias("n_missing")) for c in df.columns])
    rows = sums.select("n", F.explode(cells).alias("x"))
    return rows.select(F.lit(dataset).alias("dataset"), "x.col", "x.n_missing", (F.col("x.n_missing") / F.nullif("n", F.lit(0))).alias("missing_rate"))


def info_content(df: DataFrame, dataset: str, columns: list[str]) -> DataFrame:
    """dataset, col, n_non_null, n_distinct, top_share, entropy_bits of each column's values."""
    counts = value_counts(df, columns)
    total = counts.withColumn("p", F.col("n") / F.sum("n").over(W.partitionBy("col")))
    return total.groupBy("col").agg(
        F.sum("n").alias("n_non_null"),
        F.count("*").alias("n_distinct"),
        F.max("p").alias("top_share"),
        (-F.sum(F.col("p") * F.log2("p"))).alias("entropy_bits"),
    ).select(F.lit(dataset).alias("dataset"), "*")


def key_stats(df: DataFrame, key: str, dataset: str, accuracy: int | None = None) -> DataFrame:
    """n_keys, average, 95 % and largest block, top share and entropy of a block key."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    shares = counts.agg(
        F.count("*").alias("n_keys"),
        F.avg("n").alias("avg_block"),
        quantile("n", 0.95, accuracy).alias("p95_block"),
        F.max("n").alias("max_block"),
        (F.max("n") / F.sum("n")).alias("top_share"),
        # sum of p * log p from sums over counts, so that no total is joined back
        (F.log2(F.sum("n").cast("double")) - F.sum(F.col("n") * F.log2(F.col("n").cast("double"))) / F.sum("n")).alias("entropy_bits"),
    )
    return shares.select(F.lit(dataset).alias("dataset"), F.lit(key).alias("key"), "*")


def mutual_information(df: DataFrame, columns: list[str], dataset: str) -> DataFrame:
    """dataset, col_a, col_b, mi_bits of every pair of columns; null counts as empty text.

    Joint counts of the pairs that occur, joined with the marginal counts.
    """
    pairs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.coalesce(F.col(a).cast("string"), F.lit("")).alias("x"), F.coalesce(F.col(b).cast("string"), F.lit("")).alias("y"))
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
    ]
    joint = df.select(F.explode(F.array(*pairs)).alias("p")).groupBy("p.a", "p.b", "p.x", "p.y").agg(F.count("*").alias("n"))
    both = W.partitionBy("a", "b")
    at = joint.withColumns(
        {"t": F.sum("n").over(both), "nx": F.sum("n").over(W.partitionBy("a", "b", "x")), "ny": F.sum("n").over(W.partitionBy("a", "b", "y"))}
    )
    p, px, py = (F.col(c) / F.col("t") for c in ("n", "nx", "ny"))
    bits = F.sum(p * F.log2(p / (px * py) + 1e-15))
    return at.groupBy("a", "b").agg(bits.alias("mi_bits")).select(F.lit(dataset).alias("dataset"), F.col("a").alias("col_a"), F.col("b").alias("col_b"), "mi_bits")


def numeric_columns(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t in NUMERIC]


def numeric_summary(df: DataFrame, dataset: str, columns: list[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """dataset, col, count, mean, std (0 for one value), p01, p50, p99, min, max of numeric columns."""
    columns = columns or numeric_columns(df)
    cells = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v")) for c in columns])
    rows = df.select(F.explode(cells).alias("x")).select("x.col", "x.v").where("v IS NOT NULL")
    at = lambda q: quantile("v", q, accuracy)
    return rows.groupBy("col").agg(
        F.count("*").alias("count"),
        F.avg("v").alias("mean"),
        F.coalesce(F.stddev_samp("v"), F.lit(0.0)).alias("std"),
        at(0.01).alias("p01"),
        at(0.5).alias("p50"),
        at(0.99).alias("p99"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    ).select(F.lit(dataset).alias("dataset"), "*")


def top_values(df: DataFrame, dataset: str, columns: list[str], k: int = 10) -> DataFrame:
    """The k most frequent values of each column, ties by value."""
    order = W.partitionBy("col").orderBy(F.desc("n"), "value")
    ranked = value_counts(df, columns).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.lit(dataset).alias("dataset"), "col", "value", "n", "rank")


def correlations(df: DataFrame, dataset: str, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns over the rows that have both, null if one is constant there."""
    columns = columns or numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "dataset string, col_a string, col_b string, corr double")
    spread = lambda x, y: F.stddev_pop(F.when(F.col(y).isNotNull(), F.col(x)))
    corr = lambda a, b: F.try_divide(F.covar_pop(a, b), spread(a, b) * spread(b, a))
    one = df.agg(*[corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(cells).alias("x")).select(F.lit(dataset).alias("dataset"), "x.*")


def chi_square(df: DataFrame, a: Column, b: Column, name: str) -> DataFrame:
    """Yates-corrected chi-square of two boolean columns: test, stat, p_value."""
    cell = lambda x, y: F.sum(((F.col("a") == x) & (F.col("b") == y)).cast("double"))
    t = df.select(a.alias("a"), b.alias("b")).agg(
        cell(False, False).alias("ff"), cell(False, True).alias("ft"), cell(True, False).alias("tf"), cell(True, True).alias("tt")
    )
    n = F.col("ff") + F.col("ft") + F.col("tf") + F.col("tt")
    det = F.abs(F.col("ff") * F.col("tt") - F.col("ft") * F.col("tf"))
    sides = (F.col("ff") + F.col("ft")) * (F.col("tf") + F.col("tt")) * (F.col("ff") + F.col("tf")) * (F.col("ft") + F.col("tt"))
    # the correction moves each cell by half at most, and not beyond its expected value
    stat = n * F.pow(F.greatest(det - n / 2, F.lit(0.0)), 2) / F.nullif(sides, F.lit(0.0))
    return t.select(F.lit(name).alias("test"), stat.alias("stat")).withColumn("p_value", _chi1_tail(F.col("stat")))


def _chi1_tail(x: Column) -> Column:
    """Upper tail of chi-square with one degree of freedom, by a rational approximation of erfc (error under 2e-7)."""
    z = F.sqrt(x / 2)
    t = 1 / (1 + 0.5 * z)
    # fixed values: coefficients of the Chebyshev fit of erfc
    coefficients = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    poly = F.lit(coefficients[-1])
    for c in coefficients[-2::-1]:
        poly = poly * t + c
    return t * F.exp(-z * z + poly)


def ks_two_sample(df: DataFrame, group: Column, value: str, name: str, least: int = 50) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test between rows where group is false and true; no row unless both have ``least``.

    Counts per distinct value, then running sums.
    """
    at = (
        df.select(group.alias("g"), F.col(value).alias("v"))
        .where("v IS NOT NULL AND g IS NOT NULL")
        .groupBy("v")
        .agg(F.sum((~F.col("g")).cast("long")).alias("n0"), F.sum(F.col("g").cast("long")).alias("n1"))
    )
    # running sums within ranges of the values and over the ranges, whose bounds are quantiles: no window holds all values
    bounds = at.agg(F.percentile_approx("v", [i / 256 for i in range(1, 256)], F.lit(10_000)).alias("bounds"))
    ranged = at.crossJoin(F.broadcast(bounds)).withColumn("r", F.size(F.filter("bounds", lambda x: x < F.col("v")))).drop("bounds")
    below = W.orderBy("r").rowsBetween(W.unboundedPreceding, -1)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    starts = ranged.groupBy("r").agg(F.sum("n0").alias("m0"), F.sum("n1").alias("m1")).select(
        F.col("r").alias("s"),
        F.coalesce(F.sum("m0").over(below), F.lit(0)).alias("s0"),
        F.coalesce(F.sum("m1").over(below), F.lit(0)).alias("s1"),
        F.sum("m0").over(whole).alias("t0"),
        F.sum("m1").over(whole).alias("t1"),
    )
    run = W.partitionBy("r").orderBy("v")
    sums = ranged.withColumns({"c0": F.sum("n0").over(run), "c1": F.sum("n1").over(run)}).join(starts, F.col("r") == F.col("s"))
    gap = F.abs((F.col("c0") + F.col("s0")) / F.col("t0") - (F.col("c1") + F.col("s1")) / F.col("t1"))
    enough = sums.where((F.col("t0") >= least) & (F.col("t1") >= least))
    d = enough.agg(F.max(gap).alias("stat"), F.max("t0").alias("n0"), F.max("t1").alias("n1"))
    en = F.sqrt(F.col("n0") * F.col("n1") / (F.col("n0") + F.col("n1")).cast("double"))
    scaled = en * F.col("stat")
    p = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda s, k: s + 2 * F.pow(F.lit(-1.0), k - 1) * F.exp(-2 * k * k * scaled * scaled)
    )
    return d.where("stat IS NOT NULL").select(F.lit(name).alias("test"), "stat", F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)).alias("p_value"))


def imputation(missing: DataFrame) -> DataFrame:
    """A strategy for each column by its missing rate."""
    rate = F.col("missing_rate")
    tier = F.when(rate > 0.30, "keep missing as signal").when(rate > 0.05, "light imputation and flag").otherwise("simple fill")
    return missing.where(rate.isNotNull()).select("dataset", "col", tier.alias("strategy"))


def outliers(df: DataFrame, dataset: str, column: str, key: str, limit: float = 8.0, least: int = 200, accuracy: int | None = None) -> DataFrame:
    """Rows whose robust z-score (0.6745 (x - median) / MAD) is at least ``limit`` either way; none under ``least`` rows."""
    own = df.select(F.col(key).alias("key"), F.col(column).cast("double").alias("value")).where("key IS NOT NULL AND value IS NOT NULL")
    mid = own.agg(quantile("value", 0.5, accuracy).alias("med"), F.count("*").alias("n"))
    # one row on either right side
    centred = own.crossJoin(F.broadcast(mid)).where(F.col("n") >= least)
    spread = centred.agg(quantile(F.abs(F.col("value") - F.col("med")), 0.5, accuracy).alias("mad"))
    z = 0.6745 * (F.col("value") - F.col("med")) / F.when(F.col("mad") == 0, 1e-9).otherwise(F.col("mad"))
    return centred.crossJoin(F.broadcast(spread)).withColumn("z", z).where(F.abs("z") >= limit).select(
        "key", "value", "z", F.lit(dataset).alias("dataset"), F.lit(column).alias("metric")
    )


def overlap_rate(a: DataFrame, b: DataFrame, column_a: str, column_b: str) -> DataFrame:
    """Share of common distinct values in the smaller set; null if a set is empty."""
    x = a.select(F.col(column_a).alias("v")).where("v IS NOT NULL").distinct().withColumn("ina", F.lit(1))
    y = b.select(F.col(column_b).alias("v")).where("v IS NOT NULL").distinct().withColumn("inb", F.lit(1))
    both = x.join(y, "v", "full").agg(F.count("ina").alias("na"), F.count("inb").alias("nb"), F.sum(F.col("ina") * F.col("inb")).alias("n"))
    return both.select((F.coalesce("n", F.lit(0)) / F.nullif(F.least("na", "nb"), F.lit(0))).alias("overlap_rate"))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """bin (0: below, bins + 1: above), n: the data of a plot."""
    step = (high - low) / bins
    v = F.col(column)
    at = F.when(v < low, 0).when(v >= high, bins + 1).otherwise(F.floor((v - low) / step).cast("int") + 1)
    return df.where(v.isNotNull()).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def schema_map(spark, mapping: dict[str, dict[str, str | None]]) -> DataFrame:
    """concept, dataset, column of a canonical mapping."""
    rows = [(c, d, col) for c, m in mapping.items() for d, col in m.items()]
    return spark.createDataFrame(rows, "concept string, dataset string, column string")


