"""Evaluation of scored pairs (y 0/1, score) and statistical validation.

Curves are running sums over score groups: rows are first summed per distinct score, so ties are exact, and the sums run
within score ranges and over the ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Ranges that scores from 0 to 1 are divided into for running sums.
RANGES = 4096


def confusion(df: DataFrame, threshold: Column | float, by: list[str] | None = None, weight: Column | None = None) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1 at a threshold (score at least that); 0 where undefined."""
    w = F.lit(1) if weight is None else weight
    hit = F.col("score") >= threshold
    sums = df.groupBy(*(by or [])).agg(
        *[
            F.sum(F.when((F.col("y") == y) & (hit if h else ~hit), w).otherwise(0)).alias(n)
            for n, y, h in (("tp", 1, True), ("fp", 0, True), ("fn", 1, False), ("tn", 0, False))
        ]
    )
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return sums.withColumns({"precision": p, "recall": r}).withColumn(
        "f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )


def curve(df: DataFrame, by: list[str] | None = None, weight: Column | None = None) -> DataFrame:
    """Per distinct score (threshold): pos, neg, running tp and fp from the top, all, precision, recall."""
    by = by or []
    w = F.lit(1) if weight is None else weight
    groups = df.groupBy(*by, F.col("score").alias("threshold")).agg(
        F.sum(F.when(F.col("y") == 1, w).otherwise(0)).alias("pos"), F.sum(F.when(F.col("y") == 0, w).otherwise(0)).alias("neg")
    )
    # running sums within score ranges, and of whole ranges: no window holds all scores
    ranged = groups.withColumn("__range", F.floor(F.col("threshold") * RANGES))
    ranges = ranged.groupBy(*by, "__range").agg(F.sum("pos").alias("__pos"), F.sum("neg").alias("__neg"))
    above = W.partitionBy(*by).orderBy(F.desc("__range")).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    starts = ranges.select(
        *[F.col(c).alias(f"__{c}") for c in by],
        F.col("__range").alias("__start"),
        F.coalesce(F.sum("__pos").over(above), F.lit(0)).alias("__tp"),
        F.coalesce(F.sum("__neg").over(above), F.lit(0)).alias("__fp"),
        F.sum("__pos").over(whole).alias("all_pos"),
        F.sum("__neg").over(whole).alias("all_neg"),
    )
    same = F.col("__range") == F.col("__start")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    down = W.partitionBy(*by, "__range").orderBy(F.desc("threshold"))
    within = ranged.withColumns({"tp": F.sum("pos").over(down), "fp": F.sum("neg").over(down)})
    at = within.join(starts, same).select(
        *by, "threshold", "pos", "neg", (F.col("tp") + F.col("__tp")).alias("tp"), (F.col("fp") + F.col("__fp")).alias("fp"), "all_pos", "all_neg"
    )
    return at.withColumns(
        {
            "precision": F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0)),
            "recall": F.col("tp") / F.nullif(F.col("all_pos"), F.lit(0)),
        }
    )


def average_precision(df: DataFrame, by: list[str] | None = None, weight: Column | None = None) -> DataFrame:
    """Sum over thresholds of precision times the gain in recall."""
    at = curve(df, by, weight)
    return at.groupBy(*(by or [])).agg(F.sum(F.col("precision") * F.col("pos") / F.nullif(F.col("all_pos"), F.lit(0))).alias("pr_auc"))


def roc_auc(df: DataFrame, by: list[str] | None = None, weight: Column | None = None) -> DataFrame:
    """Chance that a positive outscores a negative, ties half; null with one class."""
    at = curve(df, by, weight)
    below = F.col("all_neg") - F.col("fp") + F.col("neg") / 2
    return at.groupBy(*(by or [])).agg(
        (F.sum(F.col("pos") * below) / F.nullif(F.max(F.col("all_pos") * F.col("all_neg")), F.lit(0))).alias("roc_auc")
    )


def best_f1(df: DataFrame) -> DataFrame:
    """threshold, f1 of the largest F1, the lowest such threshold."""
    f1 = 2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0))
    return curve(df).agg(F.max(F.struct(F.coalesce(f1, F.lit(0.0)).alias("f1"), (-F.col("threshold")).alias("t"))).alias("b")).select(
        (-F.col("b.t")).alias("threshold"), "b.f1"
    )


def precision_targets(df: DataFrame, targets: list[float]) -> DataFrame:
    """For each target the threshold of largest recall with at least that precision, else the best-F1 threshold."""
    goals = df.sparkSession.createDataFrame([(t,) for t in targets], "target double")
    at = curve(df).select("threshold", "precision", "recall")
    # a fixed handful of targets, and one row
    met = at.crossJoin(F.broadcast(goals)).where(F.col("precision") >= F.col("target"))
    best = met.groupBy("target").agg(F.max(F.struct("recall", (-F.col("threshold")).alias("t"))).alias("b"))
    fallback = best_f1(df).select(F.col("threshold").alias("other"))
    return goals.join(best, "target", "left").crossJoin(F.broadcast(fallback)).select(
        "target", F.coalesce(-F.col("b.t"), F.col("other")).alias("threshold"), F.col("b.t").isNotNull().alias("met")
    )


def threshold_sensitivity(df: DataFrame, low: float = 0.05, high: float = 0.99, points: int = 40) -> DataFrame:
    """Confusion counts and ratios at evenly spaced thresholds."""
    spots = df.sparkSession.range(points).select((F.lit(low) + F.col("id") * ((high - low) / (points - 1))).alias("threshold"))
    # a fixed number of thresholds; rows are first summed per score
    summed = df.groupBy("score", "y").agg(F.count("*").alias("n"))
    return confusion(summed.crossJoin(F.broadcast(spots)), F.col("threshold"), ["threshold"], F.col("n"))


#: Distribution function of Poisson(1) at 0 to 6.
POISSON = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183, 0.999916758850712]


def bootstrap_metrics(df: DataFrame, groups: str, replicates: int, seed: int = 42, scores: tuple[str, ...] = ("score",), threshold: float | None = None) -> DataFrame:
    """replicate, model, pr_auc, roc_auc with whole groups drawn anew, and with a threshold also precision, recall and f1 there.

    Rows are summed per group and bin (RANGES of the score, each side of the threshold apart). Every task adds up its groups'
    draws in an array of all replicates for each bin; only these arrays, as many as there are bins, are dealt out and added.
    """
    models = F.explode(F.array(*[F.struct(F.lit(s).alias("model"), F.col(s).alias("score")) for s in scores]))
    hit = F.coalesce(F.col("m.score") >= threshold, F.lit(False)) if threshold is not None else F.lit(False)
    binned = df.select(F.col(groups).cast("string").alias("g"), "y", models.alias("m")).select(
        "g", "m.model", F.col("y").cast("int").alias("y"), F.floor(F.col("m.score") * RANGES).cast("int").alias("bin"), hit.alias("hit")
    )
    summed = binned.repartition("g").groupBy("g", "model", "y", "bin", "hit").agg(F.count("*").alias("n"))
    kind = "model string, y int, bin int, hit boolean, w array<long>"
    drawn = summed.sortWithinPartitions("g").mapInArrow(partial(_drawn, replicates=replicates, seed=seed), kind)
    whole = drawn.groupBy("model", "y", "bin", "hit").applyInArrow(_added, kind)
    rows = whole.select(F.posexplode("w").alias("replicate", "w"), "model", "y", "hit", (F.col("bin") / F.lit(float(RANGES))).alias("score")).where("w > 0")
    by = ["replicate", "model"]
    out = average_precision(rows, by, F.col("w")).join(roc_auc(rows, by, F.col("w")), by)
    if threshold is not None:
        sides = confusion(rows.withColumn("score", F.col("hit").cast("double")), 0.5, by, F.col("w"))
        out = out.join(sides.select(*by, "precision", "recall", "f1"), by)
    return out


def draws(group: str, replicates: int, seed: int) -> np.ndarray:
    """How often a group is drawn in each replicate: Poisson(1) from a hash, so reruns agree."""
    digits = [hashlib.md5(f"{group}|{r}|{seed}".encode()).hexdigest()[:8] for r in range(replicates)]
    return np.searchsorted(POISSON, np.array([int(x, 16) for x in digits]) / 4294967296.0, side="right")


def _drawn(batches: Iterator[pa.RecordBatch], replicates: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Rows (g, model, y, bin, hit, n) in the order of g to sums of n times the draws of g, one for each bin."""
    sums: dict[tuple, np.ndarray] = {}
    last, times = ..., np.zeros(replicates, np.int64)
    for batch in batches:
        for g, *key, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if g != last:
                last, times = g, draws(g or "", replicates, seed)
            if tuple(key) not in sums:
                sums[tuple(key)] = np.zeros(replicates, np.int64)
            sums[tuple(key)] += n * times
    yield _sums(sums)


def _sums(sums: dict[tuple, np.ndarray]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.bool_())
    keys = [pa.array([k[i] for k in sums], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([*keys, pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], ["model", "y", "bin", "hit", "w"])


def _added(rows: pa.Table) -> pa.Table:
    """The sum of one bin's arrays."""
    key = tuple(rows.column(c)[0].as_py() for c in ("model", "y", "bin", "hit"))
    w = rows.column("w").combine_chunks()
    return pa.Table.from_batches([_sums({key: w.flatten().to_numpy().reshape(len(w), -1).sum(axis=0)})])


def interval(values: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """mean, 2.5 % and 97.5 % of a column."""
    return values.groupBy(*(by or [])).agg(
        F.avg(column).alias("mean"), F.percentile(column, F.lit(0.025)).alias("low"), F.percentile(column, F.lit(0.975)).alias("high")
    )


def paired_difference(values: DataFrame, a: str, b: str, column: str) -> DataFrame:
    """Interval and two-sided p of model a less model b over the same replicates."""
    x = values.where(F.col("model") == a).select("replicate", F.col(column).alias("x"))
    y = values.where(F.col("model") == b).select("replicate", F.col(column).alias("y"))
    d = x.join(y, "replicate").select((F.col("x") - F.col("y")).alias("d"))
    side = lambda c: F.avg(c.cast("double"))
    return d.agg(
        F.avg("d").alias("mean"),
        F.percentile("d", F.lit(0.025)).alias("low"),
        F.percentile("d", F.lit(0.975)).alias("high"),
        F.least(F.lit(1.0), 2 * F.least(side(F.col("d") <= 0), side(F.col("d") >= 0))).alias("p_value"),
    )


# Parts of names that mark organisations in errors; each with the blank before it.
ORGANISATION_PARTS = [" LLC", " INC", " HOSP", " HOSPITAL", " CLINIC", " CENTER", " MEDICAL", " GROUP", " ASSOCIATES", " PC", " PLLC"]


def error_bucket() -> Column:
    """The kind of an error from columns b_first, b_last, b_state, b_zip5, b_street1 and x_* with x_org."""
    c = lambda n: F.coalesce(F.col(n), F.lit(""))
    same = lambda f: (c(f"b_{f}") != "") & (c(f"b_{f}") == c(f"x_{f}"))
    name = F.concat(c("x_last"), F.lit(" "), c("x_org"))
    org = F.exists(F.array(*[F.lit(t) for t in ORGANISATION_PARTS]), lambda t: F.contains(name, t))
    whole_name = same("first") & same("last") & same("state")
    return (
        F.when(org & (c("b_first") != ""), "organization_vs_individual")
        .when(same("first") & ~same("last"), "married_or_name_change")
        .when(whole_name & ~(same("zip5") & same("street1")), "multiple_practice_locations")
        .when(whole_name, "same_name_different_person")
        .otherwise("other")
    )


def errors(df: DataFrame, threshold: float) -> DataFrame:
    """False positives and false negatives at a threshold with their bucket."""
    hit = F.col("score") >= threshold
    flagged = df.withColumns({"is_fp": (F.col("y") == 0) & hit, "is_fn": (F.col("y") == 1) & ~hit, "error_bucket": error_bucket()})
    return flagged.where("is_fp OR is_fn")
