"""Scoring service operators: a table of queries in, matches out. One call serves one record or a million."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from . import blocking, features, learning

# Fields of a query record; profile_id is required.
FIELDS = ["profile_id", "first_name", "last_name", "state", "zip5", "street1", "city", "npi"]


class InvalidRecord(ValueError):
    """A record with unknown fields or without profile_id."""


class NotReady(RuntimeError):
    """Providers or model are missing."""


def records(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A query table of records; unknown fields and missing ids are rejected."""
    for r in rows:
        if unknown := set(r) - set(FIELDS):
            raise InvalidRecord(f"unknown fields: {sorted(unknown)}")
        if not str(r.get("profile_id") or "").strip():
            raise InvalidRecord("profile_id is required")
    return spark.createDataFrame([tuple(r.get(f) for f in FIELDS) for r in rows], ", ".join(f"{f} string" for f in FIELDS))


def health(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit("ok").alias("status"))


def match(queries: DataFrame, providers: DataFrame, weights: DataFrame, model: Model | None = None, top: int = 5) -> DataFrame:
    """The best candidates of every query by probability and then similarity, at most ``top`` each.

    Candidates come from tiered blocks; if the query is a person, candidates that conflict as organisations are dropped.
    Without a model the name similarity is the probability.
    """
    if queries is None or providers is None:
        raise NotReady("providers are not loaded")
    q = queries.select(F.col("profile_id").alias("query_id"), "*")
    p = providers.select(F.col("npi").alias("id"), "*")
    pairs = (
        blocking.tiered_block(q, p)
        .join(q.select("query_id", *[F.col(a).alias(f"b_{b}") for a, b in (("first_name", "first"), ("last_name", "last"), ("street1", "street1"), ("city", "city"), ("state", "state"), ("zip5", "zip5"))]), "query_id")
        .join(p.select("id", *[F.col(a).alias(f"x_{b}") for a, b in (("first_name", "first"), ("last_or_org_name", "last"), ("street1", "street1"), ("city", "city"), ("state", "state"), ("zip5", "zip5"), ("credentials", "cred"))]), "id")
    )
    rows = features.feature_rows(pairs, weights)
    full = F.concat_ws(" ", F.coalesce("b_first", F.lit("")), F.coalesce("b_last", F.lit("")))
    person = (T.is_org_like(F.coalesce("b_last", F.lit(""))) == 0) & (T.is_org_like(full) == 0)
    fair = rows.where(~person | (F.col("org_vs_person_conflict") == 0))
    scored = learning.predict(model, fair) if model is not None else fair.withColumn("score", F.col("sim_jw_fullname"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.desc("sim_jw_fullname"), "id")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.select(
        F.col("query_id").alias("profile_id"),
        F.col("id").alias("candidate_npi"),
        F.col("x_first").alias("candidate_first_name"),
        F.col("x_last").alias("candidate_last_or_org_name"),
        F.col("x_state").alias("candidate_state"),
        F.col("x_zip5").alias("candidate_zip5"),
        F.col("sim_jw_fullname").alias("similarity_score"),
        F.col("score").alias("match_probability"),
        "rank",
    )


def stats(providers: DataFrame, candidates: DataFrame, metrics: dict[str, float]) -> DataFrame:
    """One row: numbers of providers and candidates, and the given metrics."""
    n = providers.agg(F.count("*").alias("n_providers")).crossJoin(candidates.agg(F.count("*").alias("n_candidates")))  # two single rows
    return n.withColumns({k: F.lit(float(v)) for k, v in metrics.items()})
