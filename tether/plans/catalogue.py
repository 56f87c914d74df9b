"""All queries over the test tables, each with its SQL oracle where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import similarity as S
from . import analysis, linking, relational

MODULES = (relational, linking, analysis)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"flagship": flagship} | {name: q for m in MODULES for name, q in m.R.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {"flagship": FLAGSHIP} | {name: q for m in MODULES for name, q in m.R.sql.items()}


_B, _X = "(l.first_name || ' ' || l.last_name)", "(r.first_name || ' ' || r.last_or_org_name)"
FLAGSHIP = f"""SELECT left_id, right_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY score DESC, right_id)::INTEGER AS rank FROM
 (SELECT left_id, right_id, round(({linking.jaccard_sql(linking.set_sql(_B), linking.set_sql(_X))} + {linking.lev_sql(_B, _X)}) / 2, 9) AS score FROM ({linking.STATE_ZIP}) c
 JOIN ({linking.LEFT}) l ON c.left_id = l.profile_id JOIN ({linking.RIGHT}) r ON c.right_id = r.npi) s) t WHERE rank <= 5"""


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalise, block by state and zip in capped blocks, score names, and rank the five best candidates of each left id."""
    kept = linking.blk_2a(spark, sf_dir)
    left = linking.left(spark, sf_dir).select(F.col("profile_id").alias("left_id"), F.concat_ws(" ", "first_name", "last_name").alias("b"))
    right = linking.right(spark, sf_dir).select(F.col("npi").alias("right_id"), F.concat_ws(" ", "first_name", "last_or_org_name").alias("x"))
    pairs = kept.join(left, "left_id").join(right, "right_id")
    score = F.round((S.token_jaccard(F.col("b"), F.col("x")) + S.lev_sim(F.col("b"), F.col("x"))) / 2, 9)
    order = W.partitionBy("left_id").orderBy(F.desc("score"), "right_id")
    ranked = pairs.withColumn("score", score).withColumn("rank", F.row_number().over(order))
    return ranked.where("rank <= 5").select("left_id", "right_id", "score", "rank")
