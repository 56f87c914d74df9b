"""From raw rows to one row per entity, with null-aware counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by(order: Column, *columns: str) -> list[Column]:
    """Each column of the first row by ``order``, nulls included, in one aggregate (no dependence on row order)."""
    row = F.min_by(F.struct(*columns), order)
    return [row[c].alias(c) for c in columns]


def n_unique(c: str | Column) -> Column:
    """Distinct values, where null counts as a value."""
    col = F.col(c) if isinstance(c, str) else c
    return (F.count_distinct(col) + F.coalesce(F.max(col.isNull().cast("int")), F.lit(0))).cast("long")


def total(c: str) -> Column:
    """Sum with 0 for groups without values."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def resolve(rows: DataFrame, key: str, order: Column, first: list[str], sums: dict[str, str], means: dict[str, str], uniques: dict[str, str], n_rows: str | None = None) -> DataFrame:
    """One row per non-null key: first values, sums, means, distinct counts and the number of rows, by output name."""
    aggs = [
        *first_by(order, *first),
        *[total(c).alias(n) for n, c in sums.items()],
        *[F.avg(c).alias(n) for n, c in means.items()],
        *[n_unique(c).alias(n) for n, c in uniques.items()],
    ]
    if n_rows:
        aggs.append(F.count("*").alias(n_rows))
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
