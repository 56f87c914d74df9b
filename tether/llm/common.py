"""Shared helpers: white space, shared storage, native word counts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import materialize, scratch, shared_dir

__all__ = ["SPACE", "materialize", "n_words", "scratch", "shared_dir", "table", "text_bytes", "texts", "words"]

#: The white space that separates words; everything else belongs to a word.
SPACE = r"[\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """Array of the text's words; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def n_words(text: Column) -> Column:
    """Number of words, as long."""
    return F.size(words(text)).cast("long")


def text_bytes(column: pa.Array) -> Iterator[bytes | None]:
    """The bytes of each text. Spark's strings can hold bytes that are no UTF-8, which Arrow does not turn into text."""
    return (x.as_py() for x in column.cast(pa.binary()))


def texts(column: pa.Array) -> list[str | None]:
    """Each text, with replacement characters for bytes that are no UTF-8."""
    return [x if x is None else x.decode("utf-8", "replace") for x in text_bytes(column)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
