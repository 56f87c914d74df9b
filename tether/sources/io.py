"""Readers and writers of the pipeline's tables."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import materialize as materialize
from .shared import scratch as scratch

#: A null marker that no file holds, so that quoted empty fields stay empty text and unquoted ones become null.
_NO_NULL = "\u0000"


def read_csv(spark: SparkSession, path: str, columns: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """A CSV file with header, all columns read as text (ids keep their zeros), then cast; cells that do not fit are null.

    Bytes that are no UTF-8 become replacement characters.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    raw = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("encoding", "UTF-8").option("nullValue", _NO_NULL).csv(path)
    return raw.withColumns({c: F.col(c).try_cast(t) for c, t in (types or {}).items()})


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def schema_of(spark: SparkSession, path: str) -> DataFrame:
    """position, name, type of the columns; reads no rows."""
    rows = [(i, n, t) for i, (n, t) in enumerate(spark.read.parquet(path).dtypes)]
    return spark.createDataFrame(rows, "position int, name string, type string")


def count_rows(spark: SparkSession, path: str) -> DataFrame:
    """n, from the files' footers and without any column."""
    return spark.read.parquet(path).select(F.lit(1).alias("one")).agg(F.count("*").alias("n"))


def read_json_config(path: str) -> dict:
    """The object in a JSON file; {} if it is missing or no JSON."""
    try:
        return json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return {}


def frame(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A DataFrame of rows; the schema holds for no rows too."""
    return spark.createDataFrame(rows, schema)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with header; one_file is for small reports."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
