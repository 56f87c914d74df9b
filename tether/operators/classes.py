"""Rows of equal values as one class: what holds of the values is computed once, and then listed for the rows.

A class is kept in parts of about MEMBERS rows, so that no array grows with a class; parts are classes of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.io import materialize

#: Rows of a part of a class, about.
MEMBERS = 1000

#: Pairs of rows that are listed at a time, about.
BATCH = 8192


def classes(rows: DataFrame, ids: list[str], side: str) -> DataFrame:
    """<side>_class, the columns but ids, and <side>_rows: an array of structs of ids, repeated rows as often as they come."""
    values = [c for c in rows.columns if c not in ids]
    size = F.count("*").over(W.partitionBy(*values))
    parted = rows.withColumn("__part", F.pmod(F.xxhash64(*ids), F.ceil(size / MEMBERS)))
    grouped = parted.groupBy(*values, "__part").agg(F.collect_list(F.struct(*ids)).alias(f"{side}_rows")).drop("__part")
    return materialize(grouped.withColumn(f"{side}_class", F.monotonically_increasing_id()), f"{side}-classes")


def listed(pairs: DataFrame, left: DataFrame, right: DataFrame, near: tuple[str, ...] = ()) -> DataFrame:
    """pairs (left_class, right_class, ...) as pairs of the rows of these classes: their ids in place of the classes.

    near: columns of pairs whose equal values come in one task, if they are not too many for it, and one after the other. An id
    then is new to few tasks and comes again soon, so that files hold it about once, not once for each pair of classes.
    """
    both = pairs.join(left.select("left_class", "left_rows"), "left_class").join(right.select("right_class", "right_rows"), "right_class")
    # dealt anew, as a row can stand for a million
    parts, order = 8 * pairs.sparkSession.sparkContext.defaultParallelism, [*near, "left_class", "right_class"]
    both = batches(both.repartitionByRange(parts, *order).sortWithinPartitions(*order) if near else both.repartition(parts))
    others = [c for c in pairs.columns if c not in ("left_class", "right_class")]
    ids = []
    for side in ("left", "right"):
        fields = [f.name for f in both.schema[f"{side}_rows"].dataType.elementType.fields]
        if len(fields) == 1:  # plain values need no struct made for each row
            both = both.withColumn(fields[0], F.explode(F.col(f"{side}_rows")[fields[0]]))
            ids += fields
        else:
            both = both.withColumn(f"__{side}", F.explode(f"{side}_rows"))
            ids.append(f"__{side}.*")
    return both.select(*ids, *others)


def batches(pairs: DataFrame) -> DataFrame:
    """pairs with left_rows in slices, so that a row stands for about BATCH pairs (one left row with all right_rows, at least).

    Spark's generated code keeps all rows that come of one input row in memory until it passes them on, and a million of
    them go through the garbage collector more than once. ``transform`` is not part of such code, so the slices do arrive one by one.
    """
    some = F.greatest(F.lit(1), F.floor(BATCH / F.size("right_rows"))).cast("int")
    return pairs.withColumn("left_rows", F.explode(F.transform(F.sequence(F.lit(1), F.size("left_rows"), some), lambda i: F.slice("left_rows", i, some))))


def repeated(rows: DataFrame, id_: str, flag: str) -> DataFrame:
    """rows with ``flag``: whether another row has the same id."""
    return rows.withColumn(flag, F.count("*").over(W.partitionBy(id_)) > 1)
