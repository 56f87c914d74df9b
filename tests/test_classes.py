"""Queries of pairs on tables of many equal rows: the work is that of the distinct ones, the result is whole."""

import threading

import duckdb
import pytest
from pyspark.sql import functions as F

from tether.operators import blocking, classes, features
from tether.plans import catalogue, linking, roles

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def copies(tmp_path_factory):
    """Twelve copies of 60 parts with keys of their own, and one part's key once more with another size."""
    folder = tmp_path_factory.mktemp("copies")
    c = duckdb.connect()
    c.execute(f"""COPY (WITH p AS (SELECT * FROM '/root/testdata/sf0.001/part.parquet' WHERE p_partkey < 60)
      SELECT (p_partkey + 60 * k)::BIGINT AS p_partkey, p.* EXCLUDE (p_partkey) FROM p, range(12) r(k)
      UNION ALL SELECT * REPLACE ((p_size + 1)::INTEGER AS p_size) FROM p WHERE p_partkey IN (7, 8)
      UNION ALL SELECT * FROM p WHERE p_partkey IN (9, 10)) TO '{folder}/part.parquet' (FORMAT parquet)""")
    c.execute(f"CREATE VIEW part AS SELECT * FROM '{folder}/part.parquet'")
    return str(folder), c


def rows_of(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["ft_10", "ft_6_7", "ft_9", "ft_20_25", "ft_33", "api_3", "sim_8"])
def test_equal_rows(spark, copies, monkeypatch, name):
    folder, duck = copies
    seen, own = [], features.with_vectors
    monkeypatch.setattr(features, "with_vectors", lambda pairs, *a: seen.append(pairs.count()) or own(pairs, *a))
    got = QUERIES[name](spark, folder)
    want = duck.execute(SQL[name])
    columns = [x[0] for x in want.description]
    expected = sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in want.fetchall()), key=repr)
    assert rows_of(got.select(*columns)) == expected
    # twelve copies on either side make 144 pairs of one
    assert all(n * 20 < len(expected) for n in seen)


@pytest.mark.parametrize("name", ["jn_9", "blk_4h", "blk_4"])
def test_equal_token_sets(spark, copies, monkeypatch, name):
    folder, duck = copies
    seen, own = [], blocking.class_overlaps
    monkeypatch.setattr(blocking, "class_overlaps", lambda *a: seen.append(own(*a).count()) or own(*a))
    got = QUERIES[name](spark, folder)
    want = duck.execute(SQL[name])
    columns = [x[0] for x in want.description]
    expected = sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in want.fetchall()), key=repr)
    assert rows_of(got.select(*columns)) == expected
    assert seen and seen[0] * 20 < len(expected)


def test_zips_are_distinct_before_they_meet(spark, copies):
    plan = QUERIES["sim_8"](spark, copies[0])._jdf.queryExecution().optimizedPlan().toString()
    assert plan[plan.index("Join") :].count("Aggregate") == 2


def test_classes_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(classes, "MEMBERS", 10)
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("v"))
    parts = classes.classes(rows, ["k"], "left")
    assert 5 < parts.count() <= 10
    assert sorted(x.k for r in parts.collect() for x in r.left_rows) == list(range(100))


@pytest.mark.parametrize("ids", [["left_id"], ["left_id", "left_npi"]])
def test_pairs_are_listed_in_batches(spark, monkeypatch, ids):
    """A slice of left rows, and no more, comes to the code that keeps its pairs in memory."""
    monkeypatch.setattr(classes, "BATCH", 100)
    rows = spark.range(90).selectExpr("nullif(id, 7) AS left_id", "nullif(id % 40, 3) AS left_npi", "id % 40 = 0 AS v").select(*ids, "v")
    theirs = spark.range(57).selectExpr("id AS right_id", "id < 50 AS w")
    a, b = classes.classes(rows, ids, "left"), classes.classes(theirs, ["right_id"], "right")
    met = a.select("left_class", "v").crossJoin(b.select("right_class", "w"))
    seen, own = [], classes.batches
    monkeypatch.setattr(classes, "batches", lambda pairs: seen.append(own(pairs)) or seen[-1])
    got = classes.listed(met, a, b)
    assert rows_of(got) == rows_of(rows.crossJoin(theirs).select(*ids, "right_id", "v", "w"))
    sizes = seen[0].select(F.size("left_rows").alias("n"), F.size("right_rows").alias("m")).collect()
    assert max(r.n * r.m for r in sizes) <= 100 and {r.n for r in sizes if r.m == 50} == {1, 2}
    # the slices are made outside of generated code: a generated stage of their own would pass on all pairs of a class at once
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "explode(transform" in plan


def test_rows_of_all_features_come_near_each_other(spark, copies):
    """ft_all lists all pairs, and an id's rows in a few tasks, where they take little room."""
    folder, duck = copies
    got = QUERIES["ft_all"](spark, folder)
    assert rows_of(got.select("left_id", "right_id", "left_npi", "x_cred", "b_n_years")) == rows_of(roles.role(spark, folder, roles.PAIRS).select("left_id", "right_id", "left_npi", "x_cred", "b_n_years"))
    spread = got.select("right_id", F.spark_partition_id().alias("task")).groupBy("right_id").agg(F.count("*").alias("n"), F.countDistinct("task").alias("tasks")).collect()
    assert max(r.n for r in spread) >= 12 and sum(r.tasks for r in spread) <= 2 * len(spread)


@pytest.fixture(scope="module")
def mirrored(tmp_path_factory):
    """Equal parts on both sides: twelve copies of 40, 420 copies of two (more than the first right ids of a bucket), and keys that come twice."""
    folder = tmp_path_factory.mktemp("mirrored")
    c = duckdb.connect()
    c.execute(f"""COPY (WITH p AS (SELECT * FROM '/root/testdata/sf0.001/part.parquet' WHERE p_partkey < 40)
      SELECT (p_partkey + 41 * k)::BIGINT AS p_partkey, p.* EXCLUDE (p_partkey) FROM p, range(12) r(k)
      UNION ALL SELECT (1000 + p_partkey + 3 * k)::BIGINT AS p_partkey, p.* EXCLUDE (p_partkey) FROM p, range(420) r(k) WHERE p_partkey < 2
      UNION ALL SELECT * REPLACE ((p_partkey + 41)::BIGINT AS p_partkey) FROM p WHERE p_partkey < 9
      UNION ALL SELECT * FROM p WHERE p_partkey IN (9, 10)) TO '{folder}/part.parquet' (FORMAT parquet)""")
    c.execute(f"CREATE VIEW part AS SELECT * FROM '{folder}/part.parquet'")
    return str(folder), c


@pytest.mark.parametrize("table", ["copies", "mirrored"])
@pytest.mark.parametrize("name", ["blk_6", "blk_5"])
def test_candidates_of_equal_rows(spark, request, monkeypatch, name, table):
    folder, duck = request.getfixturevalue(table)
    seen, deduped, listed = [], blocking.dedupe, blocking._listed_left
    if name == "blk_6":
        monkeypatch.setattr(blocking, "dedupe", lambda pairs, *a: seen.append(pairs.count()) or deduped(pairs, *a))
    else:
        monkeypatch.setattr(blocking, "_listed_left", lambda rows, left: seen.append(rows.count()) or listed(rows, left))
    got = QUERIES[name](spark, folder)
    want = duck.execute(SQL[name])
    columns = [x[0] for x in want.description]
    expected = sorted(want.fetchall(), key=repr)
    assert rows_of(got.select(*columns)) == expected
    assert name == "blk_5" and table == "copies" or len(expected) > 1000
    # equal left rows are one
    assert seen and all(n * 3 < len(expected) or not n for n in seen)


def test_passes_share_their_classes(spark, mirrored, monkeypatch):
    """orc_2 and agg_22 make the token classes of a side once, and count every pass's pairs whole."""
    folder, duck = mirrored
    seen, own = [], blocking.token_classes
    monkeypatch.setattr(blocking, "token_classes", lambda rows, side: seen.append(side) or own(rows, side))
    got = {r["pass"]: r["count"] for r in linking.all_candidates(spark, folder).groupBy("pass").count().collect()}
    assert seen == ["left", "right"]
    want = dict(duck.execute(f"SELECT pass, count(*) FROM ({linking.UNION_SQL}) u GROUP BY pass").fetchall())
    assert got == want | dict(duck.execute(f"SELECT pass, count(*) FROM ({SQL['blk_1']}) u GROUP BY pass").fetchall())  # distinct pairs


def test_lsh_crowds_count_rows(spark):
    """A class counts as many rows as it has, or as their sizes say."""
    rows = lambda n: spark.range(n).selectExpr("cast(id as string) id", "'S' state", "array('a', 'b', 'c') tokens")
    found = lambda left, right: blocking.lsh_pairs(left, right, crowded=6).count()
    assert [found(rows(6), rows(6)), found(rows(7), rows(6)), found(rows(6), rows(7))] == [36, 0, 0]
    sized = rows(2).withColumn("size", F.col("id").cast("long") + 3)
    assert [found(sized, rows(6)), found(sized.where("id = 1"), rows(6))] == [0, 6]


def test_preparation_of_pairs(spark, copies, monkeypatch):
    """The table is opened once, a side is dealt by id once, the classes of both sides are made at the same time, and only the features asked for are built."""
    opened, table = [], roles.table
    for module in (roles, linking):
        monkeypatch.setattr(module, "table", lambda *a: opened.append(a[2]) or table(*a))
    both, made, own = threading.Barrier(2, timeout=60), [], classes.classes

    def meet(rows, *a):
        made.append(rows)
        both.wait()
        return own(rows, *a)

    monkeypatch.setattr(classes, "classes", meet)
    monkeypatch.setattr(features.S, "overlap_ratio", lambda *a: pytest.fail("not asked for"))
    folder, duck = copies
    assert QUERIES["ft_33"](spark, folder).count() == len(duck.execute(SQL["ft_33"]).fetchall())
    assert opened == ["part"]
    assert [rows._jdf.queryExecution().executedPlan().toString().count("Exchange ") for rows in made] == [1, 1]
