"""Queries of sources, sinks, projections, filters, joins, set operations, sorts and limits."""

from __future__ import annotations

import io
import json
from pathlib import Path

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import blocking, evaluate, features, learning, profile
from ..sources import io as IO
from . import roles
from .registry import Registry
from .roles import table

R = Registry()

# ---- sources and sinks


@R.add("src_1", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(spark, d):
    path = IO.scratch(spark)
    IO.write_csv(table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return IO.read_csv(spark, path, ["c_custkey", "c_name", "c_acctbal"], {"c_custkey": "bigint", "c_acctbal": "double"})


@R.add("src_2", "SELECT n_nationkey, 'é' || n_name AS n_name FROM nation")
def _(spark, d):
    path = IO.scratch(spark)
    IO.write_csv(table(spark, d, "nation").select("n_nationkey", F.concat(F.lit("é"), "n_name").alias("n_name")), path)
    return IO.read_csv(spark, path, ["n_nationkey", "n_name"], {"n_nationkey": "int"})


@R.add("src_3", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def _(spark, d):
    return IO.read_parquet(spark, f"{d}/orders.parquet", ["o_orderkey", "o_totalprice"]).where("o_totalprice > 300000")


@R.add("src_4", "SELECT * FROM (VALUES (0, 'n_nationkey', 'int'), (1, 'n_name', 'string'), (2, 'n_regionkey', 'int')) t(position, name, type)")
def _(spark, d):
    return IO.schema_of(spark, f"{d}/nation.parquet")


@R.add("src_5", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49")
def _(spark, d):
    return table(spark, d, "lineitem").where("l_returnflag = 'R' AND l_quantity >= 49").select("l_orderkey", "l_quantity")


@R.add("src_6", "SELECT count(*) AS n FROM lineitem")
def _(spark, d):
    return IO.count_rows(spark, f"{d}/lineitem.parquet")


@R.add("src_7", "SELECT * FROM (VALUES ('best_f1', 0.47), ('missing', -1.0)) t(key, value)")
def _(spark, d):
    import tempfile

    with tempfile.TemporaryDirectory() as folder:  # the configuration is the driver's own file
        path = Path(folder) / "thresholds.json"
        path.write_text(json.dumps({"best_f1": 0.47}))
        found = IO.read_json_config(str(path)) | IO.read_json_config(str(Path(folder) / "none.json"))
    return IO.frame(spark, [("best_f1", found["best_f1"]), ("missing", found.get("missing", -1.0))], "key string, value double")


@R.add("src_8")
def _(spark, d):
    rows = roles.role(spark, d, roles.SCORED)
    model = Pipeline(stages=[VectorAssembler(inputCols=["score", "score_b"], outputCol="features"), LogisticRegression(labelCol="y", maxIter=10)]).fit(rows)
    path = IO.scratch(spark)
    IO.save_model(model, path)
    kept = rows.withColumnRenamed("score", "score_a").withColumnRenamed("score_a", "score")
    again = IO.load_model(path).transform(kept).select("doc_id", F.col("prediction"))
    return again


@R.add("src_9", "SELECT * FROM (VALUES ('a', 1), ('b', 2)) t(k, n)")
def _(spark, d):
    empty = IO.frame(spark, [], "k string, n int")
    return empty.unionByName(IO.frame(spark, [("a", 1), ("b", 2)], "k string, n int"))


@R.add("src_10", "SELECT r_regionkey, r_name FROM region")
def _(spark, d):
    return spark.createDataFrame(table(spark, d, "region").select("r_regionkey", "r_name").toPandas(), "r_regionkey int, r_name string")


@R.add("snk_1", "SELECT s_suppkey, s_acctbal FROM supplier")
def _(spark, d):
    path = IO.scratch(spark)
    IO.write_parquet(table(spark, d, "supplier").select("s_suppkey", "s_acctbal"), path)
    return IO.read_parquet(spark, path)


@R.add("snk_2", "SELECT s_suppkey, s_name FROM supplier")
def _(spark, d):
    path = IO.scratch(spark)
    IO.write_csv(table(spark, d, "supplier").select("s_suppkey", "s_name"), path, one_file=True)
    return IO.read_csv(spark, path, ["s_suppkey", "s_name"], {"s_suppkey": "bigint"})


@R.add("snk_3", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, d):
    path = IO.scratch(spark)
    IO.write_json(table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n")), path)
    return spark.read.schema("event_type string, n long").json(path)


@R.add("snk_4", """SELECT CASE WHEN o_totalprice < 0 THEN 0 WHEN o_totalprice >= 500000 THEN 21
  ELSE CAST(floor(o_totalprice / 25000) AS INTEGER) + 1 END AS bin, count(*) AS n FROM orders GROUP BY 1""")
def _(spark, d):
    return profile.histogram(table(spark, d, "orders"), "o_totalprice", 0.0, 500_000.0, 20)


@R.add("snk_5", "SELECT 'orders: ' || count(*) AS line FROM orders")
def _(spark, d):
    out = io.StringIO()
    print(f"orders: {table(spark, d, 'orders').count()}", file=out)
    return IO.frame(spark, [(x,) for x in out.getvalue().splitlines()], "line string")


# ---- projections


@R.add("prj_1", "SELECT c_custkey AS id, c_name AS name FROM customer")
def _(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


@R.add("prj_2", "SELECT s_suppkey, upper(s_name) AS s_name, s_acctbal * 2 AS twice FROM supplier")
def _(spark, d):
    return table(spark, d, "supplier").withColumns({"s_name": F.upper("s_name"), "twice": F.col("s_acctbal") * 2}).select("s_suppkey", "s_name", "twice")


@R.add("prj_3", "SELECT n_nationkey, n_name FROM nation")
def _(spark, d):
    return table(spark, d, "nation").drop("n_regionkey")


@R.add("prj_4", "SELECT r_regionkey AS region_id, r_name FROM region")
def _(spark, d):
    return table(spark, d, "region").select("r_regionkey", "r_name").withColumnRenamed("r_regionkey", "region_id")


@R.add("prj_5", "SELECT r_regionkey, 'BA' AS pair_type, CAST(NULL AS VARCHAR) AS block_key FROM region")
def _(spark, d):
    return table(spark, d, "region").select("r_regionkey", F.lit("BA").alias("pair_type"), F.lit(None).cast("string").alias("block_key"))


@R.add("prj_6", "SELECT p_partkey, TRY_CAST(p_brand AS INTEGER) AS bad, TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", F.col("p_brand").try_cast("int").alias("bad"), F.substring("p_brand", 7, 9).try_cast("int").alias("brand"))


@R.add("prj_7", f"SELECT profile_id, coalesce(zip5, '') AS zip5, coalesce(street1, '?') AS street1 FROM ({roles.LEFT}) t")
def _(spark, d):
    return roles.role(spark, d, roles.LEFT).select("profile_id", "zip5", "street1").fillna({"zip5": "", "street1": "?"})


@R.add("prj_8", f"SELECT profile_id, coalesce(zip5, street1, city) AS place FROM ({roles.LEFT}) t")
def _(spark, d):
    return roles.role(spark, d, roles.LEFT).select("profile_id", F.coalesce("zip5", "street1", "city").alias("place"))


@R.add("prj_9", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(spark, d):
    packed = table(spark, d, "supplier").select("s_suppkey", F.struct("s_name", "s_acctbal").alias("feat"))
    return packed.select("s_suppkey", "feat.*")


@R.add("prj_10", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@R.add("prj_11", "SELECT p_partkey, p_size, p_retailprice FROM part")
def _(spark, d):
    df = table(spark, d, "part")
    return df.select(*profile.numeric_columns(df))


@R.add("prj_12", "SELECT n_nationkey, n_name FROM nation")
def _(spark, d):
    df = table(spark, d, "nation")
    return df.select(*[c for c in ("n_nationkey", "n_name", "no_such_column") if c in df.columns])


@R.add("prj_13", "SELECT c_custkey AS k, c_acctbal AS bal, NULL::VARCHAR AS s FROM customer UNION ALL SELECT s_suppkey, NULL, s_name FROM supplier")
def _(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("s"))
    return a.unionByName(b, allowMissingColumns=True)


@R.add("prj_14", "SELECT n_nationkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS row_id, n_regionkey FROM nation")
def _(spark, d):
    rank = F.row_number().over(W.partitionBy("n_regionkey").orderBy("n_nationkey")) - 1
    return table(spark, d, "nation").select("n_nationkey", rank.cast("long").alias("row_id"), "n_regionkey")


@R.add("prj_15", f"SELECT left_id, right_id, CASE WHEN left_npi IS NULL THEN NULL WHEN left_npi = right_id THEN 1 ELSE 0 END AS label FROM ({roles.PAIRS}) t")
def _(spark, d):
    return roles.role(spark, d, roles.PAIRS).select("left_id", "right_id", features.weak_label(F.col("left_npi"), F.col("right_id")).alias("label"))


_ORG = " OR ".join(f"contains(upper(coalesce(x_last, '')) || ' ', '{t}')" for t in evaluate.ORGANISATION_PARTS)
_SAME = lambda f: f"(coalesce(b_{f}, '') <> '' AND b_{f} IS NOT DISTINCT FROM x_{f})"
BUCKET_SQL = f"""CASE WHEN ({_ORG}) AND coalesce(b_first, '') <> '' THEN 'organization_vs_individual'
  WHEN {_SAME('first')} AND NOT {_SAME('last')} THEN 'married_or_name_change'
  WHEN {_SAME('first')} AND {_SAME('last')} AND {_SAME('state')} AND NOT ({_SAME('zip5')} AND {_SAME('street1')}) THEN 'multiple_practice_locations'
  WHEN {_SAME('first')} AND {_SAME('last')} AND {_SAME('state')} THEN 'same_name_different_person' ELSE 'other' END"""
UPPER_PAIRS = f"SELECT * REPLACE (upper(b_last) AS b_last, upper(x_last) AS x_last) FROM ({roles.PAIRS}) t"


def upper_pairs(spark, d):
    return roles.role(spark, d, roles.PAIRS).withColumns({"b_last": F.upper("b_last"), "x_last": F.upper("x_last"), "x_org": F.lit("")})


@R.add("prj_16", f"SELECT left_id, right_id, {BUCKET_SQL} AS error_bucket FROM ({UPPER_PAIRS}) u")
def _(spark, d):
    return upper_pairs(spark, d).select("left_id", "right_id", evaluate.error_bucket().alias("error_bucket"))


# ---- filters


@R.add("flt_1", f"SELECT profile_id FROM ({roles.LEFT}) t WHERE npi IS NOT NULL AND zip5 IS NULL")
def _(spark, d):
    return roles.role(spark, d, roles.LEFT).where(F.col("npi").isNotNull() & F.col("zip5").isNull()).select("profile_id")


@R.add("flt_2", """SELECT p_partkey FROM part WHERE (p_size > 10 AND NOT p_type = 'SMALL') OR ((p_size = 5) <> (p_brand = 'Brand#4'))""")
def _(spark, d):
    small, brand = F.col("p_type") == "SMALL", F.col("p_brand") == "Brand#4"
    return table(spark, d, "part").where(((F.col("p_size") > 10) & ~small) | ((F.col("p_size") == 5) != brand)).select("p_partkey")


@R.add("flt_3", f"SELECT profile_id, k FROM (SELECT profile_id, coalesce(zip5, '') || '|' || coalesce(street1, '') AS k FROM ({roles.LEFT}) t) u WHERE length(k) > 1")
def _(spark, d):
    keyed = roles.role(spark, d, roles.LEFT).select("profile_id", T.block_key(F.col("zip5"), F.col("street1")).alias("k"))
    return keyed.where(F.length("k") > 1)


@R.add("flt_4", f"SELECT npi FROM ({roles.RIGHT}) t WHERE starts_with(zip5, '10')")
def _(spark, d):
    return roles.role(spark, d, roles.RIGHT).where(F.col("zip5").startswith("10")).select("npi")


@R.add("flt_5", f"SELECT npi FROM ({roles.RIGHT}) t WHERE contains(upper(last_or_org_name), ' MEDICAL') OR contains(upper(last_or_org_name), ' GROUP')")
def _(spark, d):
    parts = F.array(*[F.lit(x) for x in (" MEDICAL", " GROUP")])
    name = F.upper("last_or_org_name")
    return roles.role(spark, d, roles.RIGHT).where(F.exists(parts, lambda x: F.contains(name, x))).select("npi")


@R.add("flt_6", f"SELECT doc_id FROM ({roles.SCORED}) t WHERE pair_type = 'en' AND score >= 0.5")
def _(spark, d):
    return roles.role(spark, d, roles.SCORED).where((F.col("pair_type") == "en") & (F.col("score") >= 0.5)).select("doc_id")


@R.add("flt_7", "SELECT p_type, count(*) AS n FROM part GROUP BY p_type HAVING count(*) >= 10")
def _(spark, d):
    return table(spark, d, "part").groupBy("p_type").agg(F.count("*").alias("n")).where("n >= 10")


# ---- joins


@R.add("jn_1", "SELECT DISTINCT o_custkey AS npi FROM orders JOIN customer ON o_custkey = c_custkey")
def _(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("npi")).join(
        table(spark, d, "orders").select(F.col("o_custkey").alias("npi")), "npi", "left_semi"
    )


@R.add("jn_2", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def _(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name")


_KEY = "coalesce(state, '') || '|' || coalesce(zip5, '')"


@R.add("jn_3", f"SELECT profile_id AS left_id, r.npi AS right_id, 'state_zip' AS pass, l.k AS block_key FROM (SELECT *, {_KEY} AS k FROM ({roles.LEFT}) t) l JOIN (SELECT *, {_KEY} AS k FROM ({roles.RIGHT}) t) r ON l.k = r.k")
def _(spark, d):
    key = T.block_key(F.col("state"), F.col("zip5"))
    return blocking.capped_block(roles.role(spark, d, roles.LEFT), roles.role(spark, d, roles.RIGHT), "profile_id", "npi", key, key, "state_zip", None)


@R.add("jn_4", "SELECT o_orderkey, n_orders FROM orders JOIN (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY 1 HAVING count(*) <= 15) s ON o_custkey = k")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    sizes = o.groupBy("o_custkey").agg(F.count("*").alias("n_orders")).where("n_orders <= 15")
    return o.join(sizes, "o_custkey").select("o_orderkey", "n_orders")


@R.add("jn_5", "SELECT c_custkey, o_orderkey FROM customer JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) o ON c_custkey = o_custkey WHERE r <= 3")
def _(spark, d):
    rank = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    first = table(spark, d, "orders").select("o_custkey", "o_orderkey").withColumn("r", rank).where("r <= 3")
    return table(spark, d, "customer").join(first, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "o_orderkey")


@R.add("jn_6", "SELECT l_orderkey, l_linenumber, o_custkey, c_name FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey")
def _(spark, d):
    line, o, c = table(spark, d, "lineitem"), table(spark, d, "orders"), table(spark, d, "customer")
    return line.join(o, line.l_orderkey == o.o_orderkey, "left").join(c, o.o_custkey == c.c_custkey, "left").select("l_orderkey", "l_linenumber", "o_custkey", "c_name")


@R.add("jn_7", f"SELECT doc_id, y, d.lang FROM ({roles.SCORED}) s LEFT JOIN (SELECT doc_id AS k, lang FROM documents WHERE lang <> 'en') d ON s.doc_id = d.k WHERE y = 0")
def _(spark, d):
    docs = table(spark, d, "documents").where("lang <> 'en'").select("doc_id", "lang")
    return roles.role(spark, d, roles.SCORED).where("y = 0").join(docs, "doc_id", "left").select("doc_id", "y", "lang")


@R.add("jn_8", "SELECT o_orderkey, o_totalprice FROM orders JOIN (SELECT o_orderkey AS k FROM orders ORDER BY md5(o_orderkey::VARCHAR || '|42'), k LIMIT 100) s ON o_orderkey = k")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return o.join(learning.sample_rows(o.select("o_orderkey"), 100, "o_orderkey"), "o_orderkey")


_SIDE = lambda rows, key, last: f"SELECT {key} AS id, state, list_distinct(list_filter(list_transform(string_split(upper(first_name || ' ' || {last} || ' ' || state || ' ' || p_brand), ' '), lambda x: regexp_replace(x, '[^A-Z0-9]', '', 'g')), lambda x: x <> '')) AS tokens FROM ({rows}) t"
LEFT_TOKENS, RIGHT_TOKENS = _SIDE(roles.LEFT, "profile_id", "last_name"), _SIDE(roles.RIGHT, "npi", "last_or_org_name")
JACCARD_SQL = f"""SELECT l.id AS left_id, r.id AS right_id, l.state AS state,
  len(list_intersect(l.tokens, r.tokens)) / (len(l.tokens) + len(r.tokens) - len(list_intersect(l.tokens, r.tokens))) AS sim
  FROM ({LEFT_TOKENS}) l JOIN ({RIGHT_TOKENS}) r ON l.state = r.state"""


def token_sides(spark, d, sides=None):
    """(id, state, tokens) of both sides, read anew without ``sides``; tokens from name, state and brand. One small file is dealt over all cores."""
    cores = spark.sparkContext.defaultParallelism
    both = sides or [roles.role(spark, d, rows).repartition(cores) for rows in (roles.LEFT, roles.RIGHT)]
    side = lambda rows, key, last: rows.select(
        F.col(key).alias("id"), "state", T.block_tokens(F.concat_ws(" ", "first_name", last, "state", "p_brand")).alias("tokens")
    )
    return side(both[0], "profile_id", "last_name"), side(both[1], "npi", "last_or_org_name")


@R.add("jn_9", f"SELECT left_id, right_id, round(sim, 9) AS sim FROM ({JACCARD_SQL}) t WHERE sim >= 0.6")
def _(spark, d):
    return blocking.token_overlaps(*token_sides(spark, d), 0.6).select("left_id", "right_id", F.round("sim", 9).alias("sim"))


@R.add("jn_11", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def _(spark, d):
    some = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(some, "c_custkey", "left_semi").select("c_custkey")


# ---- sorts, limits and sets


@R.add("top_1", "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier ORDER BY s_nationkey DESC NULLS FIRST, s_acctbal DESC NULLS FIRST, s_suppkey LIMIT 20")
def _(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal").orderBy(
        F.col("s_nationkey").desc_nulls_first(), F.col("s_acctbal").desc_nulls_first(), "s_suppkey"
    ).limit(20)


@R.add("top_2", "SELECT n_nationkey, n_name FROM nation ORDER BY n_name")
def _(spark, d):
    return table(spark, d, "nation").select("n_nationkey", "n_name").orderBy("n_name")


@R.add("top_3", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 10")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey").orderBy("o_orderkey").limit(10)


@R.add("top_4", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) t WHERE r <= 2")
def _(spark, d):
    rank = F.row_number().over(W.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return table(spark, d, "orders").withColumn("r", rank).where("r <= 2").select("o_custkey", "o_orderkey")


@R.add("top_5", "SELECT grp, doc_id, r::INTEGER AS r FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, score_b DESC, doc_id) AS r FROM (" + roles.SCORED + ") s) t WHERE r <= 5")
def _(spark, d):
    rank = F.row_number().over(W.partitionBy("grp").orderBy(F.desc("score"), F.desc("score_b"), "doc_id"))
    return roles.role(spark, d, roles.SCORED).withColumn("r", rank).where("r <= 5").select("grp", "doc_id", "r")


@R.add("top_6", f"SELECT doc_id, score FROM ({roles.SCORED}) t ORDER BY abs(score - 0.5), doc_id LIMIT 25")
def _(spark, d):
    return learning.uncertain(roles.role(spark, d, roles.SCORED), 25, "doc_id").select("doc_id", "score")


@R.add("top_8", f"""SELECT pair_type, max(score) AS score, arg_min(doc_id, (-score, doc_id)) AS doc_id FROM ({roles.SCORED}) t GROUP BY pair_type""")
def _(spark, d):
    best = F.max_by("doc_id", F.struct("score", -F.col("doc_id")))
    return roles.role(spark, d, roles.SCORED).groupBy("pair_type").agg(F.max("score").alias("score"), best.alias("doc_id"))


@R.add("set_1", "SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def _(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return a.unionByName(table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")))


@R.add("set_2", "SELECT n_nationkey::BIGINT AS k FROM nation UNION ALL SELECT s_suppkey FROM supplier")
def _(spark, d):
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("k")).unionByName(table(spark, d, "supplier").select(F.col("s_suppkey").alias("k")))


@R.add("set_3", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def _(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, d, "supplier").select("s_nationkey"))


@R.add("set_4", "SELECT DISTINCT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def _(spark, d):
    c, o = table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    return c.join(o, "k", "left_anti").distinct()


@R.add("set_5", "SELECT 'n_name' AS name UNION ALL SELECT 'n_nationkey' UNION ALL SELECT 'n_regionkey'")
def _(spark, d):
    return IO.frame(spark, [(c,) for c in sorted(set(table(spark, d, "nation").columns) | {"n_name"})], "name string")
