"""Queries of profiling, sampling, learning, evaluation, serving and orchestration."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, features, learning, profile, serve
from . import pipeline, roles
from .linking import LEFT, PAIRS, RIGHT, all_candidates, distinct_rows, jaccard_sql, lev_sql, set_sql, weights, without_repeats
from .registry import Registry
from .relational import BUCKET_SQL, UPPER_PAIRS, upper_pairs
from .roles import table

R = Registry()
SCORED = roles.SCORED

# ---- aggregates of profiles


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _unpivot(columns: list[str], rows: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS col, {c}::VARCHAR AS value FROM ({rows}) t" for c in columns)


FIELDS = ["npi", "first_name", "last_name", "state", "zip5", "street1", "city"]
MISSING = f"SELECT 'left' AS dataset, col, count(*) FILTER (WHERE value IS NULL) AS n_missing, round(count(*) FILTER (WHERE value IS NULL) / count(*)::DOUBLE, 6) AS missing_rate FROM ({_unpivot(FIELDS, LEFT)}) u GROUP BY col"


def missing(spark, d):
    return rounded(profile.missingness(roles.role(spark, d, LEFT).select(*FIELDS), "left"), "missing_rate")


INFO = f"""SELECT 'left' AS dataset, col, sum(n)::BIGINT AS n_non_null, count(*) AS n_distinct, round(max(p), 6) AS top_share, round(-sum(p * log2(p)), 6) AS entropy_bits
 FROM (SELECT *, n / sum(n) OVER (PARTITION BY col)::DOUBLE AS p FROM (SELECT col, value, count(*) AS n FROM ({_unpivot(FIELDS, LEFT)}) u WHERE value IS NOT NULL GROUP BY col, value) c) s GROUP BY col"""


def info(spark, d):
    return rounded(profile.info_content(roles.role(spark, d, LEFT), "left", FIELDS), "top_share", "entropy_bits")


for _name in ("agg_11", "eda_1"):
    R.add(_name, MISSING)(missing)
R.add("eda_2", INFO)(info)


@R.add("agg_12", f"SELECT col, entropy_bits FROM ({INFO}) t")
def _(spark, d):
    return info(spark, d).select("col", "entropy_bits")


@R.add("agg_13", f"SELECT col, top_share FROM ({INFO}) t")
def _(spark, d):
    return info(spark, d).select("col", "top_share")


KEYED = f"SELECT state || '|' || coalesce(zip5, '') AS k FROM ({LEFT}) t"


@R.add("agg_14", f"""SELECT 'left' AS dataset, 'k' AS key, count(*) AS n_keys, round(avg(n), 6) AS avg_block, round(quantile_cont(n, 0.95), 6) AS p95_block, max(n) AS max_block,
 round(max(n) / sum(n)::DOUBLE, 6) AS top_share, round(max(-p), 6) AS entropy_bits FROM (SELECT *, sum(n / t * log2(n / t)) OVER () AS p FROM (SELECT n, sum(n) OVER ()::DOUBLE AS t FROM (SELECT k, count(*) AS n FROM ({KEYED}) q GROUP BY k) a) b) c""")
def _(spark, d):
    stats = profile.key_stats(roles.role(spark, d, KEYED), "k", "left")
    return rounded(stats, "avg_block", "p95_block", "top_share", "entropy_bits")


MI_COLUMNS = ["state", "zip5", "first_name"]


def _mi(a: str, b: str) -> str:
    return f"""SELECT 'left' AS dataset, '{a}' AS col_a, '{b}' AS col_b, round(sum(n / t * log2((n / t) / ((nx / t) * (ny / t)) + 1e-15)), 6) AS mi_bits FROM
 (SELECT n, sum(n) OVER ()::DOUBLE AS t, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny FROM
 (SELECT coalesce({a}, '') AS x, coalesce({b}, '') AS y, count(*) AS n FROM ({LEFT}) q GROUP BY 1, 2) j) w"""


@R.add("agg_15", " UNION ALL ".join(_mi(a, b) for i, a in enumerate(MI_COLUMNS) for b in MI_COLUMNS[i + 1 :]))
def _(spark, d):
    return rounded(profile.mutual_information(roles.role(spark, d, LEFT), MI_COLUMNS, "left"), "mi_bits")


NUMBERS = ["o_custkey", "o_orderkey", "o_totalprice"]
SUMMARY = " UNION ALL ".join(
    f"""SELECT 'orders' AS dataset, '{c}' AS col, count({c}) AS count, round(avg({c}), 4) AS mean, round(coalesce(stddev_samp({c}), 0), 4) AS std, round(quantile_cont({c}::DOUBLE, 0.01), 4) AS p01,
 round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50, round(quantile_cont({c}::DOUBLE, 0.99), 4) AS p99, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM orders"""
    for c in NUMBERS
)


def summary(spark, d):
    out = profile.numeric_summary(table(spark, d, "orders"), "orders", NUMBERS)
    return rounded(out, "mean", "std", "p01", "p50", "p99", digits=4)


R.add("agg_16", SUMMARY)(summary)
R.add("eda_3", SUMMARY)(summary)
LINE = ["l_quantity", "l_extendedprice", "l_discount"]
CORR = " UNION ALL ".join(f"SELECT 'lineitem' AS dataset, '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for i, a in enumerate(LINE) for b in LINE[i + 1 :])


def correlation(spark, d):
    return rounded(profile.correlations(table(spark, d, "lineitem"), "lineitem", LINE), "corr")


R.add("agg_17", CORR)(correlation)
R.add("eda_5", CORR)(correlation)


@R.add("agg_18", "SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus <> 'P') AS \"false\", count(*) FILTER (WHERE o_orderstatus = 'P') AS \"true\" FROM orders GROUP BY o_orderpriority")
def _(spark, d):
    open_ = table(spark, d, "orders").withColumn("pending", F.col("o_orderstatus") == "P")
    return open_.groupBy("o_orderpriority").pivot("pending", [False, True]).agg(F.count(F.lit(1))).fillna(0)


@R.add("agg_19", "SELECT event_type, round(median(value), 6) AS med, round(mad(value), 6) AS mad FROM events GROUP BY event_type")
def _(spark, d):
    e = table(spark, d, "events").select("event_type", "value")
    med = e.groupBy("event_type").agg(F.percentile("value", F.lit(0.5)).alias("med"))
    spread = e.join(med, "event_type").groupBy("event_type").agg(F.max("med").alias("med"), F.percentile(F.abs(F.col("value") - F.col("med")), F.lit(0.5)).alias("mad"))
    return rounded(spread, "med", "mad")


@R.add("agg_20", "SELECT o_orderstatus, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std, min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders GROUP BY 1")
def _(spark, d):
    x = "o_totalprice"
    return rounded(table(spark, d, "orders").groupBy("o_orderstatus").agg(F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")), "mean", "std", digits=4)


OVERLAP = """WITH a AS (SELECT DISTINCT o_custkey AS v FROM orders), b AS (SELECT DISTINCT c_custkey AS v FROM customer)
 SELECT (SELECT count(*) FROM a JOIN b ON a.v = b.v) / least((SELECT count(*) FROM a), (SELECT count(*) FROM b))::DOUBLE AS overlap_rate"""


def overlap(spark, d):
    return profile.overlap_rate(table(spark, d, "orders"), table(spark, d, "customer"), "o_custkey", "c_custkey")


R.add("agg_21", OVERLAP)(overlap)
R.add("eda_11", OVERLAP)(overlap)
TOP = f"""SELECT 'left' AS dataset, col, value, n, r::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, value) AS r FROM
 (SELECT col, value, count(*) AS n FROM ({_unpivot(['state', 'zip5'], LEFT)}) u WHERE value IS NOT NULL GROUP BY col, value) c) t WHERE r <= 15"""


def top(spark, d):
    return profile.top_values(roles.role(spark, d, LEFT), "left", ["state", "zip5"], 15)


R.add("eda_4", TOP)(top)
R.add("top_7", TOP)(top)


@R.add("agg_24", "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, count(*) AS n FROM lineitem GROUP BY ALL")
def _(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.count("*").alias("n"))


# ---- tests of the profile


@R.add("eda_6", """SELECT 'priority vs status' AS test, round(n * pow(greatest(abs(ff * tt - ft * tf) - n / 2, 0), 2) / ((ff + ft) * (tf + tt) * (ff + tf) * (ft + tt)), 6) AS stat FROM
 (SELECT count(*)::DOUBLE AS n, count(*) FILTER (WHERE NOT a AND NOT b)::DOUBLE AS ff, count(*) FILTER (WHERE NOT a AND b)::DOUBLE AS ft, count(*) FILTER (WHERE a AND NOT b)::DOUBLE AS tf,
 count(*) FILTER (WHERE a AND b)::DOUBLE AS tt FROM (SELECT o_orderpriority = '1-URGENT' AS a, o_orderstatus = 'P' AS b FROM orders) o) t""")
def _(spark, d):
    out = profile.chi_square(table(spark, d, "orders"), F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus") == "P", "priority vs status")
    return rounded(out, "stat").drop("p_value")


@R.add("eda_7", """WITH e AS (SELECT event_type = 'click' AS g, value AS v FROM events), t AS (SELECT count(*) FILTER (WHERE NOT g) AS t0, count(*) FILTER (WHERE g) AS t1 FROM e),
 s AS (SELECT v, count(*) FILTER (WHERE NOT g) AS n0, count(*) FILTER (WHERE g) AS n1 FROM e GROUP BY v), c AS (SELECT sum(n0) OVER w AS c0, sum(n1) OVER w AS c1 FROM s WINDOW w AS (ORDER BY v))
 SELECT 'clicks' AS test, round(max(abs(c0 / t0::DOUBLE - c1 / t1::DOUBLE)), 9) AS stat FROM c, t""")
def _(spark, d):
    out = profile.ks_two_sample(table(spark, d, "events"), F.col("event_type") == "click", "value", "clicks")
    return rounded(out, "stat", digits=9).drop("p_value")


@R.add("eda_8", f"SELECT dataset, col, CASE WHEN missing_rate > 0.30 THEN 'keep missing as signal' WHEN missing_rate > 0.05 THEN 'light imputation and flag' ELSE 'simple fill' END AS strategy FROM ({MISSING}) t")
def _(spark, d):
    return profile.imputation(missing(spark, d))


@R.add("eda_9", """WITH m AS (SELECT median(value) AS med, mad(value) AS mad FROM events) SELECT event_id AS key, value, round(0.6745 * (value - med) / mad, 6) AS z, 'events' AS dataset, 'value' AS metric
 FROM events, m WHERE abs(0.6745 * (value - med) / mad) >= 8""")
def _(spark, d):
    return rounded(profile.outliers(table(spark, d, "events"), "events", "value", "event_id"), "z")


#: The reference's concepts, and their columns in the roles of its three data sets.
CONCEPTS = {
    "npi": {"left": "npi", "right": "npi", "claims": "o_custkey"},
    "first_name": {"left": "first_name", "right": "first_name", "claims": None},
    "last_name_or_org": {"left": "last_name", "right": "last_or_org_name", "claims": None},
    "state": {"left": "state", "right": "state", "claims": None},
    "zip5": {"left": "zip5", "right": "zip5", "claims": None},
    "city": {"left": "city", "right": "city", "claims": None},
}


@R.add("eda_10", """SELECT * FROM (VALUES ('npi', 'left', 'npi'), ('npi', 'right', 'npi'), ('npi', 'claims', 'o_custkey'), ('first_name', 'left', 'first_name'), ('first_name', 'right', 'first_name'),
 ('first_name', 'claims', NULL), ('last_name_or_org', 'left', 'last_name'), ('last_name_or_org', 'right', 'last_or_org_name'), ('last_name_or_org', 'claims', NULL), ('state', 'left', 'state'),
 ('state', 'right', 'state'), ('state', 'claims', NULL), ('zip5', 'left', 'zip5'), ('zip5', 'right', 'zip5'), ('zip5', 'claims', NULL), ('city', 'left', 'city'), ('city', 'right', 'city'),
 ('city', 'claims', NULL)) t(concept, dataset, "column")""")
def _(spark, d):
    return profile.schema_map(spark, CONCEPTS)


# ---- sampling and learning, on the pairs that share state and zip

NAMES_B, NAMES_X = "(b_first || ' ' || b_last)", "(x_first || ' ' || x_last)"
# what DuckDB has of Jaro-Winkler agrees where it is 0.92 or more
_JW = "jaro_winkler_similarity(upper({}), upper({}))"
_ORG = "list_has_any(string_split(upper({}), ' '), ['MEDICAL', 'GROUP'])"
ORDER = "md5(o_orderkey::VARCHAR || '|42')"


@R.add("smp_1", f"SELECT o_orderkey FROM orders ORDER BY {ORDER}, o_orderkey LIMIT 200")
def _(spark, d):
    return learning.sample_rows(table(spark, d, "orders").select("o_orderkey"), 200, "o_orderkey")


#: The pairs in the role of labelled ones: names that agree are the same person. SQL that Spark and DuckDB both read.
LABELLED = f"SELECT *, CASE WHEN b_first = x_first AND b_last = x_last THEN 1 ELSE 0 END AS y FROM ({PAIRS}) q"


def labelled(spark, d, only=None):
    """Feature rows of the labelled pairs, with y and the features; one row a pair."""
    rows = features.feature_rows(roles.role(spark, d, LABELLED), weights(spark, d), only)
    return rows.select("left_id", "right_id", "y", *(only or features.FEATURES)).dropDuplicates(["left_id", "right_id"])


def similar(spark, d):
    """Documents with labels in the role of scored pairs: y is the label, features are counts of the text."""
    docs = table(spark, d, "documents").select("doc_id", "source", "text", "n_chars")
    rows = docs.join(table(spark, d, "labels").select("doc_id", F.col("quality").alias("y")), "doc_id")
    text = F.col("text")
    return rows.select(
        "doc_id",
        F.col("source").alias("grp"),
        "y",
        F.log1p(F.col("n_chars").cast("double")).alias("f_length"),
        (F.length(F.regexp_replace(text, "[^A-Z]", "")) / F.col("n_chars")).alias("f_capitals"),
        (F.length(F.regexp_replace(text, "[^#*$%&|!]", "")) / F.col("n_chars")).alias("f_symbols"),
        (F.size(F.array_distinct(F.split(text, " "))) / F.size(F.split(text, " "))).alias("f_distinct"),
    )


SIMILAR = ["f_length", "f_capitals", "f_symbols", "f_distinct"]


_HARD = f"(y = 0 AND ({_JW.format('b_last', 'x_last')} >= 0.92 OR {_JW.format(NAMES_B, NAMES_X)} >= 0.92))"
_CONFLICT = f"(y = 0 AND {_ORG.format('b_last')} <> {_ORG.format('x_last')})"
_DRAWN = lambda pool, n, seed, origin: f"SELECT left_id, right_id, y, '{origin}' AS origin FROM (SELECT *, row_number() OVER (ORDER BY md5(left_id || '|' || right_id || '|{seed}'), left_id, right_id) AS k FROM p WHERE {pool}) t, n WHERE k <= {n}"


@R.add("smp_2", f"""WITH p AS (SELECT DISTINCT left_id, right_id, y, b_first, b_last, x_first, x_last FROM ({LABELLED}) t),
 c AS (SELECT count(*) FILTER (WHERE y = 1) AS pos FROM p), m AS (SELECT greatest(0, least(10 * pos, 1200000 - pos)) AS total FROM c), n AS (SELECT total, total // 2 AS hard FROM m)
 SELECT left_id, right_id, y, 'positive' AS origin FROM p WHERE y = 1 UNION ALL {_DRAWN(_HARD, 'hard', 42, 'hard')}
 UNION ALL {_DRAWN('y = 0', 'total - hard', 43, 'random')} UNION ALL {_DRAWN(_CONFLICT, '2 * hard', 45, 'org_person')}""")
def _(spark, d):
    own = labelled(spark, d, ["sim_jw_lastname", "sim_jw_fullname", "org_vs_person_conflict"])
    return learning.training_set(own, "left_id", "right_id").select("left_id", "right_id", "y", "origin")


_FOLD = "('0x' || substr(md5(grp || '|42'), 1, 7))::BIGINT"


@R.add("smp_3", f"SELECT doc_id, {_FOLD} % 5 = 0 AS held_out FROM ({SCORED}) t")
def _(spark, d):
    train, test = learning.holdout(roles.role(spark, d, SCORED), "grp")
    return train.select("doc_id", F.lit(False).alias("held_out")).union(test.select("doc_id", F.lit(True)))


@R.add("smp_4", f"SELECT doc_id, ({_FOLD} % 3)::INTEGER AS fold FROM ({SCORED}) t")
def _(spark, d):
    return roles.role(spark, d, SCORED).select("doc_id", learning.fold("grp", 3).alias("fold"))


def _fitted(spark, d, name):
    rows = similar(spark, d)
    train, test = learning.holdout(rows, "grp")
    return learning.estimators(SIMILAR)[name].fit(learning.balanced(train)), test


def _model(name: str, kind: str):
    @R.add(name)
    def _(spark, d):
        model, test = _fitted(spark, d, kind)
        return learning.predict(model, test).select("doc_id", "y", "score")


_model("ml_1", "logreg")
_model("ml_2", "random_forest")
_model("ml_3", "grad_boost")
_model("sim_9", "logreg")


@R.add("ml_4")
def _(spark, d):
    found = learning.search(learning.balanced(similar(spark, d)), learning.estimators(SIMILAR)["logreg"], {"regParam": [0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5]}, "grp", 3)
    rows = [(i, float(m)) for i, m in enumerate(found.avgMetrics)]
    return spark.createDataFrame(rows, "candidate int, pr_area double")


@R.add("ml_5")
def _(spark, d):
    scored = learning.out_of_fold(similar(spark, d), learning.estimators(SIMILAR)["logreg"], "grp")
    out = None
    for kind in ("sigmoid", "isotonic"):
        part = learning.apply_calibration(learning.calibrate(scored, kind), scored).select("doc_id", F.lit(kind).alias("kind"), "score")
        out = part if out is None else out.unionByName(part)
    return out


@R.add("ml_6")
def _(spark, d):
    return learning.select_model(similar(spark, d), SIMILAR, "grp")


@R.add("ml_7")
def _(spark, d):
    model, _ = _fitted(spark, d, "logreg")
    return spark.createDataFrame([(f, float(c)) for f, c in zip(SIMILAR, model.stages[-1].coefficients, strict=True)], "feature string, coefficient double")


@R.add("ml_8")
def _(spark, d):
    model, test = _fitted(spark, d, "logreg")
    return learning.permutation_importance(model, test.cache(), SIMILAR, "doc_id", repeats=2)


@R.add("ml_9")
def _(spark, d):
    train, test = learning.holdout(similar(spark, d), "grp")
    return learning.active_learning(train.cache(), learning.estimators(SIMILAR)["logreg"], test.cache(), "doc_id", rounds=2, batch=20)


@R.add("ml_10", f"""WITH s AS (SELECT doc_id, score FROM ({SCORED}) t) SELECT DISTINCT * FROM ((SELECT * FROM s ORDER BY abs(score - 0.5), doc_id LIMIT 60)
 UNION ALL (SELECT * FROM s ORDER BY score DESC, doc_id LIMIT 20) UNION ALL (SELECT * FROM s ORDER BY score, doc_id LIMIT 20)) u""")
def _(spark, d):
    return learning.review_queue(roles.role(spark, d, SCORED).select("doc_id", "score"), 100, "doc_id")


# ---- evaluation


def scored(spark, d):
    return roles.role(spark, d, SCORED)


def _confusion_sql(rows: str, at: str = "0.5", by: str = "") -> str:
    head = f"{by}, " if by else ""
    return f"""SELECT {head}tp, fp, fn, tn, round(p, 9) AS precision, round(r, 9) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 9) AS f1 FROM (SELECT *,
 CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS r FROM (SELECT {head}
 count(*) FILTER (WHERE y = 1 AND score >= {at}) AS tp, count(*) FILTER (WHERE y = 0 AND score >= {at}) AS fp, count(*) FILTER (WHERE y = 1 AND score < {at}) AS fn,
 count(*) FILTER (WHERE y = 0 AND score < {at}) AS tn FROM ({rows}) s {f'GROUP BY {by}' if by else ''}) c) q"""


def _rates(df):
    return rounded(df, "precision", "recall", "f1", digits=9)


@R.add("val_1", _confusion_sql(SCORED))
def _(spark, d):
    return _rates(evaluate.confusion(scored(spark, d), 0.5))


CURVE = f"""SELECT *, tp / (tp + fp)::DOUBLE AS precision, tp / ap::DOUBLE AS recall FROM (SELECT score AS threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS ap, sum(neg) OVER () AS an
 FROM (SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM ({SCORED}) s GROUP BY score) g WINDOW w AS (ORDER BY score DESC)) c"""


@R.add("val_2", f"SELECT round(sum(precision * pos / ap), 9) AS pr_auc FROM ({CURVE}) t")
def _(spark, d):
    return rounded(evaluate.average_precision(scored(spark, d)), "pr_auc", digits=9)


@R.add("val_3", f"SELECT round(sum(pos * (an - fp + neg / 2.0::DOUBLE)) / (max(ap) * max(an)), 9) AS roc_auc FROM ({CURVE}) t")
def _(spark, d):
    return rounded(evaluate.roc_auc(scored(spark, d)), "roc_auc", digits=9)


@R.add("val_4", f"SELECT threshold, round(precision, 9) AS precision, round(recall, 9) AS recall FROM ({CURVE}) t")
def _(spark, d):
    return rounded(evaluate.curve(scored(spark, d)), "precision", "recall", digits=9).select("threshold", "precision", "recall")


F1 = f"SELECT threshold, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM ({CURVE}) t"
BEST = f"SELECT threshold, f1 FROM ({F1}) f ORDER BY f1 DESC, threshold LIMIT 1"


@R.add("val_5", f"SELECT threshold, round(f1, 9) AS f1 FROM ({BEST}) b")
def _(spark, d):
    return rounded(evaluate.best_f1(scored(spark, d)), "f1", digits=9)


@R.add("val_6", _confusion_sql(SCORED, by="pair_type"))
def _(spark, d):
    return _rates(evaluate.confusion(scored(spark, d), 0.5, ["pair_type"]))


@R.add("val_7", f"SELECT fold, round(avg(y), 9) AS positive_rate, count(*) AS n FROM (SELECT *, ({_FOLD} % 3)::INTEGER AS fold FROM ({SCORED}) t) f GROUP BY fold")
def _(spark, d):
    return rounded(scored(spark, d).withColumn("fold", learning.fold("grp", 3)).groupBy("fold").agg(F.avg("y").alias("positive_rate"), F.count("*").alias("n")), "positive_rate", digits=9)


@R.add("val_7_cv")
def _(spark, d):
    """Average precision of each fold's rows under models of the other folds, and their summary."""
    cv = learning.out_of_fold(similar(spark, d), learning.estimators(SIMILAR)["logreg"], "grp")
    per = evaluate.average_precision(cv.withColumn("k", F.col("fold")), ["k"])
    return per.agg(F.avg("pr_auc").alias("mean"), F.stddev_samp("pr_auc").alias("std"), F.min("pr_auc").alias("min"), F.max("pr_auc").alias("max"))


_STEPS = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183, 0.999916758850712]
_DRAWS = " + ".join(f"(u >= {s}::DOUBLE)::INTEGER" for s in _STEPS)
REPLICATES = f"""WITH g AS (SELECT DISTINCT grp, replicate, ('0x' || substr(md5(grp || '|' || replicate || '|42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM ({SCORED}) t, (SELECT unnest(range(0, 400)) AS replicate) r),
 w AS (SELECT grp, replicate, {_DRAWS} AS w FROM g),
 m AS (SELECT grp, y, 'score' AS model, score FROM ({SCORED}) t UNION ALL SELECT grp, y, 'score_b', score_b FROM ({SCORED}) t),
 s AS (SELECT replicate::INTEGER AS replicate, model, score, sum(w) FILTER (WHERE y = 1) AS p, sum(w) FILTER (WHERE y = 0) AS n FROM m JOIN w ON m.grp = w.grp WHERE w > 0 GROUP BY ALL),
 c AS (SELECT *, coalesce(p, 0) AS pos, coalesce(n, 0) AS neg, sum(coalesce(p, 0)) OVER d AS tp, sum(coalesce(n, 0)) OVER d AS fp, sum(coalesce(p, 0)) OVER a AS ap, sum(coalesce(n, 0)) OVER a AS an FROM s
   WINDOW d AS (PARTITION BY replicate, model ORDER BY score DESC), a AS (PARTITION BY replicate, model)),
 v AS (SELECT replicate, model, sum(tp / nullif(tp + fp, 0)::DOUBLE * pos / nullif(ap, 0)) AS pr_auc, sum(pos * (an - fp + neg / 2.0::DOUBLE)) / nullif(max(ap) * max(an), 0) AS roc_auc FROM c GROUP BY replicate, model)"""


def replicates(spark, d):
    return evaluate.bootstrap_metrics(scored(spark, d), "grp", 400, scores=("score", "score_b"))


@R.add("val_8", REPLICATES + " SELECT model, round(avg(pr_auc), 6) AS mean, round(quantile_cont(pr_auc, 0.025), 6) AS low, round(quantile_cont(pr_auc, 0.975), 6) AS high FROM v GROUP BY model")
def _(spark, d):
    return rounded(evaluate.interval(replicates(spark, d), "pr_auc", ["model"]), "mean", "low", "high")


@R.add("val_9", REPLICATES + """, e AS (SELECT a.pr_auc - b.pr_auc AS d FROM v a JOIN v b ON a.replicate = b.replicate WHERE a.model = 'score' AND b.model = 'score_b')
 SELECT round(avg(d), 6) AS mean, round(quantile_cont(d, 0.025), 6) AS low, round(quantile_cont(d, 0.975), 6) AS high, round(least(1, 2 * least(avg((d <= 0)::INTEGER), avg((d >= 0)::INTEGER))), 6) AS p_value FROM e""")
def _(spark, d):
    return rounded(evaluate.paired_difference(replicates(spark, d), "score", "score_b", "pr_auc"), "mean", "low", "high", "p_value")


_GRID = "(SELECT 0.05::DOUBLE + i * ((0.99::DOUBLE - 0.05::DOUBLE) / 39) AS threshold FROM range(0, 40) r(i))"


@R.add("val_10", f"SELECT round(threshold, 9) AS threshold, tp, fp, fn, tn, precision, recall, f1 FROM ({_confusion_sql(f'SELECT * FROM ({SCORED}) z, {_GRID} g', 'threshold', 'threshold')}) t")
def _(spark, d):
    return rounded(_rates(evaluate.threshold_sensitivity(scored(spark, d))), "threshold", digits=9)


@R.add("val_11", f"""WITH c AS ({CURVE}), m AS (SELECT target, threshold, row_number() OVER (PARTITION BY target ORDER BY recall DESC, threshold) AS n FROM c, (VALUES (0.90), (0.95), (0.98)) t(target) WHERE precision >= target)
 SELECT t.target::DOUBLE AS target, coalesce(m.threshold, (SELECT threshold FROM ({BEST}) b)) AS threshold, m.threshold IS NOT NULL AS met FROM (VALUES (0.90), (0.95), (0.98)) t(target) LEFT JOIN m ON m.target = t.target AND n = 1""")
def _(spark, d):
    return evaluate.precision_targets(scored(spark, d), [0.90, 0.95, 0.98])


_LEV = f"round({lev_sql(NAMES_B, NAMES_X)}, 9)"
ERRORS = f"""SELECT left_id, right_id, y, score, {BUCKET_SQL} AS error_bucket FROM (SELECT *, CASE WHEN left_npi = right_id THEN 1 ELSE 0 END AS y, {_LEV.replace('b_last', 'b_last')} AS score
 FROM ({UPPER_PAIRS}) u WHERE left_npi IS NOT NULL) s WHERE (y = 0 AND score >= 0.5) OR (y = 1 AND score < 0.5)"""


def wrong(spark, d):
    from ..functions import similarity as S

    full = lambda s: F.concat_ws(" ", f"{s}_first", f"{s}_last")
    rows = upper_pairs(spark, d).where("left_npi IS NOT NULL").withColumns(
        {"y": (F.col("left_npi") == F.col("right_id")).cast("int"), "score": F.round(S.lev_sim(full("b"), full("x")), 9)}
    )
    return evaluate.errors(rows, 0.5)


@R.add("val_12", f"SELECT error_bucket, count(*) AS n FROM ({ERRORS}) e GROUP BY error_bucket")
def _(spark, d):
    return wrong(spark, d).groupBy("error_bucket").agg(F.count("*").alias("n"))


# ---- user functions, service and orchestration


@R.add("udf_1", f"SELECT left_id, right_id, {_LEV} AS lev, round({jaccard_sql(set_sql(NAMES_B), set_sql(NAMES_X))}, 9) AS jacc FROM ({PAIRS}) q")
def _(spark, d):
    """A struct of several similarities from a struct of inputs, in native columns."""
    from ..functions import similarity as S

    full = lambda s: F.concat_ws(" ", f"{s}_first", f"{s}_last")
    feat = F.struct(F.round(S.lev_sim(full("b"), full("x")), 9).alias("lev"), F.round(S.token_jaccard(full("b"), full("x")), 9).alias("jacc"))
    return roles.role(spark, d, PAIRS).select("left_id", "right_id", feat.alias("feat")).select("left_id", "right_id", "feat.*")


@R.add("udf_2", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 99 END AS rank FROM orders")
def _(spark, d):
    ranks = F.create_map(F.lit("F"), F.lit(0), F.lit("O"), F.lit(1))
    return table(spark, d, "orders").select("o_orderkey", F.coalesce(ranks[F.col("o_orderstatus")], F.lit(99)).alias("rank"))


@R.add("udf_3", f"SELECT state, count(*) AS n, count(DISTINCT zip5) AS zips FROM ({LEFT}) t GROUP BY state")
def _(spark, d):
    """What a loop over rows would gather, as one aggregation."""
    return roles.role(spark, d, LEFT).groupBy("state").agg(F.count("*").alias("n"), F.count_distinct("zip5").alias("zips"))


def service(spark, d):
    people = roles.role(spark, d, LEFT).where("n_years < 2").select("profile_id", "first_name", "last_name", "state", "zip5", "street1", "city", "npi")
    idf = roles.role(spark, d, f"SELECT first_name || ' ' || last_or_org_name AS name FROM ({RIGHT}) r")
    from ..functions import similarity as S

    return people, roles.role(spark, d, RIGHT), S.idf(F.col("name"), idf)


@R.add("api_1", "SELECT 'ok' AS status")
def _(spark, d):
    return serve.health(spark)


@R.add("api_2")
def _(spark, d):
    people, providers, idf = service(spark, d)
    one = serve.records(spark, [{"profile_id": "q1", "first_name": "red", "last_name": "widget", "state": "ECONOMY", "zip5": "12329"}])
    return serve.match(one, providers, idf)


@R.add("api_3", f"SELECT DISTINCT left_id, right_id FROM ({PAIRS}) q WHERE list_has_any(string_split(upper(b_last), ' '), ['MEDICAL', 'GROUP']) OR NOT list_has_any(string_split(upper(x_last), ' '), ['MEDICAL', 'GROUP'])")
def _(spark, d):
    from ..functions import text as T

    rows = distinct_rows(spark, d, ["org_vs_person_conflict"], ["b_last"])
    fair = rows.where((T.is_org_like(F.col("b_last")) == 1) | (F.col("org_vs_person_conflict") == 0))
    return without_repeats(fair.select("left_id", "right_id", "again"))


@R.add("api_4")
def _(spark, d):
    return serve.match(*service(spark, d))


@R.add("api_5", f"SELECT count(*) AS n_providers, (SELECT count(*) FROM ({PAIRS}) p) AS n_candidates, (SELECT round(sum(precision * pos / ap), 9) FROM ({CURVE}) t) AS pr_auc, (SELECT round(f1, 9) FROM ({BEST}) b) AS best_f1 FROM ({RIGHT}) r")
def _(spark, d):
    rows = scored(spark, d)
    metrics = {"pr_auc": evaluate.average_precision(rows).first().pr_auc, "best_f1": evaluate.best_f1(rows).first().f1}
    return serve.stats(roles.role(spark, d, RIGHT), roles.role(spark, d, PAIRS), {k: round(v, 9) for k, v in metrics.items()})


@R.add("orc_1", "SELECT * FROM (VALUES (0, 'ingest'), (1, 'blocking'), (2, 'features')) t(position, step)")
def _(spark, d):
    todo = pipeline.resolve(skip_eda=True, skip_model=True)
    return spark.createDataFrame(list(enumerate(todo)), "position int, step string")


@R.add("orc_2", "SELECT * FROM (VALUES ('ingest', 'ok'), ('eda', 'ok'), ('blocking', 'ok'), ('features', 'failed'), ('model', 'not run'), ('stat_validation', 'not run')) t(step, status)")
def _(spark, d):
    def fail(_):
        raise RuntimeError("no features")

    steps = {
        "ingest": lambda s: roles.role(s, d, LEFT).count(),
        "eda": lambda s: missing(s, d).count(),
        "blocking": lambda s: all_candidates(s, d).count(),
        "features": fail,
    }
    return pipeline.run(spark, pipeline.resolve(), steps).select("step", "status")


