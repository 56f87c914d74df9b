import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tether.operators import entities, evaluate, features, learning, profile, serve
from tether.functions import similarity as S
from tether.plans import pipeline
from tether.sources import io as IO


def test_null_aware_counts(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, "x"), ("b", 4, None)], "k string, o int, v string")
    got = {r.k: (r.v, r.n, r.s) for r in df.groupBy("k").agg(*entities.first_by(F.col("o"), "v"), entities.n_unique("v").alias("n"), F.sum("o").alias("s")).collect()}
    assert got == {"a": (None, 2, 6), "b": (None, 1, 4)}


def test_feature_row(spark):
    pair = {"b_first": "John", "b_last": "Smith", "b_state": "TX", "b_zip5": "78701", "b_city": "Austin", "x_first": "Jon", "x_last": "Smyth", "x_state": "tx", "x_zip5": "78702", "x_city": "Austin"}
    df = spark.createDataFrame([tuple(pair.values())], ", ".join(f"{k} string" for k in pair))
    row = features.feature_rows(df, S.idf(F.lit("john smith"), df)).first().asDict()
    assert set(features.FEATURES) <= set(row) and len(features.FEATURES) == 33
    for k in features.FEATURES:
        assert 0 <= row[k] <= 1, k
    assert (row["sim_soundex_last"], row["state_match"], row["zip_match"], row["zip3_match"], row["sim_jw_street1"], row["miss_b_street1"]) == (1, 1, 0, 1, 0.0, 1)
    assert row["sim_jw_city"] == 1.0 and row["credential_overlap"] == 1.0


def scores(spark, rows):
    return spark.createDataFrame(rows, "y int, score double")


def test_ranking_measures(spark):
    df = scores(spark, [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)])
    assert evaluate.average_precision(df).first().pr_auc == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)
    assert evaluate.roc_auc(df).first().roc_auc == pytest.approx((2 + 1.5) / 4)
    assert evaluate.roc_auc(scores(spark, [(1, 0.5)])).first().roc_auc is None
    best = evaluate.best_f1(df).first()
    assert (best.threshold, best.f1) == (0.8, pytest.approx(0.8))
    c = evaluate.confusion(df, 0.8).first()
    assert (c.tp, c.fp, c.fn, c.tn) == (2, 1, 0, 1)
    met = {r.target: (r.threshold, r.met) for r in evaluate.precision_targets(df, [0.9, 1.1]).collect()}
    assert met == {0.9: (0.9, True), 1.1: (0.8, False)}


def test_bootstrap_draws_have_mean_one():
    w = np.array([evaluate.draws(str(g), 50, 42) for g in range(400)])
    assert abs(w.mean() - 1) < 0.03 and abs(w.var() - 1) < 0.05 and (w == [evaluate.draws(str(g), 50, 42) for g in range(400)]).all()


def test_bootstrap_equals_plain_sums(spark):
    rng = np.random.default_rng(3)
    rows = [(f"g{rng.integers(12)}", int(rng.integers(2)), float(rng.integers(40)) / 40, float(rng.integers(40)) / 40) for _ in range(300)] + [(None, 1, 0.975, 0.1)]
    df = spark.createDataFrame(rows, "g string, y int, score double, other double")
    got = {(r.replicate, r.model): r for r in evaluate.bootstrap_metrics(df.repartition(5), "g", 3, scores=("score", "other"), threshold=0.5).collect()}
    assert len(got) == 6
    for (k, model), r in got.items():
        w = np.array([evaluate.draws(x[0] or "", 3, 42)[k] for x in rows])
        y, s = np.array([x[1] for x in rows]), np.array([x[2 if model == "score" else 3] for x in rows])
        tp, fp, fn = (w * (y == 1) * (s >= 0.5)).sum(), (w * (y == 0) * (s >= 0.5)).sum(), (w * (y == 1) * (s < 0.5)).sum()
        assert (r.precision, r.recall) == pytest.approx((tp / (tp + fp), tp / (tp + fn)))
        ap = sum((w * (y == 1) * (s == t)).sum() * (w * (y == 1) * (s >= t)).sum() / max(1, (w * (s >= t)).sum()) for t in set(s.tolist())) / (w * y).sum()
        assert r.pr_auc == pytest.approx(ap)


def test_two_sample_test_and_chi_square(spark):
    df = spark.range(400).select((F.col("id") % 2 == 0).alias("g"), (F.col("id") % 100).cast("double").alias("v"))
    r = profile.ks_two_sample(df, F.col("g"), "v", "t").first()
    assert r.stat == pytest.approx(0.02) and r.p_value > 0.99
    assert profile.ks_two_sample(df.limit(60), F.col("g"), "v", "t").count() == 0
    t = spark.createDataFrame([(True, True)] * 30 + [(True, False)] * 10 + [(False, True)] * 10 + [(False, False)] * 30, "a boolean, b boolean")
    r = profile.chi_square(t, F.col("a"), F.col("b"), "t").first()
    assert r.stat == pytest.approx(18.05) and r.p_value == pytest.approx(math.erfc(math.sqrt(18.05 / 2)), rel=1e-4)


def test_profile_of_empty_and_small(spark):
    empty = spark.createDataFrame([], "a string, b double")
    assert {(r.col, r.n_missing, r.missing_rate) for r in profile.missingness(empty, "e").collect()} == {("a", 0, None), ("b", 0, None)}
    assert profile.numeric_summary(empty, "e").count() == 0
    assert profile.numeric_summary(spark.createDataFrame([(2.0,)], "b double"), "e").first()["std"] == 0
    assert profile.overlap_rate(empty, empty, "a", "a").first().overlap_rate is None


def test_csv_keeps_blank_and_null_apart(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,name,n\n007,"",1\n8,,x\n')
    rows = IO.read_csv(spark, str(tmp_path / "x.csv"), ["id", "name", "n"], {"n": "int"}).collect()
    assert [tuple(r) for r in rows] == [("007", "", 1), ("8", None, None)]
    (tmp_path / "y.csv").write_bytes(b"id\nab\xff\n")
    assert IO.read_csv(spark, str(tmp_path / "y.csv"), ["id"]).first().id == "ab�"


def test_samples_and_folds(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("g"))
    a, b = (learning.sample_rows(df.repartition(n), 10, "id").collect() for n in (1, 5))
    assert sorted(a) == sorted(b) and len(a) == 10
    train, test = learning.holdout(df, "g")
    assert not {r.g for r in train.collect()} & {r.g for r in test.collect()} and train.count() + test.count() == 100


def test_steps():
    assert pipeline.resolve(["blocking", "ingest"]) == ["ingest", "blocking"]
    assert pipeline.resolve(skip_eda=True, skip_model=True) == ["ingest", "blocking", "features"]
    with pytest.raises(pipeline.UnknownStep):
        pipeline.resolve(["nothing"])


PROVIDERS = [
    ("1234567890", "John", "Smith", "TX", "78701", "1 Main St", "Austin", "MD"),
    ("9999999999", "Alice", "Medical Group", "CA", "90210", "2 Main St", "LA", None),
]


def providers(spark):
    return spark.createDataFrame(PROVIDERS, "npi string, first_name string, last_or_org_name string, state string, zip5 string, street1 string, city string, credentials string")


def test_service(spark):
    idf = spark.createDataFrame([("JOHN", 1, 1.0), ("SMITH", 1, 1.0), ("ALICE", 1, 1.0)], "token string, df long, idf double")
    q = serve.records(spark, [{"profile_id": "p1", "first_name": "Jon", "last_name": "Smith", "state": "TX", "zip5": "78705"}])
    got = serve.match(q, providers(spark), idf).collect()
    assert [r.candidate_npi for r in got] == ["1234567890"] and got[0].profile_id == "p1"
    far = serve.records(spark, [{"profile_id": "p2", "first_name": "Al", "last_name": "Medical", "state": "ZZ"}])
    assert len(serve.match(far, providers(spark), idf).collect()) == 2  # an organisation may match either
    assert serve.health(spark).first().status == "ok"
    for bad in ({"first_name": "x"}, {"profile_id": " "}, {"profile_id": "p", "colour": "red"}):
        with pytest.raises(serve.InvalidRecord):
            serve.records(spark, [bad])
    with pytest.raises(serve.NotReady):
        serve.match(q, None, idf)


def test_stream_of_queries(spark, tmp_path):
    from tether.streaming.match import match_stream

    fields = ", ".join(f"{f} string" for f in serve.FIELDS)
    serve.records(spark, [{"profile_id": "p1", "first_name": "John", "last_name": "Smith", "state": "TX", "zip5": "78701"}]).write.json(str(tmp_path / "in"))
    idf = spark.createDataFrame([("JOHN", 1, 1.0)], "token string, df long, idf double")
    seen = []
    stream = match_stream(spark.readStream.schema(fields).json(str(tmp_path / "in")), providers(spark), idf, lambda df, n: seen.extend(df.collect()), checkpoint=str(tmp_path / "cp"))
    stream.awaitTermination(120)
    assert [r.candidate_npi for r in seen] == ["1234567890"]


def test_training_set_query_keeps_more_than_2000_negatives(spark, monkeypatch):
    from tether.plans import analysis

    rows = spark.range(3300).selectExpr(
        "id AS left_id", "id AS right_id", "CAST(id < 300 AS INT) AS y", "0.5D AS sim_jw_lastname", "0.5D AS sim_jw_fullname", "0 AS org_vs_person_conflict"
    )
    monkeypatch.setattr(analysis, "labelled", lambda *_: rows)
    drawn = analysis.R.queries["smp_2"](spark, "").groupBy("origin").count().collect()
    assert {r.origin: r["count"] for r in drawn} == {"positive": 300, "random": 1500}  # no hard ones: their half stays open


def test_training_set_sizes(spark):
    rows = spark.range(5000).selectExpr(
        "id", "CAST(id < 100 AS INT) AS y", "CASE WHEN id % 10 = 0 THEN 0.95D ELSE 0.1D END AS sim_jw_lastname", "0.5D AS sim_jw_fullname", "CAST(id % 4 = 1 AS INT) AS org_vs_person_conflict"
    )
    sizes = lambda **k: {r.origin: r["count"] for r in learning.training_set(rows, "id", **k).groupBy("origin").count().collect()}
    assert sizes() == {"positive": 100, "hard": 490, "random": 500, "org_person": 1000}  # 490 hard ones there are
    assert sizes(cap=300) == {"positive": 100, "hard": 100, "random": 100, "org_person": 200}
    assert sizes(cap=50) == {"positive": 100}
