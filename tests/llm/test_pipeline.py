"""Stages of the corpus pipeline on planted documents."""

import collections
import os
import random
import re
import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from tether.llm import mixing, near_copies, packing, quality_classifier, quality_rules
from tether.llm.common import materialize, table


def made(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def prose(rng, n, vocabulary):
    return " ".join(f"{rng.choice('bdfglm')}{rng.choice('aeiou')}word{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}{chr(97 + k // 676)}" for k in (rng.randrange(vocabulary) for _ in range(n)))


def test_quality_rules_stage_keeps_long_clean_text(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(60, 300), 60), "en", "a") for i in range(250)]
    rows += [(500, prose(rng, 20000, 60), "en", "a"), (501, "good words here " + " ".join(rng.choice(["up", "to", "it"]) for _ in range(200)), "en", "a")]
    kept = {r.doc_id for r in corpus_pipeline.quality_rules_stage(spark, made(spark, rows), "").collect()}
    assert kept == {*range(250), 500}


def test_classifier_stage_learns_from_rows_that_were_filtered_before(spark, tmp_path):
    rng = random.Random(6)
    junk = lambda: " ".join(rng.choice(["click", "win", "cash", "now", "free"]) + "!" for _ in range(80))
    rows = [(i, prose(rng, 80, 300) if i % 2 else junk(), "en", "a") for i in range(600)]
    made(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(500)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    left = [r for r in rows if r[0] % 2 or r[0] >= 500]  # no row labelled bad is left
    kept = {r.doc_id for r in corpus_pipeline.quality_classifier_stage(spark, made(spark, left), str(tmp_path)).collect()}
    assert kept == {i for i in range(600) if i % 2}


def five_words(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} or {" ".join(w)}


def test_near_duplicates_stage_finds_pairs_of_similarity_0_8(spark):
    rng = random.Random(8)
    rows = []
    for i in range(60):  # one to ten words of 200 are changed; each takes five shingles with it
        words = prose(rng, 200, 3000).split()
        rows.append((2 * i, " ".join(words), "en", "a"))
        for at in rng.sample(range(200), 1 + i // 6):
            words[at] = f"changed{i}x{at}"
        rows.append((2 * i + 1, " ".join(words), "en", "a"))
    same = lambda a, b: len(five_words(a) & five_words(b)) * 5 >= 4 * len(five_words(a) | five_words(b))
    far = [i for i in range(60) if not same(rows[2 * i][1], rows[2 * i + 1][1])]
    assert 5 < len(far) < 55
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates_stage(spark, made(spark, rows), "").collect()}
    assert kept == {2 * i for i in range(60)} | {2 * i + 1 for i in far}


def test_near_duplicates_of_close_families_equal_brute_force(spark, monkeypatch):
    """Families of texts around an original, with short texts and copies; all groups, also where they are dealt once more."""
    rng = random.Random(10)
    rows = []
    for _ in range(12):
        base = prose(rng, rng.choice([8, 30, 120]), 2000).split()
        for _ in range(rng.choice([3, 25])):
            words = list(base)
            for at in rng.sample(range(len(words)), rng.randint(0, len(words) // 25 + 1)):
                words[at] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + k, rows[k][1].upper()) for k in range(10)]
    sets = [five_words(t.lower()) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j]) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    docs = made(spark, [(i, t, "en", "a") for i, t in rows])
    assert {r.doc_id for r in near_copies.keep_one(docs).collect()} == set(group)
    monkeypatch.setattr(near_copies, "CROWD", 5)
    monkeypatch.setattr(near_copies, "SHARD", 16)
    kept = {r.doc_id for r in near_copies.keep_one(docs).collect()}
    assert set(group) <= kept and len(kept - set(group)) <= 2


def test_near_duplicates_stage_keeps_texts_without_or_under_the_same_id(spark):
    rng = random.Random(9)
    a, b, c, d, e = (prose(rng, 100, 3000) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (1, c), (1, d), (2, c), (None, d + " end"), (3, e), (3, e), (None, None), (None, "")]
    stage = corpus_pipeline.near_duplicates_stage
    kept = stage(spark, made(spark, [(i, t, "en", "a") for i, t in rows]), "")
    assert kept.columns == ["doc_id", "text", "lang", "source"]
    found = sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str)
    assert found == sorted([(None, a), (None, b), (1, c), (1, d), (3, e), (None, "")], key=str)
    assert stage(spark, made(spark, []), "").count() == 0


ODD = [(None, "null id " * 30), (None, None), (3, ""), (4, "short"), (5, "la " * 30000), (5, "another text under five " * 20), (6, "same words here " * 20), (6, "same words here " * 20)]


def odd(spark, rows=ODD):
    """Rows with nulls, empties, repeats and a very long text, and columns whose names stages use themselves."""
    docs = spark.createDataFrame([(*r, None if i % 3 else "en", None if i % 4 else "a") for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    return docs.selectExpr("*", "1 AS kept", "2 AS size", "'x' AS cut", "3 AS n", "4 AS component", "5 AS score", "6 AS key", "'t' AS t", "7 AS h", "8 AS copies", "9 AS piece", "10 AS length")


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows(spark, tmp_path, empty):
    docs = odd(spark).limit(0) if empty else odd(spark)
    odd(spark).select("doc_id", "text", "lang", "source").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(4, 0, 0), (5, 1, 0), (None, 1, 1), (6, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = collections.Counter((r.doc_id, r.text) for r in docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns or name == "best-fit packing"
        found = got.collect()
        if empty:
            assert not found
            continue
        have = collections.Counter((r.doc_id, r.text) for r in found) if name != "best-fit packing" else None
        if name in ("quality rules", "quality classifier"):  # repeated rows share a fate
            assert all(have[k] in (0, n) for k, n in rows.items()) and set(have) <= set(rows)
        elif name == "SimHash near-duplicates":
            assert have == {k: 1 for k in rows if k != (None, None)}  # a null text equals an empty one, and a row with id goes first
        elif name == "mixing":
            assert set(have) <= set(rows) and all(have[k] <= 3 * rows[k] for k in have)
        else:
            assert sorted({str(r.doc_id) for r in found}) == sorted({str(k[0]) for k in rows}) and max(r.offset + r.length for r in found) <= packing.CAPACITY


def test_pipeline(spark):
    """Every stage on what the one before kept, each against a plain version of it."""
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "SimHash near-duplicates", "mixing", "best-fit packing"]
    outs = []
    for _, stage in corpus_pipeline.STAGES:
        outs.append(materialize(stage(spark, docs, sf), "stage"))
        docs = outs[-1]
    first, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    assert all(o.columns == first.columns for o in outs[:4])
    want = {r.doc_id for r in quality_rules.quality_rules(first).collect() if r.kept}
    assert {r.doc_id for r in outs[0].collect()} == want
    machine = quality_classifier.fit(first, labels)
    assert {r.doc_id for r in outs[1].collect()} == {r.doc_id for r in outs[0].collect() if machine.score(*machine.inputs(*quality_classifier.features(r.text))) >= 0.5}
    texts = {r.doc_id: five_words(lowered(r.text)) for r in outs[1].collect()}
    ids = sorted(texts)
    group = {i: i for i in ids}
    for b in ids:
        for a in ids:
            if a < b and group[a] != group[b] and len(texts[a] & texts[b]) * 5 >= 4 * len(texts[a] | texts[b]):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    assert len(set(group.values())) < len(ids) and {r.doc_id for r in outs[2].collect()} == set(group.values())
    sizes = mixing.word_sizes(outs[2])
    taken = {r.doc_id: r.copies for r in mixing.place(sizes, sizes["size"], mixing.plan(sizes)).collect()}
    assert collections.Counter(r.doc_id for r in outs[3].collect()) == collections.Counter(taken)
    used = outs[4].groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in used) <= packing.CAPACITY and len(used) == -(-sum(r[1] for r in used) // packing.CAPACITY)
    assert collections.Counter(r.doc_id for r in outs[4].where("piece = 0").collect()) == collections.Counter(taken)
    full = corpus_pipeline.run(spark, sf)
    assert full.columns == outs[4].columns and full.count() == outs[4].count()
    clean = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(clean & {r.doc_id for r in outs[1].collect()}) >= 0.95 * len(clean)


def test_stages_on_texts_that_are_no_utf8(spark, tmp_path):
    """Strings with such bytes pass all stages: each stays itself, and a near-copy of it is one."""
    rng = random.Random(5)
    words = [" ".join(prose(rng, 60, 4000).split()) for _ in range(20)]
    rows = [(i, t.encode()) for i, t in enumerate(words)] + [(30, words[0].encode() + b" caf\xe9"), (31, words[1].encode() + b" \xff\xc3"), (32, b"\xe9 \xe8 " * 30), (33, b"\xe8 \xe9 \xe8 " * 30)]
    raw = spark.createDataFrame(rows, "doc_id long, text binary").selectExpr("doc_id", "cast(text AS string) AS text", "'en' AS lang", "'a' AS source")
    raw.write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(20).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality", "0 AS toxic").write.parquet(f"{tmp_path}/labels.parquet")
    docs = table(spark, str(tmp_path), "documents")
    want = {"SimHash near-duplicates": {*range(20), 32, 33}, "best-fit packing": {r[0] for r in rows}}
    machine = quality_classifier.fit(docs, table(spark, str(tmp_path), "labels"))
    want["quality classifier"] = {i for i, t in rows if machine.score(*machine.inputs(*quality_classifier.features(t))) >= 0.5}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, str(tmp_path)).selectExpr("doc_id", "length" if name == "best-fit packing" else "cast(text AS binary)").collect()
        if name in want:
            assert {r.doc_id for r in got} == want[name]
        if name == "quality classifier":  # the bytes stay as they were
            assert all(bytes(r.text) == dict(rows)[r.doc_id] for r in got)
    for text in words[:3] + ["gr\u00fc\u00dfe \u4e2d\u6587 \u20ac", ""]:
        assert all((a == b).all() for a, b in zip(quality_classifier.features(text), quality_classifier.features(text.encode()), strict=True))


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_stages_by_themselves_bring_the_package_to_workers(tmp_path):
    """Workers that find the package neither in their folder nor in PYTHONPATH."""
    code = f"""
import sys
sys.path.insert(0, {str(Path(corpus_pipeline.__file__).parent)!r})
from corpus_pipeline import STAGES
from tether.session import local_session
spark = local_session(2)
sf = "/root/testdata/sf0.001"
docs = spark.read.parquet(sf + "/documents.parquet").limit(50)
for name, stage in STAGES[1:3]:
    print(name, stage(spark, docs, sf).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert [x.split()[-1] > "0" for x in run.stdout.splitlines()] == [True, True]
