"""Document operators against brute-force versions, with nulls, empty and long texts, repeated rows and clashing columns."""

import collections
import random
import re

import numpy as np
import pytest
import xxhash

from tether.llm import mixing, quality_classifier, quality_rules, simhash_dedup
from tether.llm.common import materialize
from tether.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHES = ["1 AS size", "'x' AS kept", "0.5D AS rate", "2 AS n_words", "3 AS target", "'y' AS fp", "1 AS score", "4 AS __w", "5 AS __size", "6 AS cut", "7 AS n"]


def make(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", *CLASHES)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    out = [(i, text(rng.randint(5, 120)), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None])) for i in range(300)]
    out += [(300 + i, " ".join(w + "###" for w in text(60).split()), "en", "a") for i in range(15)]
    out += [(320 + i, (text(12) + "\n") * 9, "en", "b") for i in range(15)]
    out += [(340, None, "en", "a"), (341, "", None, None), (342, " \n\t", "de", "b"), (None, text(50), "en", "a"), (343, text(30000), "en", "c")]
    out += [(344, "la " * 25000, "en", "c"), (7, out[7][1], out[7][2], out[7][3]), (7, out[7][1], out[7][2], out[7][3])]
    base = text(300)
    out += [(400 + i, base + (f" end{i}" if i else ""), "en", "a") for i in range(6)]
    return out


def plain_measures(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = collections.defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    covered = {i + k for own in at.values() if len(own) > 1 for i in own for k in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def key(x):
    return str(x)


def test_quality_rules(spark, rows):
    docs = make(spark, rows)
    got = quality_rules.quality_rules(docs).collect()
    want = sorted(((r[0], *plain_measures(r[1])) for r in rows), key=key)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=key) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept)
    kept = {r.doc_id: r.kept for r in got}
    assert not any(kept[300 + i] for i in range(15)) and not any(kept[320 + i] for i in range(15))
    clean = [r for r in got if r.doc_id is not None and r.doc_id < 300 and not r.base_failed]
    assert sum(r.kept for r in clean) == len(clean)
    filtered = quality_rules.keep_good(docs)
    assert filtered.columns == docs.columns
    assert sorted((r.doc_id for r in filtered.collect()), key=key) == sorted((r.doc_id for r in got if r.kept), key=key)
    assert quality_rules.quality_rules(docs.limit(0)).count() == 0 and quality_rules.keep_good(docs.limit(0)).count() == 0


def plain_cut(values, spread=14):
    """The cut-off of one large group of whole-table size, from exact quantiles."""
    v = sorted(values)
    q1, q2 = v[-(-len(v) // 4) - 1], v[-(-len(v) * 2 // 4) - 1]
    return (q2 + 1) * max((q2 + 1) / (q1 + 1), 1 + 1 / 64) ** spread - 1


def test_cutoffs_follow_the_data(spark):
    rng = random.Random(12)
    word = lambda a, b: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(a, b)))
    text = lambda a, b, marks: " ".join(word(a, b) + ("," if rng.random() < marks else "") for _ in range(150))
    rows = [(i, text(2, 8, 0.05), "en", "plain") for i in range(300)]
    rows += [(1000 + i, text(4, 16, 0.3), "en", "code") for i in range(300)]  # long words and many marks are usual here
    han = lambda: "\n".join("".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(300)) for _ in range(25))
    rows += [(2000 + i, han(), "zh", "web") for i in range(300)]
    rows += [(3000, text(4, 16, 0.3), "en", "plain"), (3001, text(2, 8, 0.05) + " # * # *" * 60, "en", "code"), (3002, text(2, 8, 0.05).upper(), "en", "plain"), (3003, None, "en", "plain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs).collect()}
    clean = [i for i in got if i < 3000]
    assert sum(got[i] for i in clean) >= 0.99 * len(clean) and all(got[2000 + i] for i in range(300))
    assert not any(got[i] for i in (3000, 3001, 3002, 3003))
    measured = materialize(quality_rules.measure(docs), "measures")
    cuts = {(r.lang, r.source): r.cut for r in quality_rules.cutoffs(quality_rules.sketch(measured)).collect()}
    for name in ("other_ratio", "word_length"):  # no group has capitals
        assert len({round(c[name], 3) for c in cuts.values()}) == 3
    # the weight of a group's parent falls with the square of its size
    own = [r.word_length for r in measured.where("lang = 'zh'").collect()]
    assert cuts["zh", "web"].word_length == pytest.approx(plain_cut(own), rel=0.15)
    many = quality_rules.sketch(measured.unionByName(measured.limit(0)))
    parts = quality_rules.sketch(measured.where("doc_id % 2 = 0")).unionByName(quality_rules.sketch(measured.where("doc_id % 2 = 1")))
    assert {(r.lang, r.source): r.cut for r in quality_rules.cutoffs(parts).collect()} == {(r.lang, r.source): r.cut for r in quality_rules.cutoffs(many).collect()}


def test_a_lone_odd_document_is_judged_by_its_language(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    text = lambda end: " ".join(word() + end for _ in range(150))
    rows = [(i, text(""), "en", "a") for i in range(300)] + [(400, text("###"), "en", "b"), (401, text(""), "en", "c"), (402, text(""), None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs).collect()}
    assert not got[400] and got[401] and got[402]


def plain_fingerprint(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(nodes, linked):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("shard", [2000, 3])
def test_simhash(spark, rows, shard, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "SHARD", shard)
    docs = make(spark, rows)
    got = simhash_dedup.simhash_dedup(docs).collect()
    fps = [plain_fingerprint(r[1]) for r in rows]
    group = plain_groups(range(len(rows)), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[group[k]] = min(r[0], least.get(group[k], r[0]))
    want = [(r[0], f"{fps[k]:016x}", least.get(group[k])) for k, r in enumerate(rows)]
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=key) == sorted(want, key=key)
    assert simhash_dedup.simhash_dedup(docs.limit(0)).count() == 0


def test_simhash_rows_without_id_bridge_groups(spark):
    texts = {}
    for k in range(4000):  # texts that differ in a word or two, by fingerprint
        words = [f"w{i}" for i in range(40)]
        words[k % 40] = f"x{k}"
        texts.setdefault(plain_fingerprint(" ".join(words)), " ".join(words))
    far = lambda a, b: (a ^ b).bit_count()
    some = sorted(texts)[:700]
    a, m, b = next((a, m, b) for m in some for a in some for b in some if far(a, m) <= 3 and far(m, b) <= 3 and far(a, b) > 3)
    rows = [(7, texts[a]), (None, texts[m]), (9, texts[b]), (None, "quite another text"), (11, "one more text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash_dedup.simhash_dedup(docs).collect()), key=key)
    assert got == sorted([(7, 7), (None, 7), (9, 7), (None, None), (11, 11)], key=key)


def test_trie_join_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    values = []
    for _ in range(150):
        x = int(rng.integers(0, 2**63))
        for _ in range(4):
            y = x
            for k in rng.integers(0, 64, int(rng.integers(0, 5))):
                y ^= 1 << int(k)
            values.append(y)
    v = np.unique(np.array(values, np.uint64))
    got = {p for i, j in simhash_dedup.trie_join(v) for p in zip(i.tolist(), j.tolist(), strict=True)}
    far = np.bitwise_count(v[:, None] ^ v[None, :])
    assert got == {(i, j) for i, j in zip(*np.nonzero(far <= 3), strict=True) if i < j}
    signed = v.view(np.int64).tolist()
    classes = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = plain_groups(range(len(v)), lambda a, b: far[a, b] <= 3)
    for shard in (2000, 2):  # 2: nearly every shard is divided
        found = {r.node: r.component for r in components(simhash_dedup.near_links(classes, shard)).collect()}
        mine = [found.get(x, x) for x in signed]
        assert all((mine[a] == mine[b]) == (want[a] == want[b]) for a in want for b in want)


def test_trie_join_of_wide_values_in_several_tries(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, (40, 2)).astype(np.uint64)
    rows = np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, (40, 2)).astype(np.uint64)) for _ in range(6)])
    rows[5] = rows[6]  # equal values are pairs too
    keys = rng.integers(0, 3, len(rows))
    order = np.lexsort((rows[:, 1], rows[:, 0], keys))
    rows, keys = rows[order], keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    far = np.bitwise_count(rows[:, None] ^ rows[None]).sum(axis=2)
    want = {(i, j) for i, j in zip(*np.nonzero((far <= 3) & (keys[:, None] == keys[None])), strict=True) if i < j}
    for leaf in (1, 4, 500):
        found = [p for i, j in simhash_dedup.trie_join(rows, 3, starts, leaf) for p in zip(i.tolist(), j.tolist(), strict=True)]
        assert len(found) == len(set(found)) and set(found) == want
    forest = simhash_dedup.Forest(len(rows))
    for i, j in simhash_dedup.trie_join(rows, 3, starts, 4, forest.groups):
        forest.join(i, j)
    group = plain_groups(range(len(rows)), lambda a, b: (a, b) in want)
    assert forest.groups().tolist() == list(group.values())


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 200), (200, 300), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {200: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in over}


def test_mixing(spark, rows):
    docs = make(spark, rows + [(900, None, "en", "empty"), (901, "one small text", "en", "aa"), (902, "one", "en", "ab")])
    sizes = mixing.word_sizes(docs)
    planned = mixing.plan(sizes)
    got = mixing.place(docs, quality_size(), planned).collect()
    own = collections.Counter()
    for r in docs.collect():
        own[r.source] += len(WORD.findall(r.text or ""))
    targets = plain_targets(own)
    taken, largest = collections.Counter(), collections.Counter()
    for r in got:
        assert r.source_size == own[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3 and r["rate"] is not None
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in own)
    again = mixing.place(docs.repartition(7), quality_size(), mixing.plan(mixing.word_sizes(docs.repartition(5)))).collect()
    assert collections.Counter((r.doc_id, r.copies) for r in again) == collections.Counter((r.doc_id, r.copies) for r in got)
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.mixture(docs.limit(0)).count() == 0


def quality_size():
    from pyspark.sql import functions as F

    from tether.llm.common import n_words

    return n_words(F.col("text"))


def test_classifier_holds_out_and_learns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    machine = quality_classifier.fit(docs, labels)
    got = quality_classifier.score(docs, machine).join(labels, "doc_id").where("held_out").toPandas()
    good, bad = got[got.quality == 1].score, got[got.quality == 0].score
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97 and (good >= 0.5).mean() > 0.97


def test_classifier_edges(spark, rows):
    import zlib

    docs = make(spark, rows)
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(350)] + [(5, None, 0), (5, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    machine = quality_classifier.fit(docs, labels, sample=150)
    got = quality_classifier.score(docs, machine).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    kept = quality_classifier.keep_good(docs, labels, sample=150)
    assert kept.schema == docs.schema and kept.count() == sum(r.predicted for r in got)
    none = quality_classifier.fit(docs, labels.limit(0))
    assert {r.score for r in quality_classifier.score(docs, none).collect()} == {0.5}
    assert quality_classifier.score(docs.limit(0), machine).count() == 0


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    m = quality_classifier.Machine(0.3, rng.normal(size=6), rng.normal(size=(6, 3)), None, None)
    x = rng.normal(size=6)
    z = 0.3 + m.weights @ x + sum(m.vectors[i] @ m.vectors[j] * x[i] * x[j] for i in range(6) for j in range(i + 1, 6))
    assert m.score(np.arange(6), x) == pytest.approx(1 / (1 + np.exp(-z)))
