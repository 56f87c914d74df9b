"""Embeddings, urls and conversations."""

import random

import numpy as np
import pytest

from tether.llm import chat_format, embedding_dedup, url_filters

NAN, INF = float("nan"), float("inf")


def plain_links(rows):
    n = len(rows)
    linked = np.zeros((n, n), bool)

    def usable(v, label):
        return label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    for i in range(n):
        for j in range(n):
            (_, a, x), (_, b, y) = rows[i], rows[j]
            if i != j and usable(a, x) and usable(b, y) and x == y and len(a) == len(b):
                p, q = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
                linked[i, j] = p @ q / np.linalg.norm(p) / np.linalg.norm(q) >= 0.93
    return linked


def joined(rows, linked):
    """The smallest id that each row reaches; null where no row of its group has one."""
    group = list(range(len(rows)))
    while True:
        before = list(group)
        for i in range(len(rows)):
            for j in np.flatnonzero(linked[i]):
                group[i] = group[j] = min(group[i], group[j])
        if group == before:
            break
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[group[i]] = min(r[0], least.get(group[i], r[0]))
    return [least.get(g) for g in group]


@pytest.mark.parametrize("small", [False, True])
def test_embeddings(spark, small, monkeypatch):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(25):
        centre = rng.normal(size=24)
        for k in range(6):
            rows.append((len(rows), [float(x) for x in np.float32(centre + rng.normal(size=24) * 0.08 * k)], g % 2))
    rows += [(len(rows) + i, rows[3][1], rows[3][2]) for i in range(8)]  # copies
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 24, 1), (503, [NAN] + [1.0] * 23, 1), (504, [INF] + [1.0] * 23, 1)]
    rows += [(505, [None] + [1.0] * 23, 1), (506, rows[0][1], None), (507, [1.0, 2.0], 0), (508, [2.0, 4.0], 0), (3, rows[3][1], rows[3][2])]
    rows += [(None, rows[6][1], rows[6][2]), (None, [1e-30] * 24, 1), (None, [3.0] * 24, 1), (509, [3e30] * 23 + [2.9e30], 0)]
    turn = lambda t: [float(np.cos(t)), float(np.sin(t))] + [0.0] * 22
    # a row without id between two rows that are too far from each other
    rows += [(600, turn(-0.3), 5), (None, turn(0.0), 5), (601, turn(0.3), 5)]
    linked = plain_links(rows)
    assert not linked[-1, -3] and linked[-1, -2] and linked[-2, -3]
    want = sorted(((r[0], int(linked[i].sum()), c) for i, (r, c) in enumerate(zip(rows, joined(rows, linked), strict=True))), key=str)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS n", "2 AS rep", "3 AS near", "4 AS node", "5 AS width")
    if small:  # small cells: several tables, and candidate groups that are dealt once more; found with its stated probability
        monkeypatch.setattr(embedding_dedup, "CELL", 16)
        monkeypatch.setattr(embedding_dedup, "CROWD", 4)
    got = embedding_dedup.embedding_dedup(df)
    found = sorted(((r.vec_id, r.n_links, r.component_id) for r in got.collect()), key=str)
    if small:
        assert sum(x[1] for x in found) >= 0.98 * sum(x[1] for x in want) and all(x[1] <= y[1] for x, y in zip(found, want, strict=True))
    else:
        assert found == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect() if r.vec_id is not None)
    assert embedding_dedup.embedding_dedup(df.limit(0)).count() == 0


def test_collisions_are_counted_right():
    rng = np.random.default_rng(0)
    levels = rng.integers(4, 12, (300, embedding_dedup.LINES)).astype(np.uint8)
    levels[150:] = np.clip(levels[:150] + rng.integers(-3, 4, (150, embedding_dedup.LINES)), 0, 15)
    assert (embedding_dedup.unpacked(embedding_dedup.packed(levels)) == levels).all()
    hits = np.abs(levels[:, None].astype(int) - levels[None]) <= embedding_dedup.WINDOW
    for least in (20, 26, embedding_dedup.LINES):
        pairs = lambda yes: {(i, j) for i, j in zip(*np.nonzero(yes), strict=True) if i < j}
        counted, windowed = pairs(hits.sum(-1) >= least), pairs((hits.sum(-1) >= least) & hits[..., 0])
        found = [tuple(sorted(p)) for i, j in embedding_dedup.colliding(levels, least) for p in zip(i.tolist(), j.tolist(), strict=True)]
        assert len(found) == len(set(found)) and windowed <= set(found) <= counted


def pairs_at(rng, n, cosine, size=64):
    x = rng.normal(size=(n, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=(n, size))
    y -= (y * x).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    return x, cosine * x + np.sqrt(1 - cosine**2) * y


def test_the_sorted_line_and_the_tables_leave_next_to_no_pair_out():
    """Of planted links just above the threshold, as good as all count in a cell, and as good as all meet in a cell."""
    x, y = pairs_at(np.random.default_rng(5), 2000, 0.9301)
    found = np.zeros(2000, bool)
    for i, j in embedding_dedup.verified_links(np.concatenate([x, y])):
        low, high = np.minimum(i, j), np.maximum(i, j)
        found[low[high == low + 2000]] = True
    assert found.sum() >= 1995
    signs = [embedding_dedup.projected(v)[0] for v in (x, y)]
    for bits in (2, 4, 8):
        a, b = (embedding_dedup.tables().keys(s, bits, np.zeros(2000, np.uint64)) for s in signs)
        assert (a == b).any(axis=1).sum() >= 1990


def test_recall_at_the_threshold(spark):
    """5,000 planted links at cosines from 0.9301 up among 20,000 vectors of one label, with its hot cells: at least 0.95 are found."""
    rng = np.random.default_rng(1)
    x, y = pairs_at(rng, 5000, 0.9301)
    less, more = pairs_at(rng, 2500, 0.9299)
    rest = rng.normal(size=(5000, 64))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([x, y, less, more, rest]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.embedding_dedup(df).collect()}
    assert sum(got[5000 + i] == (1, i) for i in range(5000)) >= 0.95 * 5000
    assert all(got[i] == (0, i) for i in range(10000, 20000))


def test_stated_url_rules(spark):
    cases = [
        ("http://a.EXAMPLE.com/en/7x?q#f", "a.example.com", "/en/7x", "example.com/en/7", "allow"),
        ("https://x.com/en/8", "x.com", "/en/8", "com/en/", "block"),
        ("https://com/en/", "com", "/en/", "com/en/", "block"),
        ("https://mycom/en/", "mycom", "/en/", None, "allow"),
        ("https://www.example.net/de/81", "www.example.net", "/de/81", "example.net/de/8", "block"),
        ("https://net?x=/de/", "net", "", None, "allow"),
        ("//no.scheme/en/", "", "", None, "allow"),
        ("ftp://É.Org/es/#", "É.org", "/es/", "org/es/", "block"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, c[0], "h") for i, c in enumerate(cases)] + [(0, cases[0][0], "h"), (None, cases[1][0], "h")], "page_id long, url string, rule string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = url_filters.url_filters(pages, labels).collect()
    want = [(i, *c[1:]) for i, c in enumerate(cases)]
    assert sorted(map(tuple, got), key=str) == sorted([*want, (0, *cases[0][1:]), (None, *cases[1][1:])], key=str)
    assert url_filters.url_filters(pages.limit(0), labels).count() == 0


def test_mined_url_rules(spark):
    pages = [(i, f"http://{'bets' if i % 4 == 0 else 'news'}.site{i % 3}.info/p/{i}?ref={i % 2}") for i in range(400)]
    # bets with ref=0 are bad: every fourth page; and so are a few others by chance
    labels = [(i, int(i % 4 != 0), 0) for i in range(300)] + [(1, 1, 1), (1, 1, 0), (2, None, None)]
    got = url_filters.url_filters(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    ).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == {i for i, _ in pages if i % 4 == 0} and len(got) == 400


def test_chat_pairs(spark):
    rows = [
        (0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (0, 2, "user", "and?"), (0, 3, "assistant", "no"),
        (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "and?"), (1, 3, "assistant", "maybe\n"), (1, 4, None, None),
        (2, 0, "user", "same"), (3, 0, "user", "same"),
        (4, 0, "user", "alone"),
    ]
    df = spark.createDataFrame([(c // 2, c % 2 == 0, c, *x) for c, *x in rows] + [(None, True, 9, 0, "user", "x")], "pair_id long, chosen boolean, conv_id long, turn long, role string, text string")
    got = {r.pair_id: r for r in chat_format.format_preferences(df).collect()}
    a = got[0]
    assert (a.n_shared, a.prompt) == (3, "<|user|>\nhi\n<|assistant|>\nyes\n<|user|>\nand?\n")
    assert a.chosen == "<|assistant|>\nno\n" and [a.chosen[m.start : m.end] for m in a.chosen_mask] == ["no\n"]
    assert a.rejected == "<|assistant|>\nmaybe\n\n<||>\n\n" and [a.rejected[m.start : m.end] for m in a.rejected_mask] == ["maybe\n\n"]
    assert (got[1].n_shared, got[1].chosen, got[1].rejected) == (1, "", "")
    assert (got[2].n_shared, got[2].rejected_id, got[2].rejected) == (0, None, "") and got[2].chosen == "<|user|>\nalone\n"
    assert len(got) == 3 and chat_format.format_preferences(df.limit(0)).count() == 0


def test_chat_conversations_of_a_side_are_paired_by_rank(spark):
    rows = [(7, True, 5, "user", "q"), (7, True, 5, "assistant", "one"), (7, True, 3, "user", "q"), (7, True, 3, "assistant", "two")]
    rows += [(7, False, 9, "user", "q"), (7, False, 9, "assistant", "bad"), (8, None, 1, "user", "q"), (9, True, 2, "assistant", "x" * 300_000), (9, False, None, "assistant", "x" * 300_000)]
    rows += [(9, False, 4, "user", "only"), (9, False, 4, "user", "only")]
    df = spark.createDataFrame([(p, c, i, k % 2, r, t, "?") for k, (p, c, i, r, t) in enumerate(rows)], "pair_id long, chosen boolean, conv_id long, turn long, role string, text string, prompt string")
    got = sorted(((r.pair_id, r.chosen_id, r.rejected_id, r.n_shared, r.chosen[:30], r.rejected[:30]) for r in chat_format.format_preferences(df).collect()), key=str)
    want = [
        (7, 3, 9, 1, "<|assistant|>\ntwo\n", "<|assistant|>\nbad\n"),
        (7, 5, None, 0, "<|user|>\nq\n<|assistant|>\none\n", ""),
        (9, 2, None, 1, "", ""),
        (9, None, 4, 0, "", "<|user|>\nonly\n<|user|>\nonly\n"),
    ]
    assert got == sorted(want, key=str)


def test_chat_prefixes_of_many_pairs_equal_brute_force(spark):
    rng = random.Random(3)
    talk = lambda n: [(k, ("user", "assistant")[k % 2], f"turn {rng.randrange(3)}") for k in range(n)]
    pairs, rows = {}, []
    for p in range(300):
        a = talk(rng.randint(0, 9))
        cut = rng.randint(0, len(a))
        b = a[:cut] + [(k, r, t) for k, r, t in talk(rng.randint(0, 9)) if k >= cut]
        pairs[p] = a, b
        rows += [(p, True, 2 * p, *x) for x in a] + [(p, False, 2 * p + 1, *x) for x in b]
    df = spark.createDataFrame(rows, "pair_id long, chosen boolean, conv_id long, turn int, role string, text string").repartition(13)
    got = {r.pair_id: r for r in chat_format.format_preferences(df).collect()}
    assert sorted(got) == [p for p, (a, b) in pairs.items() if a or b]
    show = lambda turns: "".join(f"<|{r}|>\n{t}\n" for _, r, t in turns)
    shares = 0
    for p, r in got.items():
        a, b = pairs[p]
        n = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x[1:] != y[1:]), min(len(a), len(b)))
        assert (r.n_shared, r.prompt, r.chosen, r.rejected) == (n, show(a[:n]), show(a[n:]), show(b[n:]))
        assert [r.chosen[m.start : m.end] for m in r.chosen_mask] == [f"{t}\n" for _, role, t in a[n:] if role == "assistant"]
        shares += n > 0
    assert shares > 100
