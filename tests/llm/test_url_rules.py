"""Mined url rules: of many tokens, against the base rate and chance, and on odd urls."""

import itertools
import random

from tether.llm import url_filters


def test_rules_of_four_tokens_are_mined_and_larger_ones_pruned(spark):
    # every mix of five path parts; only urls that hold the first four are bad
    mixes = [m for m in itertools.product((0, 1), repeat=5) for _ in range(10)]
    urls = [(i, "http://h.info/" + "/".join(f"{'abcde'[k]}x" if on else f"{'abcde'[k]}y" for k, on in enumerate(m))) for i, m in enumerate(mixes)]
    bad = {i for i, m in enumerate(mixes) if all(m[:4])}
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i not in bad), 0) for i, _ in urls], "doc_id long, quality int, toxic int")
    got = url_filters.url_filters(pages, labels).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == bad and len(got) == len(urls)
    tokens = [(i, ["a", "b", "c", "d", *"ef"[: i % 3]], True) for i in range(60)]
    tokens += [(100 + i, x, False) for i, x in enumerate(x for x in (["a", "b", "c"], ["a", "b", "d"], ["a", "c", "d"], ["b", "c", "d"]) for _ in range(60))]
    rules = url_filters.mine(spark.createDataFrame(tokens, "rid long, tokens array<string>, bad boolean")).collect()
    assert {r.rule_id for r in rules} == {"a\x01b\x01c\x01d", "e", "f"}


def judged(spark, pages, labels):
    got = url_filters.url_filters(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert sorted(r.page_id for r in got) == sorted(i for i, _ in pages)
    return {r.page_id for r in got if r.verdict == "block"}


def test_a_high_base_rate_blocks_nothing_by_itself(spark):
    rng = random.Random(1)
    pages = [(i, f"http://{rng.choice('abc')}.info/{rng.choice('xyz')}/{i}") for i in range(400)]
    labels = [(i, int(rng.random() > 0.7), 0) for i in range(300)]
    assert judged(spark, pages, labels) == set()
    assert judged(spark, pages, [(i, 0, 0) for i in range(300)]) == set()  # all bad: nothing tells good from bad
    worse = [(i, u + ("?spam" if i % 3 == 0 else "")) for i, u in pages]
    assert judged(spark, worse, [(i, 0 if i % 3 == 0 else 1 - y % 2, 0) for i, y, _ in labels]) == {i for i, _ in pages if i % 3 == 0}


def test_chance_tokens_make_no_rules(spark):
    rng = random.Random(2)
    pages = [(i, f"http://h{rng.randrange(80)}.info/p{rng.randrange(60)}/q{rng.randrange(40)}") for i in range(1200)]
    labels = [(i, int(rng.random() > 0.15), 0) for i in range(1000)]
    assert judged(spark, pages, labels) == set()


def test_long_repeated_queries_are_one_item(spark):
    query = "&".join(f"k{i}=v{i}" for i in range(200))  # as sets these would be 2 ** 200
    pages = [(i, f"http://a.info/{i}?{query if i % 5 == 0 else 'k1=v1'}") for i in range(500)] + [(9000, "http://a.info/9?" + query[:20]), (9001, "http://x.info/?k7=v7")]
    pages += [(0, pages[0][1])] * 300  # copies of one row
    assert judged(spark, pages, [(i, int(i % 5 != 0), 0) for i in range(400)]) == {i for i, u in pages if "k2=v2" in u or "k7=v7" in u}  # any of the tokens tells as much as all


def test_very_long_and_odd_urls(spark):
    pages = [(1, "http://a.org/es/" + "x/" * 200_000), (2, "http://" + "b." * 50_000 + "org"), (3, "://"), (4, "a://?#://x"), (None, None)]
    assert judged(spark, [p for p in pages if p[0]], []) == {1}
    df = spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id long, url string, host int, verdict string")
    got = {r.page_id: (r.host, r.verdict) for r in url_filters.url_filters(df, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()}
    assert got[None] == ("", "allow") and got[3] == ("", "allow") and got[4] == ("", "allow") and got[2][0].endswith("org")
