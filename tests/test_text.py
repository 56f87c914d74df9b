import pytest
from pyspark.sql import functions as F

from tether.functions import similarity as S
from tether.functions import text as T


def one(spark, expr, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(expr.alias("out")).first().out




@pytest.mark.parametrize(
    ("function", "text", "want"),
    [
        (T.norm, "A - B", "A  B"),
        (T.norm, None, ""),
        (T.norm, "  o'Connor\t x ", "OCONNOR X"),
        (T.normalize_text, None, None),
        (T.normalize_zip, "TX 78701-1234", "78701"),
        (T.normalize_zip, "123", None),
        (T.normalize_npi, "n1234567890", "1234567890"),
        (T.char_ngrams, "John", ["JOH", "OHN"]),
        (T.char_ngrams, "ab", ["AB"]),
        (T.char_ngrams, None, []),
        (T.street_simplify, "100 Main St Suite 5", "100 MAIN ST 5"),
        (T.first_initial, "john", "J"),
        (T.first_initial, "9x", ""),
        (T.norm_initial, "9x", "9"),
        (T.norm_key, "O'Connor", "OCONNO"),
        (T.last_key, "O'Connor", "O'CONN"),
        (T.zip3, "78701", "787"),
        (T.zip3, "7", ""),
        (T.soundex, "Ashcraft", "A226"),
        (T.soundex, "Pfister", "P236"),
        (T.soundex, "", ""),
        (T.soundex, None, ""),
        (T.is_org_like, "Austin Medical Group", 1),
        (T.is_org_like, "John Smith", 0),
        (T.suffix_token, "John Smith Jr", "JR"),
        (T.suffix_token, "John", ""),
        (T.credential_tokens, "md, PhD; xyz", ["MD", "PHD"]),
        (T.block_tokens, "Été d'été é-t", ["ÉTÉ", "DÉTÉ", "ÉT"]),
    ],
)
def test_text(spark, function, text, want):
    assert one(spark, function(F.col("a")), a=text) == want


def test_soundex_of_similar_names(spark):
    assert one(spark, T.soundex(F.col("a")), a="Smith") == one(spark, T.soundex(F.col("a")), a="Smyth")


def test_block_keys(spark):
    assert one(spark, T.norm_block_key(F.col("a"), F.col("b"), F.lit("SMITH")), a="tx", b="78701") == "TX|78701|SMITH"
    assert one(spark, T.block_key(F.col("a"), F.col("b")), a="CA", b=None) == "CA|"


@pytest.mark.parametrize(
    ("function", "a", "b", "want"),
    [
        (S.jaro_winkler, "", "", 1.0),
        (S.jaro_winkler, "John", "john", 1.0),
        (S.jaro_winkler, None, "John", 0.0),
        (S.jaro_similarity, "ABCDEF", "BCADEF", 0.9166666667),
        (S.jaro_winkler, "ABXXXXXX", "ABYYYYYYY", 0.5925925926),
        (S.jaro_similarity, "A", "B", 0.0),
        (S.lev_sim, "", "", 1.0),
        (S.lev_sim, "SMITH", "smith", 1.0),
        (S.lev_sim, "AAAAA", "ZZZZZ", 0.0),
        (S.lev_sim, None, "A", 0.0),
        (S.token_jaccard, "", "", 1.0),
        (S.token_jaccard, "AAA BBB", "CCC DDD", 0.0),
        (S.token_jaccard, "A B C", "b c d", 0.5),
        (S.zip_num_sim, "10001", "10101", 0.99),
        (S.zip_num_sim, "10001", "x", 0.0),
        (S.zip_num_sim, None, None, 0.0),
    ],
)
def test_similarity(spark, function, a, b, want):
    assert one(spark, function(F.col("a"), F.col("b")), a=a, b=b) == pytest.approx(want)


def test_jaro_against_brute_force():
    from hypothesis import given
    from hypothesis import strategies as st

    def plain(a, b):
        if a == b:
            return 1.0
        if not a or not b:
            return 0.0
        reach, left, used, order = max(len(a), len(b)) // 2 - 1, [], [], []
        for i in range(len(a)):
            for k in range(len(b)):
                if abs(i - k) <= reach and k not in used and a[i] == b[k]:
                    left.append(a[i])
                    used.append(k)
                    break
        order = [b[k] for k in sorted(used)]
        m = len(left)
        if not m:
            return 0.0
        return (m / len(a) + m / len(b) + (m - sum(x != y for x, y in zip(left, order, strict=True)) / 2) / m) / 3

    @given(st.text("ABC", max_size=8), st.text("ABC", max_size=8))
    def same(a, b):
        assert S.jaro(a, b) == pytest.approx(plain(a, b))

    same()


def _vectors(spark, kind, names, corpus):
    texts = spark.createDataFrame([(t,) for t in corpus], "name string")
    df = spark.createDataFrame([(n,) for n in names], "name string")
    made = S.tfidf_vectors(df, "name", F.col("name"), S.idf(F.col("name"), texts)) if kind == "words" else S.char3_vectors(df, "name", F.col("name"))
    return {r.name: r.vec for r in made.collect()}


@pytest.mark.parametrize("kind", ["words", "grams"])
def test_cosines(spark, kind):
    corpus = ["john smith", "mary jones", "general hospital"]
    v = _vectors(spark, kind, ["john smith", "", "zzz", "qqq"], corpus)
    cases = spark.createDataFrame(
        [("john smith", "john smith"), ("", ""), ("john smith", ""), ("zzz", "qqq")], "a string, b string"
    ).collect()
    m = "map<string,double>" if kind == "words" else "map<int,double>"
    df = spark.createDataFrame([(v[c.a], v[c.b]) for c in cases], f"a {m}, b {m}")
    got = [r.s for r in df.select(S.cosine(F.col("a"), F.col("b")).alias("s")).collect()]
    # two texts without any known word count as equal, as two empty ones do
    assert got == pytest.approx([1.0, 1.0, 0.0, 1.0 if kind == "words" else 0.0])
