"""Queries of text functions, similarities, features, blocking and entity resolution."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from ..operators import blocking, classes, entities, features, profile
from ..sources.io import materialize
from . import roles
from .registry import Registry
from .relational import JACCARD_SQL, LEFT_TOKENS, RIGHT_TOKENS, token_sides
from .roles import table

R = Registry()
LEFT, RIGHT, PAIRS = roles.LEFT, roles.RIGHT, roles.PAIRS


def left(spark, d):
    return roles.role(spark, d, LEFT)


def right(spark, d):
    return roles.role(spark, d, RIGHT)


_FIELDS = {"b": {"first_name": "first", "last_name": "last"}, "x": {"first_name": "first", "last_or_org_name": "last", "credentials": "cred"}}
_SHARED = {c: c for c in ("street1", "city", "state", "zip5")}
KEYS = [("b_state", "x_state"), ("b_zip5", "x_zip5")]


def pair_sides(spark, d):
    """The two sides of PAIRS, rows with the same KEYS are its pairs."""
    named = lambda df, s, also: df.select(*[F.col(a).alias(b) for a, b in also.items()], *[F.col(a).alias(f"{s}_{b}") for a, b in (_FIELDS[s] | _SHARED).items()])
    read = {"part": table(spark, d, "part")}
    return named(roles.role(spark, d, LEFT, read), "b", {"profile_id": "left_id", "npi": "left_npi", "n_years": "b_n_years"}), named(roles.role(spark, d, RIGHT, read), "x", {"npi": "right_id"})


def distinct_rows(spark, d, only, keep=()):
    """left_id, right_id, columns ``keep`` and features ``only`` of PAIRS; a row comes twice only if an id has several rows, and then again is true."""
    wanted = features.inputs(only) | {c for kv in KEYS for c in kv} | {"left_id", "right_id", *keep}
    sides = [df.select(*[c for c in df.columns if c in wanted]) for df in pair_sides(spark, d)]
    # dealt by id once: neither making rows distinct nor counting those of an id deals them again
    marked = [classes.repeated(df.repartition(f"{s}_id").distinct(), f"{s}_id", f"{s}_again") for df, s in zip(sides, ("left", "right"), strict=True)]
    needed = weights(spark, d) if {"sim_tfidf_name", "sim_char3_name"} & set(only) else None
    rows = features.block_rows(*marked, ["left_id", "right_id"], KEYS, needed, only, 9)
    return rows.select("left_id", "right_id", *keep, *only, (F.col("left_again") | F.col("right_again")).alias("again"))


def without_repeats(rows):
    """The distinct rows; only those of ids with several rows are compared."""
    return rows.where(~F.col("again")).drop("again").union(rows.where("again").drop("again").distinct())


def norm_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace(trim(upper(coalesce({c}, ''))), '\\s+', ' ', 'g'), '[^A-Z0-9 ]', '', 'g')"


def tokens_sql(c: str) -> str:
    return f"list_filter(string_split({norm_sql(c)}, ' '), lambda x: x <> '')"


# ---- text functions

URLS = "SELECT page_id, url FROM pages"


def _text(name: str, sql: str, rows: str, key: str, column: str, f):
    """A query of one text function over one column of a role."""

    @R.add(name, f"SELECT {key}, {sql} AS out FROM ({rows}) t")
    def _(spark, d):
        return roles.role(spark, d, rows).select(key, f(F.col(column)).alias("out"))


_text("str_1", norm_sql("url"), URLS, "page_id", "url", T.normalize_text)
_text("str_2", norm_sql("street1"), LEFT, "profile_id", "street1", T.norm)
_text("str_3", "nullif(regexp_extract(url, '(\\d{5})', 1), '')", URLS, "page_id", "url", T.normalize_zip)
_text("str_4", "nullif(regexp_extract(c_name, '(\\d{10})', 1), '')", "SELECT c_custkey, c_name || '0' AS c_name FROM customer", "c_custkey", "c_name", T.normalize_npi)
_text("str_5", f"array_to_string(list_sort(list_distinct({tokens_sql('street1')})), ' ')", LEFT, "profile_id", "street1", lambda c: F.array_join(F.sort_array(T.tokens_set(c)), " "))
_GRAM = lambda c: f"replace({norm_sql(c)}, ' ', '')"
_text(
    "str_6",
    f"CASE WHEN {_GRAM('last_name')} = '' THEN '' ELSE array_to_string(list_transform(range(1, greatest(length({_GRAM('last_name')}) - 1, 2)), lambda i: substr({_GRAM('last_name')}, i, 3)), ',') END",
    LEFT, "profile_id", "last_name", lambda c: F.array_join(T.char_ngrams(c), ","),
)
_STREET = lambda c: f"trim(regexp_replace(regexp_replace({norm_sql(c)}, '\\b({'|'.join(T.UNIT_WORDS)})\\b', '', 'g'), '\\s+', ' ', 'g'))"
_text("str_7", _STREET("street1"), LEFT, "profile_id", "street1", T.street_simplify)
_text("str_8", f"CASE WHEN length({norm_sql('zip5')}) >= 3 THEN substr({norm_sql('zip5')}, 1, 3) ELSE '' END", LEFT, "profile_id", "zip5", T.zip3)


def soundex_sql(c: str) -> str:
    code = {a: v for k, v in T.SOUNDEX_CODES.items() for a in k}
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 "
    codes = f"string_split(translate({norm_sql(c)}, '{letters}', '{''.join(code.get(a, '0') for a in letters)}'), '')"
    kept = f"array_to_string(list_filter({codes}, lambda x, i: i > 1 AND x <> {codes}[i - 1]), '')"
    return f"CASE WHEN {norm_sql(c)} = '' THEN '' ELSE substr(replace(substr({norm_sql(c)}, 1, 1) || {kept}, '0', '') || '000', 1, 4) END"


_text("str_9", soundex_sql("last_name"), LEFT, "profile_id", "last_name", T.soundex)
_list = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
org_sql = lambda c: f"CAST(list_has_any({tokens_sql(c)}, {_list(T.ORGANISATION_WORDS)}) AS INTEGER)"
suffix_sql = lambda c: f"coalesce(list_filter({tokens_sql(c)}, lambda x: x IN ({', '.join(repr(w) for w in T.SUFFIX_WORDS)}))[-1], '')"
cred_sql = lambda c: f"list_distinct(list_intersect({tokens_sql(c)}, {_list(T.CREDENTIAL_WORDS)}))"
_text("str_10", org_sql("last_or_org_name"), RIGHT, "npi", "last_or_org_name", T.is_org_like)
_text("str_11", suffix_sql("last_name"), LEFT, "profile_id", "last_name", T.suffix_token)
_text("str_12", f"array_to_string(list_sort({cred_sql('credentials')}), ' ')", RIGHT, "npi", "credentials", lambda c: F.array_join(F.sort_array(T.credential_tokens(c)), " "))


@R.add("str_13", """SELECT page_id, upper(url) AS up, substr(url, 1, 8) AS head, trim('  ' || page_id || ' ') AS stripped, replace(url, 'example', 'x') AS repl,
  regexp_extract(url, '://([^/]+)', 1) AS host, length(url)::INTEGER AS n, starts_with(url, 'https') AS secure, contains(url, 'page=') AS paged, concat(page_id, '-', substr(url, 1, 4)) AS tag FROM pages""")
def _(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select(
        "page_id",
        F.upper(u).alias("up"),
        F.substring(u, 1, 8).alias("head"),
        T.strip(F.concat(F.lit("  "), F.col("page_id").cast("string"), F.lit(" "))).alias("stripped"),
        F.replace(u, F.lit("example"), F.lit("x")).alias("repl"),
        F.regexp_extract(u, "://([^/]+)", 1).alias("host"),
        F.length(u).alias("n"),
        u.startswith("https").alias("secure"),
        F.contains(u, F.lit("page=")).alias("paged"),
        F.concat(F.col("page_id").cast("string"), F.lit("-"), F.substring(u, 1, 4)).alias("tag"),
    )


_initial = "regexp_replace(substr(upper(coalesce(first_name, '')), 1, 1), '[^A-Z]', '', 'g')"
_lastkey = "substr(trim(regexp_replace(upper(coalesce({}, '')), '\\s+', ' ', 'g')), 1, 6)"
_text("blk_k1", _initial, LEFT, "profile_id", "first_name", T.first_initial)
_text("blk_k2", _lastkey.format("last_name"), LEFT, "profile_id", "last_name", T.last_key)


@R.add("blk_k3", f"SELECT profile_id, coalesce(state, '') || '|' || coalesce(zip5, '') || '|' || coalesce(street1, '') AS k FROM ({LEFT}) t")
def _(spark, d):
    return left(spark, d).select("profile_id", T.block_key(F.col("state"), F.col("zip5"), F.col("street1")).alias("k"))


@R.add("blk_k4", f"SELECT profile_id, substr({norm_sql('street1')}, 1, 1) AS i, substr({norm_sql('last_name')}, 1, 6) AS l, {norm_sql('state')} || '|' || {norm_sql('zip5')} AS k FROM ({LEFT}) t")
def _(spark, d):
    return left(spark, d).select(
        "profile_id",
        T.norm_initial(F.col("street1")).alias("i"),
        T.norm_key(F.col("last_name")).alias("l"),
        T.norm_block_key(F.col("state"), F.col("zip5")).alias("k"),
    )


_text("blk_t", "array_to_string(list_distinct(list_filter(list_transform(string_split(trim(upper(coalesce(street1, ''))), ' '), lambda x: regexp_replace(x, '[^\\p{L}\\p{N}]', '', 'g')), lambda x: x <> '')).list_sort(), ' ')", LEFT, "profile_id", "street1", lambda c: F.array_join(F.sort_array(T.block_tokens(c)), " "))

# ---- similarities, over distinct pairs of names

NAMES = f"SELECT DISTINCT b_last AS a, x_last AS b FROM ({PAIRS}) q"
TWO = f"SELECT DISTINCT b_first || ' ' || b_last AS a, x_first || ' ' || x_last AS b FROM ({PAIRS}) q"


def _sim(name: str, sql: str | None, f, rows: str = TWO):
    @R.add(name, sql and f"SELECT a, b, round({sql}, 9) AS sim FROM ({rows}) t")
    def _(spark, d):
        return roles.role(spark, d, rows).select("a", "b", F.round(f(F.col("a"), F.col("b")), 9).alias("sim"))


def jaccard_sql(x: str, y: str) -> str:
    both = f"len(list_intersect({x}, {y}))"
    return f"CASE WHEN len({x}) = 0 AND len({y}) = 0 THEN 1.0 WHEN len({x}) = 0 OR len({y}) = 0 THEN 0.0 ELSE {both} / (len({x}) + len({y}) - {both})::DOUBLE END"


set_sql = lambda c: f"list_distinct({tokens_sql(c)})"


def lev_sql(a: str, b: str) -> str:
    x, y = norm_sql(a), norm_sql(b)
    return f"CASE WHEN {x} = '' AND {y} = '' THEN 1.0 WHEN {x} = '' OR {y} = '' THEN 0.0 ELSE 1 - levenshtein({norm_sql(x)}, {norm_sql(y)}) / greatest(length({x}), length({y}))::DOUBLE END"


_sim("sim_1", None, S.jaro_similarity)
_sim("sim_2", None, S.jaro_winkler)
_sim("sim_3", f"levenshtein({norm_sql('a')}, {norm_sql('b')})::DOUBLE", lambda a, b: S.levenshtein_dist(a, b).cast("double"))
_sim("sim_4", lev_sql("a", "b"), S.lev_sim)
_sim("sim_5", jaccard_sql(set_sql("a"), set_sql("b")), S.token_jaccard)

CORPUS = f"SELECT first_name || ' ' || last_name AS name FROM ({LEFT}) l UNION ALL SELECT first_name || ' ' || last_or_org_name FROM ({RIGHT}) r"
IDF_SQL = f"""SELECT token, count(*) AS df, ln((1 + (SELECT count(*) FROM (SELECT {set_sql('name')} AS t FROM ({CORPUS}) c) z WHERE len(t) > 0)) / (1 + count(*))::DOUBLE) + 1 AS idf
  FROM (SELECT unnest({set_sql('name')}) AS token FROM ({CORPUS}) c) u GROUP BY token"""


def weights(spark, d):
    return S.idf(F.col("name"), roles.role(spark, d, CORPUS))


@R.add("agg_23", f"SELECT token, df, round(idf, 9) AS idf FROM ({IDF_SQL}) t")
def _(spark, d):
    return weights(spark, d).withColumn("idf", F.round("idf", 9))


def _vector_sql(rows: str, unit: str) -> str:
    """Cosines of the pairs (a, b) of rows from unit vectors of their names; two empty ones are 1."""
    return f"""WITH p AS ({rows}), n AS (SELECT a AS name FROM p UNION SELECT b FROM p), v AS ({unit}),
 u AS (SELECT name, k, w / sqrt(sum(w * w) OVER (PARTITION BY name)) AS w FROM v),
 dots AS (SELECT p.a, p.b, sum(x.w * y.w) AS s FROM p JOIN u x ON x.name = p.a JOIN u y ON y.name = p.b AND y.k = x.k GROUP BY p.a, p.b),
 cos AS (SELECT p.a, p.b, CASE WHEN p.a NOT IN (SELECT name FROM u) AND p.b NOT IN (SELECT name FROM u) THEN 1.0
   ELSE greatest(0.0, least(1.0, coalesce(s, 0.0))) END AS sim FROM p LEFT JOIN dots ON p.a = dots.a AND p.b = dots.b)"""


WORD_UNIT = f"""SELECT name, token AS k, count(*) * any_value(idf) AS w FROM (SELECT name, unnest({tokens_sql('name')}) AS token FROM n) t JOIN ({IDF_SQL}) i USING (token) GROUP BY name, token"""
GRAM_UNIT = f"""SELECT name, g AS k, count(*)::DOUBLE AS w FROM (SELECT name, unnest(list_transform(range(1, greatest(length({_GRAM('name')}) - 1, 2)), lambda i: substr({_GRAM('name')}, i, 3))) AS g FROM n) t WHERE g <> '' GROUP BY name, g"""


@R.add("sim_6", _vector_sql(TWO, WORD_UNIT) + " SELECT a, b, round(sim, 9) AS sim FROM cos")
def _(spark, d):
    p = roles.role(spark, d, TWO)
    names = p.select(F.col("a").alias("name")).union(p.select("b")).distinct()
    v = S.tfidf_vectors(names, "name", F.col("name"), weights(spark, d))
    both = p.join(v.select(F.col("name").alias("a"), F.col("vec").alias("va")), "a").join(v.select(F.col("name").alias("b"), F.col("vec").alias("vb")), "b")
    return both.select("a", "b", F.round(S.cosine(F.col("va"), F.col("vb")), 9).alias("sim"))


# the oracle compares grams, the query hashed grams: none of these names' grams share a bucket
@R.add("sim_7", _vector_sql(TWO, GRAM_UNIT) + " SELECT a, b, round(sim, 9) AS sim FROM cos")
def _(spark, d):
    p = roles.role(spark, d, TWO)
    names = p.select(F.col("a").alias("name")).union(p.select("b")).distinct()
    v = S.char3_vectors(names, "name", F.col("name"))
    both = p.join(v.select(F.col("name").alias("a"), F.col("vec").alias("va")), "a").join(v.select(F.col("name").alias("b"), F.col("vec").alias("vb")), "b")
    return both.select("a", "b", F.round(S.cosine(F.col("va"), F.col("vb")), 9).alias("sim"))


ZIPS = f"SELECT DISTINCT l.zip5 AS a, r.zip5 AS b FROM ({LEFT}) l JOIN ({RIGHT}) r ON l.state = r.state AND l.p_brand <> r.p_brand"
_number = lambda c: f"CASE WHEN length({norm_sql(c)}) >= 5 THEN TRY_CAST(substr({norm_sql(c)}, 1, 5) AS INTEGER) END"
zip_sql = lambda a, b: f"coalesce(greatest(0.0, 1 - abs(({_number(a)}) - ({_number(b)})) / 10000.0::DOUBLE), 0.0) * CASE WHEN ({_number(a)}) IS NULL OR ({_number(b)}) IS NULL THEN 0 ELSE 1 END"


@R.add("sim_8", f"SELECT a, b, round({zip_sql('a', 'b')}, 9) AS sim FROM ({ZIPS}) t")
def _(spark, d):
    """The pairs of ZIPS, from the distinct rows of each side."""
    a, b = (f(spark, d).select("state", "p_brand", F.col("zip5").alias(c)).distinct() for f, c in ((left, "a"), (right, "b")))
    met = a.alias("l").join(b.alias("r"), (F.col("l.state") == F.col("r.state")) & (F.col("l.p_brand") != F.col("r.p_brand"))).select("a", "b").distinct()
    return met.select("a", "b", F.round(S.zip_num_sim(F.col("a"), F.col("b")), 9).alias("sim"))



# ---- the feature row

_blank = lambda c: f"coalesce({c}::VARCHAR, '')"
FULL_B, FULL_X = "(b_first || ' ' || b_last)", "(x_first || ' ' || x_last)"


def _features(name: str, columns: list[str], sql: dict[str, str] | None, extra: str = ""):
    text = None
    if sql:
        text = f"{extra} SELECT DISTINCT left_id, right_id, {', '.join(f'{sql[c]} AS {c}' for c in columns)} FROM ({PAIRS}) q"

    @R.add(name, text)
    def _(spark, d):
        return without_repeats(distinct_rows(spark, d, columns))


def _flag(cond: str) -> str:
    return f"CAST(coalesce({cond}, false) AS INTEGER)"


def _both(f: str, expr) -> str:
    return _flag(f"b_{f} <> '' AND x_{f} <> '' AND {expr('b_' + f)} = {expr('x_' + f)} AND {expr('b_' + f)} <> ''")


_org = {s: f"({org_sql(f'{s}_last')} = 1 OR {org_sql(f)} = 1)" for s, f in (("b", FULL_B), ("x", FULL_X))}
_zip3 = lambda c: f"CASE WHEN length({norm_sql(c)}) >= 3 THEN substr({norm_sql(c)}, 1, 3) ELSE '' END"
_features("ft_1_2", ["sim_jw_fullname", "sim_jw_lastname"], None)
_features("ft_3_4", ["sim_lev_fullname", "sim_lev_lastname"], {"sim_lev_fullname": f"round({lev_sql(FULL_B, FULL_X)}, 9)", "sim_lev_lastname": f"round({lev_sql('b_last', 'x_last')}, 9)"})
_features("ft_5", ["sim_soundex_last"], {"sim_soundex_last": _flag(f"{soundex_sql('b_last')} <> '' AND {soundex_sql('b_last')} = {soundex_sql('x_last')}")})
_features("ft_6_7", ["sim_jacc_fullname", "sim_jacc_lastname"], {"sim_jacc_fullname": f"round({jaccard_sql(set_sql(FULL_B), set_sql(FULL_X))}, 9)", "sim_jacc_lastname": f"round({jaccard_sql(set_sql('b_last'), set_sql('x_last'))}, 9)"})


def _vector_feature(name: str, column: str, unit: str):
    @R.add(name, _vector_sql(TWO, unit) + f" SELECT DISTINCT left_id, right_id, round(sim, 9) AS {column} FROM ({PAIRS}) q JOIN cos ON cos.a = {FULL_B} AND cos.b = {FULL_X}")
    def _(spark, d):
        return without_repeats(distinct_rows(spark, d, [column]))


_vector_feature("ft_8", "sim_tfidf_name", WORD_UNIT)
_vector_feature("ft_9", "sim_char3_name", GRAM_UNIT)
_features("ft_10", ["first_initial_match"], {"first_initial_match": _flag(f"substr({norm_sql('b_first')}, 1, 1) <> '' AND substr({norm_sql('b_first')}, 1, 1) = substr({norm_sql('x_first')}, 1, 1)")})
_features("ft_11_13", ["state_match", "zip_match", "zip3_match"], {"state_match": _both("state", norm_sql), "zip_match": _both("zip5", norm_sql), "zip3_match": _both("zip5", _zip3)})
_features("ft_14", ["sim_jw_city"], {"sim_jw_city": "1.0::DOUBLE"})  # the pairs share state, and so city
_features("ft_15", ["sim_jw_street1"], None)
_features("ft_16_17", ["org_keyword_match", "org_vs_person_conflict"], {"org_keyword_match": _flag(f"{_org['b']} AND {_org['x']}"), "org_vs_person_conflict": _flag(f"{_org['b']} <> {_org['x']}")})
_features("ft_18", ["credential_overlap"], {"credential_overlap": f"CASE WHEN len({cred_sql('x_cred')}) = 0 THEN 1.0 ELSE 0.0 END::DOUBLE"})
_features("ft_19", ["suffix_match"], {"suffix_match": _flag(f"{suffix_sql(FULL_B)} <> '' AND {suffix_sql(FULL_B)} = {suffix_sql(FULL_X)}")})
for _name, _s in (("ft_20_25", "b"), ("ft_26_31", "x")):
    _features(_name, [f"miss_{_s}_{f}" for f in features.SIDES], {f"miss_{_s}_{f}": _flag(f"{_blank(f'{_s}_{f}')} = ''") for f in features.SIDES})
_features("ft_32", ["sim_zip_num"], {"sim_zip_num": f"round({zip_sql('b_zip5', 'x_zip5')}, 9)"})
_features("ft_33", ["n_years_b"], {"n_years_b": "round(least(coalesce(b_n_years, 0), 20) / 20.0::DOUBLE, 9)"})


@R.add("ft_all")
def _(spark, d):
    columns = roles.role(spark, d, PAIRS).columns
    rows = features.block_rows(*pair_sides(spark, d), ["left_id", "left_npi", "right_id"], KEYS, weights(spark, d), near=True)
    return rows.select(*columns, *features.FEATURES)


# ---- candidate generation


def exact(spark, d, sides=None):
    return blocking.exact_id(*(sides or (left(spark, d), right(spark, d))), "profile_id", "npi", "npi")


@R.add("blk_1", f"SELECT DISTINCT profile_id AS left_id, r.npi AS right_id, 'exact_id' AS pass, NULL::VARCHAR AS block_key FROM ({LEFT}) l JOIN ({RIGHT}) r ON l.npi = r.npi")
def _(spark, d):
    return exact(spark, d)


def _capped_sql(key: str, rkey: str, name: str, cap: int) -> str:
    return f"""WITH l AS (SELECT *, {key} AS k, count(*) OVER (PARTITION BY {key}) AS n FROM ({LEFT}) t),
 r AS (SELECT *, {rkey} AS k, count(*) OVER (PARTITION BY {rkey}) AS n FROM ({RIGHT}) t)
 SELECT profile_id AS left_id, r.npi AS right_id, '{name}' AS pass, l.k AS block_key FROM l JOIN r ON l.k = r.k
 WHERE length(l.k) > 1 AND l.n <= {cap} AND r.n <= {cap}"""


_SZ = "coalesce(state, '') || '|' || coalesce(zip5, '')"
STATE_ZIP = _capped_sql(_SZ, _SZ, "state_zip", 500)


@R.add("blk_2a", STATE_ZIP)
def blk_2a(spark, d, sides=None):
    key = T.block_key(F.col("state"), F.col("zip5"))
    return blocking.capped_block(*(sides or (left(spark, d), right(spark, d))), "profile_id", "npi", key, key, "state_zip", 500)


STATE_CITY = f"""SELECT profile_id AS left_id, r.npi AS right_id, 'state_city' AS pass, l.state || '|' || l.city AS block_key
 FROM ({LEFT}) l JOIN ({RIGHT}) r ON l.state || '|' || l.city = r.state || '|' || r.city WHERE l.zip5 IS NULL AND r.zip5 IS NULL"""


@R.add("blk_2b", STATE_CITY)
def blk_2b(spark, d, sides=None):
    key = T.block_key(F.col("state"), F.col("city"))
    bare = [df.where(F.col("zip5").isNull()) for df in sides or (left(spark, d), right(spark, d))]
    return blocking.capped_block(*bare, "profile_id", "npi", key, key, "state_city", None)


STATE_LAST = _capped_sql(f"state || '|' || {_lastkey.format('last_name')}", f"state || '|' || {_lastkey.format('last_or_org_name')}", "state_lastkey", 2000)


@R.add("blk_2c", STATE_LAST)
def blk_2c(spark, d, sides=None):
    keys = [T.block_key(F.col("state"), T.last_key(F.col(c))) for c in ("last_name", "last_or_org_name")]
    return blocking.capped_block(*(sides or (left(spark, d), right(spark, d))), "profile_id", "npi", *keys, "state_lastkey", 2000)


_NEAR = lambda last: f"state || '|' || {_lastkey.format(last)} || '|' || {_initial}"
NEIGHBOURS = f"""SELECT l.profile_id AS left_id, r.npi AS right_id, 'sorted_neighborhood' AS pass, l.k AS block_key FROM (SELECT *, {_NEAR('last_name')} AS k FROM ({LEFT}) t) l
 JOIN (SELECT npi, k, row_number() OVER (PARTITION BY k ORDER BY npi) AS n FROM (SELECT *, {_NEAR('last_or_org_name')} AS k FROM ({RIGHT}) t) u) r ON l.k = r.k WHERE n <= 50"""


@R.add("blk_3", NEIGHBOURS)
def blk_3(spark, d, sides=None):
    keys = [T.block_key(F.col("state"), T.last_key(F.col(c)), T.first_initial(F.col("first_name"))) for c in ("last_name", "last_or_org_name")]
    return blocking.neighbourhood(*(sides or (left(spark, d), right(spark, d))), "profile_id", "npi", *keys, window=50)


CANOPY = f"""SELECT left_id, right_id, 'canopy' AS pass, state AS block_key FROM (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY sim DESC, right_id) AS n FROM
 (SELECT *, max(sim) OVER (PARTITION BY left_id) AS best FROM ({JACCARD_SQL}) j WHERE sim >= 0.6) m WHERE best < 0.8 OR sim >= 0.8) t WHERE n <= 200"""


@R.add("blk_4", CANOPY)
def blk_4(spark, d):
    return blocking.canopy(*token_sides(spark, d))


@R.add("blk_4h", f"SELECT left_id, right_id, round(sim, 9) AS sim FROM ({JACCARD_SQL}) t WHERE sim >= 0.5")
def _(spark, d):
    return blocking.canopy_scores(*token_sides(spark, d), threshold=0.5).withColumn("sim", F.round("sim", 9))


_SALT = "[" + ", ".join(f"{s}::BIGINT" for s in blocking.salts()) + "]"


def _cells_sql(rows: str) -> str:
    hashes = "list_transform(tokens, lambda t: ('0x' || substr(md5(t), 1, 15))::BIGINT)"
    sig = f"list_transform({_SALT}, lambda s: list_min(list_transform(h, lambda x: xor(x, s))))"
    return f"""SELECT id, state, band, md5(array_to_string(sig[band * 8 + 1:band * 8 + 8], '|')) AS bucket
 FROM (SELECT id, state, {sig} AS sig FROM (SELECT id, state, {hashes} AS h FROM ({rows}) a) b) c, (SELECT unnest(range(0, 8)) AS band) z"""


LSH = f"""WITH l AS (SELECT *, count(*) OVER (PARTITION BY state, band, bucket) AS n FROM ({_cells_sql(LEFT_TOKENS)}) x),
 r AS (SELECT *, count(*) OVER (PARTITION BY state, band, bucket) AS n, row_number() OVER (PARTITION BY state, band, bucket ORDER BY id) AS k FROM ({_cells_sql(RIGHT_TOKENS)}) x)
 SELECT DISTINCT l.id AS left_id, r.id AS right_id, 'lsh' AS pass, l.state AS block_key FROM l JOIN r ON l.state = r.state AND l.band = r.band AND l.bucket = r.bucket
 WHERE l.n <= 5000 AND r.n <= 5000 AND k <= 200"""


@R.add("blk_5", LSH)
def blk_5(spark, d):
    return blocking.lsh_pairs(*token_sides(spark, d))


@R.add("jn_10", f"SELECT left_id, right_id FROM ({LSH}) t")
def _(spark, d):
    return blk_5(spark, d).select("left_id", "right_id")


_EXACT = f"SELECT profile_id AS left_id, r.npi AS right_id, 'exact_id' AS pass, NULL::VARCHAR AS block_key FROM ({LEFT}) l JOIN ({RIGHT}) r ON l.npi = r.npi"
# ranks of the survey (BLK-6), stated here once more so that the operator's are checked
_RANKS = """WHEN 'exact_id' THEN 0 WHEN 'state_zip' THEN 1 WHEN 'state_city' THEN 2 WHEN 'state_lastkey' THEN 2
 WHEN 'sorted_neighborhood' THEN 3 WHEN 'canopy' THEN 4 WHEN 'lsh' THEN 5"""
UNION_SQL = " UNION ALL ".join(f"SELECT * FROM ({q}) q{i}" for i, q in enumerate((_EXACT, STATE_ZIP, STATE_CITY, STATE_LAST, CANOPY, LSH, NEIGHBOURS)))
DEDUPED = f"""SELECT left_id, right_id, pass, block_key FROM (SELECT *, row_number() OVER (PARTITION BY left_id, right_id
 ORDER BY CASE pass {_RANKS} ELSE 99 END, block_key NULLS FIRST, pass) AS n FROM ({UNION_SQL}) u) t WHERE n = 1"""


def all_candidates(spark, d):
    """The pairs of every pass; the passes share the sides, dealt over all cores and computed once, and the classes of their token sets."""
    cores = spark.sparkContext.defaultParallelism
    sides = [materialize(f(spark, d).repartition(cores), "side") for f in (left, right)]
    out = exact(spark, d, sides)
    for f in (blk_2a, blk_2b, blk_2c, blk_3):
        out = out.unionByName(f(spark, d, sides))
    known = blocking.state_classes(*token_sides(spark, d, sides))
    return out.unionByName(blocking.canopy_of(*known)).unionByName(blocking.lsh_of(*known))


@R.add("blk_6", DEDUPED)
def blk_6(spark, d):
    """The first pass of each pair; passes and their comparison see equal left rows once."""
    fields = ["first_name", "last_name", "state", "zip5", "city", "p_brand"]
    rows, members = blocking.left_entities(left(spark, d), "profile_id", "npi", fields)
    theirs, tokens = right(spark, d), token_sides(spark, d)[1]
    own = rows.select(F.col("left_class").alias("id"), "state", T.block_tokens(F.concat_ws(" ", "first_name", "last_name", "state", "p_brand")).alias("tokens"), "size")
    keys = T.block_key(F.col("state"), F.col("zip5")), T.block_key(F.col("state"), F.col("city"))
    last = [T.block_key(F.col("state"), T.last_key(F.col(c))) for c in ("last_name", "last_or_org_name")]
    near = [T.block_key(F.col("state"), T.last_key(F.col(c)), T.first_initial(F.col("first_name"))) for c in ("last_name", "last_or_org_name")]
    bare = lambda df: df.where(F.col("zip5").isNull())
    found = [
        blocking.capped_block(rows, theirs, "left_class", "npi", keys[0], keys[0], "state_zip", 500, "size"),
        blocking.capped_block(bare(rows), bare(theirs), "left_class", "npi", keys[1], keys[1], "state_city", None),
        blocking.capped_block(rows, theirs, "left_class", "npi", *last, "state_lastkey", 2000, "size"),
        blocking.neighbourhood(rows, theirs, "left_class", "npi", *near, window=50),
        blocking.canopy(own.drop("size"), tokens),
        blocking.lsh_pairs(own, tokens),
    ]
    return blocking.dedupe_entities(functools.reduce(DataFrame.unionByName, found), members, exact(spark, d))


@R.add("agg_22", f"""WITH u AS (SELECT left_id, right_id, pass FROM ({UNION_SQL}) t),
 p AS (SELECT DISTINCT * FROM (SELECT * FROM u UNION ALL SELECT left_id, right_id, 'all' FROM u) t), g AS (SELECT DISTINCT left_id, right_id FROM ({_EXACT}) t),
 h AS (SELECT p.*, g.left_id IS NOT NULL AS hit FROM p LEFT JOIN g ON p.left_id = g.left_id AND p.right_id = g.right_id)
 SELECT pass, count(*) AS n_pairs, count(DISTINCT left_id) AS n_left, count(DISTINCT right_id) AS n_right, count(*) FILTER (WHERE hit) AS gold_hits,
 round(count(*) FILTER (WHERE hit) / nullif((SELECT count(*) FROM g), 0)::DOUBLE, 9) AS recall, round(count(*) / nullif(count(*) FILTER (WHERE hit), 0)::DOUBLE, 9) AS pairs_per_hit
 FROM h GROUP BY pass""")
def _(spark, d):
    report = blocking.recall_report(all_candidates(spark, d), exact(spark, d))
    return report.withColumns({c: F.round(c, 9) for c in ("recall", "pairs_per_hit")})


QUERIES_SQL = f"SELECT profile_id AS query_id, CASE WHEN n_years = 1 THEN 'NOWHERE' ELSE state END AS state, CASE WHEN n_years % 3 = 0 THEN '99' ELSE zip5 END AS zip5 FROM ({LEFT}) t"


@R.add("blk_7", f"""WITH q AS (SELECT query_id, {norm_sql('state')} AS state, CASE WHEN length(zip5) >= 3 THEN substr(zip5, 1, 3) END AS z FROM ({QUERIES_SQL}) t),
 p AS (SELECT npi AS id, {norm_sql('state')} AS state, CASE WHEN length(zip5) >= 3 THEN substr(zip5, 1, 3) END AS z FROM ({RIGHT}) t),
 a AS (SELECT query_id, id, 1 AS tier FROM q JOIN p ON q.state = p.state AND q.z = p.z),
 b AS (SELECT query_id, id, 2 AS tier FROM q JOIN (SELECT *, row_number() OVER (PARTITION BY state ORDER BY id) AS n FROM p) p ON q.state = p.state
   WHERE n <= 1000 AND query_id NOT IN (SELECT query_id FROM a)),
 c AS (SELECT query_id, id, 3 AS tier FROM q, (SELECT id FROM p ORDER BY id LIMIT 1000) p WHERE query_id NOT IN (SELECT query_id FROM a) AND query_id NOT IN (SELECT query_id FROM b))
 SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c""")
def _(spark, d):
    providers = right(spark, d).select(F.col("npi").alias("id"), "state", "zip5")
    return blocking.tiered_block(roles.role(spark, d, QUERIES_SQL), providers)


# ---- entity resolution and aggregates

CLAIMS = "SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'F') AS status, o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price FROM orders"
RESOLVED = f"""SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS first_order, (list(status ORDER BY o_orderkey))[1] AS status, round(coalesce(sum(price), 0), 4) AS sum_price, round(avg(price), 4) AS mean_price,
 count(DISTINCT status) + max(CAST(status IS NULL AS INTEGER)) AS n_status, count(*) AS n_rows FROM ({CLAIMS}) c GROUP BY o_custkey"""


def resolved(spark, d):
    rows = roles.role(spark, d, CLAIMS).withColumn("first_order", F.col("o_orderkey"))
    out = entities.resolve(rows, "o_custkey", F.col("o_orderkey"), ["first_order", "status"], {"sum_price": "price"}, {"mean_price": "price"}, {"n_status": "status"}, "n_rows")
    return out.withColumns({c: F.round(c, 4) for c in ("sum_price", "mean_price")})


@R.add("resolve", RESOLVED)
def _(spark, d):
    return resolved(spark, d)


for _name, _columns in (("agg_1", "first_order, status"), ("agg_2", "n_status"), ("agg_3", "sum_price"), ("agg_4", "mean_price"), ("agg_5", "n_rows")):

    @R.add(_name, f"SELECT o_custkey, {_columns} FROM ({RESOLVED}) t")
    def _(spark, d, columns=_columns):
        return resolved(spark, d).select("o_custkey", *columns.split(", "))


@R.add("agg_6", "SELECT o_custkey, array_to_string(list_sort(list(o_orderkey))[1:3], ',') AS first_three FROM orders GROUP BY o_custkey")
def _(spark, d):
    from pyspark.sql import Window as W

    rank = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    few = table(spark, d, "orders").select("o_custkey", "o_orderkey").withColumn("r", rank).where("r <= 3")
    return few.groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_list("o_orderkey")), ",").alias("first_three"))


@R.add("agg_7", "SELECT p_type AS value, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, value")
def _(spark, d):
    return profile.value_counts(table(spark, d, "part"), ["p_type"]).select("value", "n").orderBy(F.desc("n"), "value")


@R.add("agg_8", "SELECT DISTINCT p_name, p_brand FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_name", "p_brand").distinct()


@R.add("agg_9", "SELECT p_name, min(p_partkey) AS p_partkey FROM part GROUP BY p_name")
def _(spark, d):
    first = F.min_by(F.struct("p_partkey"), F.col("p_partkey"))
    return table(spark, d, "part").groupBy("p_name").agg(first["p_partkey"].alias("p_partkey"))


@R.add("agg_10", "SELECT count(DISTINCT p_name) AS names, count(DISTINCT p_brand) AS brands FROM part")
def _(spark, d):
    return table(spark, d, "part").agg(F.count_distinct("p_name").alias("names"), F.count_distinct("p_brand").alias("brands"))
