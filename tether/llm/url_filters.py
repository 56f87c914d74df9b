"""URL filters: stated host and path rules, and association rules mined from labels.

Stated rules fit a host and its subdomains and a path prefix; the longest fitting rule decides. Urls without a stated
rule are judged by mined rules: FP-growth finds the frequent sets of url tokens, of any size, among labelled urls. A set
becomes a blocking rule if enough urls hold it (support) and if, by the lower confidence bound of Wilson, the share of bad
urls among them reaches the confidence and its odds are ``lift`` times the odds of all labelled urls; so a token of a few
urls, or one that is as bad as the rest, makes no rule. Rules that a smaller rule already implies are pruned. Rules match
by an inverted index from token to rules: a url fits a rule when it holds all its items.

Tokens that the very same labelled urls hold are one item, as any of them tells as much as all; tokens that nearly all
labelled urls hold tell nothing and are left out. So a long query that many urls repeat does not multiply sets.

Defined results: a null url or one without ``://`` has empty host and path, no tokens, and is allowed; very long urls are
read whole; repeated rows are judged alike and returned as often as they occur; of several labels of a page a bad one counts;
without labels, or where all of them are bad, no rule is mined and all else is allowed; an empty table gives an empty result;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import materialize, table

#: Stated rules: (verdict, host, path).
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
BAD = "label=bad"
#: Least share of labelled urls that hold a rule; least share of bad ones among them, and least multiple of the odds of all.
SUPPORT, CONFIDENCE, LIFT = 0.005, 0.6, 3.0
#: Deviations of the lower confidence bound: many sets are tried.
Z = 3.0
#: Tokens that a larger share of labelled urls hold are left out.
COMMON = 0.9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def stated(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest stated rule that fits, or null."""
    hits = [
        F.when(
            ((host == h) | host.endswith(f".{h}")) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1:]))
    ]
    return F.coalesce(*hits)


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: host labels, path parts with numbers masked, file ending, query keys and values, fragment."""
    text = F.coalesce(url, F.lit(""))
    part = lambda prefix, xs: F.transform(F.array_remove(xs, ""), lambda x: F.concat(F.lit(prefix), x))
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    fragment = F.regexp_extract(text, r"(?s)#(.*)$", 1)
    masked = F.regexp_replace(path, "[0-9]+", "0")
    return F.array_distinct(
        F.concat(
            part("host:", F.split(host, r"\.")),
            part("path:", F.split(masked, "/")),
            part("query:", F.split(query, "&")),
            part("fragment:", F.array(fragment)),
        )
    )


def _bundled(baskets: DataFrame, least: float, common: float) -> DataFrame:
    """(token, item) of the tokens that from ``least`` to ``common`` of the baskets (rid, tokens) hold: equal holders, one item."""
    held = baskets.select("rid", F.explode("tokens").alias("token")).groupBy("token")
    hashed = F.xxhash64("rid")
    marks = held.agg(F.count("*").alias("n"), F.sum(F.pmod(hashed, F.lit(1 << 31))).alias("s"), F.expr("bit_xor(xxhash64(rid))").alias("x"))
    return marks.where(F.col("n").between(least, common)).select("token", F.min("token").over(W.partitionBy("n", "s", "x")).alias("item"))


def lower_bound(bad: Column, n: Column, z: float) -> Column:
    """Wilson's lower confidence bound of the share bad / n."""
    share = bad / n
    return (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT, z: float = Z) -> DataFrame:
    """The rules' inverted index (rule_id, token, item, size) from labelled urls (rid, tokens array, bad boolean).

    Support is the share of labelled urls that hold a rule, confidence the least share of bad ones among them, by their lower
    bound at z deviations. At least one url in 1 / support holds each token, so there are at most (tokens of a url / support)
    frequent tokens and the rules stay few whatever the number of urls.
    """
    baskets = materialize(labelled.where(F.size("tokens") > 0).select("rid", "tokens", "bad"), "url-baskets")
    n, n_bad = baskets.agg(F.count("*"), F.count_if("bad")).first()
    floor = max(confidence, lift * n_bad / (n - n_bad + lift * n_bad)) if n_bad < n else 2.0
    bundled = materialize(_bundled(baskets, support * floor * n, COMMON * n), "url-items")  # at most tokens of a url / (support * confidence) rows
    items = baskets.select("rid", "bad", F.explode("tokens").alias("token")).join(bundled, "token").groupBy("rid", "bad").agg(F.collect_set("item").alias("items"))
    if not n or floor > 1 or not bundled.head(1):
        return bundled.limit(0).select(F.lit("").alias("rule_id"), "token", "item", F.lit(0).alias("size"))
    marked = items.select(F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=support * floor * n / max(1, items.count()) * (1 - 1e-9), minConfidence=0.0).fit(marked).freqItemsets
    sets = materialize(found.withColumn("items", F.array_sort("items")), "url-sets")
    with_bad = sets.where(F.array_contains("items", BAD) & (F.size("items") > 1)).select(
        F.array_remove("items", BAD).alias("items"), F.col("freq").alias("bad")
    )
    sure = lower_bound(F.col("bad"), F.col("freq"), z) >= floor
    rules = sets.join(with_bad, "items").where((F.col("freq") >= support * n) & sure).select("items", F.size("items").alias("size"))
    found = materialize(rules, "url-rules")
    kept = found.limit(0)
    for k in sorted(r["size"] for r in found.select("size").distinct().collect()):  # as many as a url has tokens, at most
        small = kept.select(F.explode("items").alias("item"), F.col("items").alias("part"), F.col("size").alias("part_size"))
        level = found.where(F.col("size") == k)
        implied = (
            level.select(F.explode("items").alias("item"), "items")
            .join(small, "item")
            .groupBy("items", "part", "part_size")
            .agg(F.count("*").alias("n"))
            .where("n = part_size")
            .select("items")
            .distinct()
        )
        kept = materialize(kept.union(level.join(implied, "items", "left_anti")), "url-kept")
    return kept.select(F.array_join("items", "\x01").alias("rule_id"), F.explode("items").alias("item"), "size").join(bundled, "item").select("rule_id", "token", "item", "size")


def match(urls: DataFrame, index: DataFrame) -> DataFrame:
    """The distinct keys (page_id, url) of urls (page_id, url, tokens) that fit a rule of the inverted index."""
    return (
        urls.select("page_id", "url", F.explode("tokens").alias("token"))
        .join(index, "token")
        .groupBy("page_id", "url", "rule_id", "size")
        .agg(F.count_distinct("item").alias("n"))
        .where("n = size")
        .select("page_id", "url")
        .distinct()
    )


def url_filters(pages: DataFrame, labels: DataFrame, rules=RULES, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages; labels: doc_id is the page_id, toxic or quality 0 is bad."""
    url = F.col("url")
    parsed = pages.select("page_id", "url").withColumns({"host": host_of(url), "path": path_of(url)})
    parsed = parsed.withColumn("__stated", stated(F.col("host"), F.col("path"), rules))
    split = parsed.withColumn("tokens", tokens(url, F.col("host"), F.col("path")))
    marks = labels.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad")
    ).where("bad IS NOT NULL")
    labelled = split.select("page_id", "url", "tokens").distinct().join(marks, "page_id")
    labelled = labelled.select(F.struct("page_id", "url").alias("rid"), "tokens", "bad")
    index = materialize(mine(labelled, support, confidence, lift), "url-index")
    fits = match(split.where("__stated IS NULL"), index).select(
        F.col("page_id").alias("__p"), F.col("url").alias("__u"), F.lit(True).alias("__hit")
    )
    judged = parsed.join(fits, F.col("page_id").eqNullSafe(F.col("__p")) & F.col("url").eqNullSafe(F.col("__u")), "left")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("__stated.rule").alias("rule"),
        F.coalesce(F.col("__stated.verdict"), F.when(F.col("__hit"), "block").otherwise("allow")).alias("verdict"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def _oracle(rules=RULES) -> str:
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1:]))
    fit = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = " ".join(f"WHEN {fit(h, p)} THEN '{h + p}'" for _, h, p in longest)
    said = " ".join(f"WHEN {fit(h, p)} THEN '{v}'" for v, h, p in longest)
    bound = f"(b / n + {Z * Z} / (2 * n) - {Z} * sqrt(b / n * (1 - b / n) / n + {Z * Z} / (4 * n * n))) / (1 + {Z * Z} / n)"
    # every set of frequent tokens of every labelled url
    return f"""WITH RECURSIVE u AS (SELECT row_number() OVER () AS rid, page_id, coalesce(url, '') AS url FROM pages),
h AS (SELECT *, translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM u),
t AS (SELECT DISTINCT rid, token FROM (
  SELECT rid, 'host:' || unnest(string_split(host, '.')) AS token FROM h
  UNION ALL SELECT rid, 'path:' || unnest(string_split(regexp_replace(path, '[0-9]+', '0', 'g'), '/')) FROM h
  UNION ALL SELECT rid, 'query:' || unnest(string_split(regexp_extract(url, '\\?([^#]*)', 1, 's'), '&')) FROM h
  UNION ALL SELECT rid, 'fragment:' || regexp_extract(url, '#(.*)$', 1, 's') FROM h)
  WHERE NOT ends_with(token, ':') OR length(token) > 9),
l AS (SELECT min(rid) AS rid, bool_or(bad) AS bad FROM h JOIN (SELECT doc_id, bool_or(toxic = 1 OR quality = 0) AS bad FROM labels GROUP BY doc_id) b
  ON h.page_id = b.doc_id WHERE bad IS NOT NULL AND rid IN (SELECT rid FROM t) GROUP BY page_id, url),
n AS (SELECT count(*) AS total, count(*) FILTER (WHERE bad) AS n_bad FROM l),
o AS (SELECT total, CASE WHEN n_bad < total THEN greatest({CONFIDENCE}, {LIFT} * n_bad / (total - n_bad + {LIFT} * n_bad)) ELSE 2.0 END AS floor FROM n),
lt AS (SELECT t.rid, token, bad FROM t JOIN l ON t.rid = l.rid),
f AS (SELECT token FROM lt GROUP BY token HAVING count(*) >= {SUPPORT} * (SELECT total * floor FROM o)
  AND count(*) <= {COMMON} * (SELECT total FROM o)),
ft AS (SELECT lt.* FROM lt JOIN f ON lt.token = f.token),
sets AS (SELECT rid, bad, token, [token] AS s FROM ft
  UNION ALL SELECT a.rid, a.bad, b.token, list_append(a.s, b.token) FROM sets a JOIN ft b ON a.rid = b.rid AND a.token < b.token),
rules AS (SELECT s FROM (SELECT s, count(*)::DOUBLE AS n, count(*) FILTER (WHERE bad)::DOUBLE AS b FROM sets GROUP BY s) c
  WHERE n >= {SUPPORT} * (SELECT total FROM o) AND {bound} >= (SELECT floor FROM o)),
held AS (SELECT rid, list(token) AS tokens FROM t GROUP BY rid),
hit AS (SELECT DISTINCT rid FROM held, rules WHERE list_has_all(tokens, s))
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {said} WHEN hit.rid IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict FROM h LEFT JOIN hit ON h.rid = hit.rid"""


ORACLE = _oracle()
