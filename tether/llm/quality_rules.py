"""Quality rules whose cut-offs follow the data.

Every document gets integer measures. Per language and source their distribution is summarised in a mergeable quantile
sketch: counts per bucket, of which there are 64 in each octave (a relative error below 1/64) and no last one. Counts add up
exactly, whatever the order, so partial sketches of tasks, of sources and of languages merge by summing. A cut-off is read
from a group's median and the quartile on its good side, as ratios: SPREAD times as far from the median as that quartile, to
the other side. So junk can make up nearly half of a group without moving the distance.

Small groups lean on their language, and that on the whole table: median and distance are means of the group's own and of its
parent's, with weight n^2 / (n^2 + PRIOR^2) for the own ones, and the distance is widened where the two medians disagree. So no
size switches from one to the other, and a group of its own kind keeps its median. The only floor of a distance is what the
sketch can resolve. Documents beyond the cut-offs, which are joined back, are rejected.

Defined results: a null text has no words and fails the base rule; a null language or source is a group of its own; very long
texts are measured whole (distinct words by passages, so that length has no weight); measures that equal the cut-off are kept;
repeated rows are judged alike and all returned; an empty table gives an empty result; other columns are ignored by
``quality_rules`` and returned as they were by ``keep_good``, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import SPACE, materialize, table, words

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Measure:
    """An integer measure, and whether low values are bad ones."""

    name: str
    low: bool = False


#: Per ten thousand code points of words: those that are no letters, and A to Z; hundredths of a code point a word; and distinct
#: words of passages per ten thousand words.
MEASURES = (Measure("other_ratio"), Measure("capital_ratio"), Measure("word_length"), Measure("distinct_ratio", low=True))
#: Buckets of the sketch in an octave, as bits.
FINE = 6
#: The least distance of a quartile from the median that the sketch resolves, as a logarithm.
RESOLVED = math.log1p(2.0**-FINE)
#: Words of a passage within which distinct words are counted.
PASSAGE = 200
#: Multiple of the distance between quartile and median.
SPREAD = 14
#: Documents from which a group's own quantiles weigh more than its parent's.
PRIOR = 20


def _ratio(part: str, whole: str, scale: int) -> Column:
    return F.expr(f"CASE WHEN {whole} > 0 THEN ({part} * {scale}L) DIV {whole} ELSE 0L END")


def _distinct_words(passage: int) -> Column:
    """Distinct words of the array __w, as long, summed over its passages, so that length has no weight."""
    count = lambda w: F.size(F.array_distinct(w)).cast("long")
    starts = F.when(F.size("__w") > 0, F.sequence(F.lit(1), F.size("__w"), F.lit(passage)))
    parts = F.transform(starts, lambda i: count(F.slice("__w", i, passage)))
    return F.coalesce(F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))


def measure(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source"), passage: int = PASSAGE) -> DataFrame:
    """The columns ``keep`` with the base counts, base_failed and the measures of every whole text.

    distinct_ratio is the mean over consecutive passages of ``passage`` words (the last may be shorter), which cover the
    whole text: that of a whole text would fall with its length.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(
        *keep,
        words(F.col("text")).alias("__w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__l"),
        F.length(F.regexp_replace(text, SPACE + "+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("__capitals"),
        F.length(F.regexp_replace(text, r"[\p{L}\p{M}\x20\x09-\x0D]+", "")).cast("long").alias("__others"),
    )
    n = F.size("__w")
    hashed = own.withColumn(
        "__h",
        F.when(
            n > WINDOW,
            F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("__w", i, WINDOW))),
        ),
    ).select(
        *keep,
        "word_chars",
        "n_symbols",
        "__capitals",
        "__others",
        "__h",
        n.cast("long").alias("n_words"),
        _distinct_words(passage).alias("__distinct"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
    )
    ranked = hashed.withColumn(
        "__s",
        F.when(
            F.size(F.array_distinct("__h")) < F.size("__h"),
            F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("__h")
    twice = ranked.withColumn(
        "__p",
        F.sort_array(
            F.transform(
                F.filter(
                    "__s",
                    lambda x, j: F.coalesce(x["h"] == F.get("__s", j - 1)["h"], F.lit(False))
                    | F.coalesce(x["h"] == F.get("__s", j + 1)["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    ).drop("__s")
    covered = F.aggregate(
        F.transform("__p", lambda p, j: F.least(F.lit(WINDOW), F.get("__p", j + 1) - p)),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    counted = twice.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("__p")
    return counted.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words").alias("base_failed"),
        _ratio("__others", "word_chars", 10_000).alias("other_ratio"),
        _ratio("__capitals", "word_chars", 10_000).alias("capital_ratio"),
        _ratio("word_chars", "n_words", 100).alias("word_length"),
        _ratio("__distinct", "n_words", 10_000).alias("distinct_ratio"),
    )


def _bucket(name: str) -> Column:
    """The lower end of the value's bucket: its FINE + 1 highest bits."""
    return F.expr(f"shiftleft(shiftright({name}, greatest(length(bin({name})) - {FINE + 1}, 0)), greatest(length(bin({name})) - {FINE + 1}, 0))")


def sketch(measured: DataFrame) -> DataFrame:
    """Counts per (lang, source, measure, bucket): sketches that merge by adding counts. Base failures stay out."""
    pairs = F.array(*[F.struct(F.lit(m.name).alias("m"), _bucket(m.name).alias("b")) for m in MEASURES])
    return (
        measured.where(~F.col("base_failed"))
        .select("lang", "source", F.explode(pairs).alias("x"))
        .groupBy("lang", "source", F.col("x.m").alias("m"), F.col("x.b").alias("b"))
        .agg(F.count("*").alias("n"))
    )


def quantiles(sketches: DataFrame, *group: str) -> DataFrame:
    """Per group and measure of the sketches: n, and the logarithms of the median (mid) and of its ratio to the quartile on the good side (gap)."""
    merged = sketches.groupBy(*group, "m", "b").agg(F.sum("n").alias("n"))
    own = W.partitionBy(*group, "m")
    at = merged.withColumns({"cum": F.sum("n").over(own.orderBy("b")), "total": F.sum("n").over(own)})
    quartile = lambda k: F.min(F.when(F.col("cum") * 4 >= F.col("total") * k, F.col("b")))
    found = at.groupBy(*group, "m").agg(F.max("total").cast("double").alias("n"), quartile(1).alias("q1"), quartile(2).alias("q2"), quartile(3).alias("q3"))
    low = F.col("m").isin([m.name for m in MEASURES if m.low])
    gap = F.when(low, F.log((F.col("q3") + 1) / (F.col("q2") + 1))).otherwise(F.log((F.col("q2") + 1) / (F.col("q1") + 1)))
    return found.select(*group, "m", "n", F.log(F.col("q2") + 1.0).alias("mid"), F.greatest(gap, F.lit(RESOLVED)).alias("gap"))


def _leaning(own: DataFrame, parents: DataFrame, *keys: str) -> DataFrame:
    """own (n, mid, gap by measure) as means with those of its parents, which agree in keys."""
    of = parents.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("m").alias("__m"), F.col("mid").alias("__mid"), F.col("gap").alias("__gap"))
    same = F.col("m") == F.col("__m")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    w = F.col("n") * F.col("n") / (F.col("n") * F.col("n") + PRIOR * PRIOR)
    mid = w * F.col("mid") + (1 - w) * F.col("__mid")
    gap = w * F.col("gap") + (1 - w) * F.col("__gap") + w * F.abs(F.col("mid") - mid)
    return own.join(of, same).select(*[c for c in own.columns if c not in ("mid", "gap")], mid.alias("mid"), gap.alias("gap"))


def cutoffs(sketches: DataFrame) -> DataFrame:
    """One row per (lang, source) of the sketches: cut, a struct with a cut-off per measure."""
    everything = quantiles(sketches)
    languages = _leaning(quantiles(sketches, "lang"), everything)
    groups = _leaning(quantiles(sketches, "lang", "source"), languages, "lang")

    def cut(m: Measure) -> Column:
        away = F.col("mid") - SPREAD * F.col("gap") if m.low else F.col("mid") + SPREAD * F.col("gap")
        return F.max(F.when(F.col("m") == m.name, F.exp(away) - 1)).alias(m.name)

    return groups.groupBy("lang", "source").agg(*[cut(m) for m in MEASURES]).select("lang", "source", F.struct(*[m.name for m in MEASURES]).alias("cut"))


def judge(measured: DataFrame, cuts: DataFrame) -> DataFrame:
    """measured with kept: neither the base rule nor any cut-off of the document's group rejects it."""
    cuts = cuts.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), "cut")
    joined = measured.join(
        cuts, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left"
    )
    verdict = F.lit(True)
    for m in MEASURES:
        verdict &= F.col(m.name) >= F.col(f"cut.{m.name}") if m.low else F.col(m.name) <= F.col(f"cut.{m.name}")
    kept = ~F.col("base_failed") & F.coalesce(verdict, F.lit(True))
    return joined.withColumn("kept", kept).drop("__lang", "__source", "cut")


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def quality_rules(docs: DataFrame) -> DataFrame:
    """The verdict on every row of docs (doc_id, text, lang, source; other columns are ignored)."""
    measured = materialize(measure(docs), "quality-measures")
    cuts = materialize(cutoffs(sketch(measured)), "quality-cutoffs")
    return judge(measured, cuts).select(*COLUMNS)


def keep_good(docs: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """The rows of docs, all columns as they were, that the rules keep.

    Texts are measured once: rows and measures are written to the shared folder, from which the sketches read the measures
    only.
    """
    whole = docs.select(F.struct("*").alias("__row"), "doc_id", "text", "lang", "source")
    measured = materialize(measure(whole, ("__row", "lang", "source"), passage), "quality-measures")
    cuts = materialize(cutoffs(sketch(measured)), "quality-cutoffs")
    return judge(measured, cuts).where("kept").select("__row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def _measures_sql(docs: str) -> str:
    return f"""
rows_ AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, lang, source FROM {docs}),
split_ AS (SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM rows_),
grams AS (SELECT rid, unnest(range(1, len(w) - 6)) AS i, w FROM split_ WHERE len(w) > 8),
keyed AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g FROM grams),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM keyed) WHERE c > 1),
covered AS (SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n FROM
  (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY rid),
base AS (SELECT s.rid, doc_id, lang, source, len(w)::BIGINT AS n_words,
  length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
  length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS caps, length(regexp_replace(text, '[\\p{{L}}\\p{{M}}\\x20\\x09-\\x0D]+', '', 'g')) AS others,
  coalesce(list_sum(list_transform(range(1, len(w) + 1, {PASSAGE}), lambda i: len(list_distinct(w[i:i + {PASSAGE - 1}])))), 0)::BIGINT AS dist
  FROM split_ s LEFT JOIN covered c ON s.rid = c.rid),
measured AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  CASE WHEN word_chars > 0 THEN others * 10000 // word_chars ELSE 0 END AS other_ratio,
  CASE WHEN word_chars > 0 THEN caps * 10000 // word_chars ELSE 0 END AS capital_ratio,
  CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS word_length,
  CASE WHEN n_words > 0 THEN dist * 10000 // n_words ELSE 0 END AS distinct_ratio FROM base)"""


def _lean_sql(name: str, own: str, parent: str, keys: str, same: str) -> str:
    """A common table: the quantiles of own as means with those of parent."""
    return f"""{name} AS (SELECT {keys} m, w * o.mid + (1 - w) * p.mid AS mid,
  w * o.gap + (1 - w) * p.gap + w * abs(o.mid - (w * o.mid + (1 - w) * p.mid)) AS gap
  FROM (SELECT *, n * n / (n * n + {PRIOR * PRIOR}) AS w FROM {own}) o JOIN {parent} p USING (m) WHERE {same})"""


def _oracle() -> str:
    bucket = lambda v: f"({v} >> greatest(length(bin({v})) - {FINE + 1}, 0)) << greatest(length(bin({v})) - {FINE + 1}, 0)"
    long = " UNION ALL ".join(f"SELECT lang, source, '{m.name}' AS m, {bucket(m.name)} AS b FROM measured WHERE NOT base_failed" for m in MEASURES)
    low = ", ".join(f"'{m.name}'" for m in MEASURES if m.low)

    def quantiles_sql(name: str, *group: str) -> str:
        keys = "".join(f"{g}, " for g in group)
        return f"""{name} AS (SELECT {keys} m, n, ln(q2 + 1.0::DOUBLE) AS mid, greatest({RESOLVED!r}::DOUBLE,
  CASE WHEN m IN ({low}) THEN ln((q3 + 1)::DOUBLE / (q2 + 1)) ELSE ln((q2 + 1)::DOUBLE / (q1 + 1)) END) AS gap
  FROM (SELECT {keys} m, count(*)::DOUBLE AS n, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.5) AS q2, quantile_disc(b, 0.75) AS q3
  FROM long_ GROUP BY {keys} m) q)"""

    cut = lambda m: f"max(CASE WHEN m = '{m.name}' THEN exp(mid {'-' if m.low else '+'} {SPREAD} * gap) - 1 END) AS {m.name}"
    inside = " AND ".join(f"d.{m.name} {'>=' if m.low else '<='} c.{m.name}" for m in MEASURES)
    return f"""WITH {_measures_sql('documents')},
long_ AS ({long}),
{quantiles_sql('whole')}, {quantiles_sql('by_lang', 'lang')}, {quantiles_sql('by_group', 'lang', 'source')},
{_lean_sql('langs', 'by_lang', 'whole', 'o.lang,', 'true')},
{_lean_sql('groups_', 'by_group', 'langs', 'o.lang, o.source,', 'o.lang IS NOT DISTINCT FROM p.lang')},
cuts AS (SELECT lang, source, {', '.join(map(cut, MEASURES))} FROM groups_ GROUP BY lang, source)
SELECT d.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({inside}, true) AS kept
FROM measured d LEFT JOIN cuts c ON d.lang IS NOT DISTINCT FROM c.lang AND d.source IS NOT DISTINCT FROM c.source"""


ORACLE = _oracle()
