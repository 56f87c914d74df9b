"""The feature row of a candidate pair, from columns b_* (left) and x_* (right)."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from ..sources.io import materialize
from ..sources.shared import at_once
from . import classes

SIDES = ("first", "last", "street1", "city", "state", "zip5")


def _full(side: str) -> Column:
    return T.strip(F.concat(F.coalesce(F.col(f"{side}_first"), F.lit("")), F.lit(" "), F.coalesce(F.col(f"{side}_last"), F.lit(""))))


def with_vectors(pairs: DataFrame, weights: DataFrame | None, full: bool = True, last: bool = True) -> DataFrame:
    """pairs with what its features need of each name, computed once for each distinct name and joined.

    Of full and last names (either can be left out): the normalised text, its token set, whether it marks an organisation,
    its suffix and its phonetic code; of full names also word and character vectors (weights: token, idf), unless weights is None.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    named = pairs.withColumns({"b_full": _full("b"), "x_full": _full("x"), "__b_last": text("b_last"), "__x_last": text("x_last")})
    named = named.withColumns(
        {f"__{s}_street": T.norm(T.street_simplify(text(f"{s}_street1"))) for s in ("b", "x")} | {f"__{s}_city": T.norm(text(f"{s}_city")) for s in ("b", "x")}
    )
    used = [*["b_full", "x_full"] * full, *["__b_last", "__x_last"] * last]
    if not used:
        return named
    names = materialize(named.select(F.explode(F.array(*used)).alias("name")).distinct())
    of = names.select("name", T.norm(F.col("name")).alias("n")).select("name", "n", F.array_remove(F.split("n", " "), "").alias("words"))
    known = of.select(
        "name",
        F.struct(
            F.col("n"),
            F.array_distinct("words").alias("tokens"),
            F.arrays_overlap("words", F.array(*[F.lit(w) for w in T.ORGANISATION_WORDS])).alias("org"),
            T.suffix_token(F.col("name")).alias("suffix"),
            T.soundex(F.col("name")).alias("sound"),
        ).alias("of"),
    )
    if weights is not None:
        words = S.tfidf_vectors(names, "name", F.col("name"), weights).withColumnRenamed("vec", "words")
        grams = S.char3_vectors(names, "name", F.col("name")).withColumnRenamed("vec", "grams")
        known = known.join(words, "name").join(grams, "name")
    known = materialize(known)
    extra = [c for c in ("words", "grams") if c in known.columns]
    for side in ("b", "x"):
        whole = known.select(F.col("name").alias(f"{side}_full"), F.col("of").alias(f"{side}_f"), *[F.col(c).alias(f"{side}_{c}") for c in extra])
        surname = known.select(F.col("name").alias(f"__{side}_last"), F.col("of").alias(f"{side}_l"))
        named = named.join(whole, f"{side}_full") if full else named
        named = named.join(surname, f"__{side}_last") if last else named
    return named


def feature_columns(only: list[str] | None = None) -> dict[str, Column]:
    """All features, or ``only`` some, by name; needs the columns of with_vectors. What is not asked for is not built: the driver would take seconds for it."""
    c = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    flag = lambda cond: cond.cast("int")
    both = lambda f: (c(f"b_{f}") != "") & (c(f"x_{f}") != "")
    two = lambda f, part, of: f(F.col(f"b_{of}.{part}"), F.col(f"x_{of}.{part}"))
    org = lambda s: F.col(f"{s}_l.org") | F.col(f"{s}_f.org")
    suffix = lambda s: F.coalesce(F.nullif(T.norm(c(f"{s}_suffix")), F.lit("")), F.col(f"{s}_f.suffix"))
    initial = lambda s: T.norm_initial(c(f"{s}_first"))
    out = {
        "sim_jw_fullname": lambda: two(S.jaro_winkler_normed, "n", "f"),
        "sim_jw_lastname": lambda: two(S.jaro_winkler_normed, "n", "l"),
        "sim_lev_fullname": lambda: two(S.lev_sim_normed, "n", "f"),
        "sim_lev_lastname": lambda: two(S.lev_sim_normed, "n", "l"),
        "sim_soundex_last": lambda: flag((F.col("b_l.sound") != "") & (F.col("b_l.sound") == F.col("x_l.sound"))),
        "sim_jacc_fullname": lambda: two(S.overlap_ratio, "tokens", "f"),
        "sim_jacc_lastname": lambda: two(S.overlap_ratio, "tokens", "l"),
        "sim_tfidf_name": lambda: S.cosine(F.col("b_words"), F.col("x_words")),
        "sim_char3_name": lambda: S.cosine(F.col("b_grams"), F.col("x_grams")),
        "first_initial_match": lambda: flag((initial("b") != "") & (initial("b") == initial("x"))),
        "state_match": lambda: flag(both("state") & (T.norm(c("b_state")) == T.norm(c("x_state")))),
        "zip_match": lambda: flag(both("zip5") & (T.norm(c("b_zip5")) == T.norm(c("x_zip5")))),
        "zip3_match": lambda: flag(both("zip5") & (T.zip3(c("b_zip5")) != "") & (T.zip3(c("b_zip5")) == T.zip3(c("x_zip5")))),
        "sim_jw_city": lambda: S.jaro_winkler_normed(F.col("__b_city"), F.col("__x_city")),
        "sim_jw_street1": lambda: F.when((c("b_street1") == "") & (c("x_street1") == ""), F.lit(0.0)).otherwise(
            S.jaro_winkler_normed(F.col("__b_street"), F.col("__x_street"))
        ),
        "org_keyword_match": lambda: flag(org("b") & org("x")),
        "org_vs_person_conflict": lambda: flag(org("b") != org("x")),
        "credential_overlap": lambda: S.overlap_ratio(T.credential_tokens(c("b_cred")), T.credential_tokens(c("x_cred"))),
        "suffix_match": lambda: flag((suffix("b") != "") & (suffix("b") == suffix("x"))),
    }
    out |= {f"miss_{s}_{f}": lambda s=s, f=f: flag(c(f"{s}_{f}") == "") for s in ("b", "x") for f in SIDES}
    out["sim_zip_num"] = lambda: S.zip_num_sim(c("b_zip5"), c("x_zip5"))
    out["n_years_b"] = lambda: F.least(F.coalesce(F.col("b_n_years").cast("double"), F.lit(0.0)), F.lit(20.0)) / 20.0
    return {name: make() for name, make in out.items() if only is None or name in only}


#: The features in their order.
FEATURES = [
    *["sim_jw_fullname", "sim_jw_lastname", "sim_lev_fullname", "sim_lev_lastname", "sim_soundex_last", "sim_jacc_fullname"],
    *["sim_jacc_lastname", "sim_tfidf_name", "sim_char3_name", "first_initial_match", "state_match", "zip_match", "zip3_match"],
    *["sim_jw_city", "sim_jw_street1", "org_keyword_match", "org_vs_person_conflict", "credential_overlap", "suffix_match"],
    *[f"miss_b_{f}" for f in SIDES],
    *[f"miss_x_{f}" for f in SIDES],
    *["sim_zip_num", "n_years_b"],
]

_INPUTS = [f"{s}_{f}" for s in ("b", "x") for f in (*SIDES, "cred", "suffix")] + ["b_n_years"]

#: Features of last names and of full names.
_LAST = {"sim_jw_lastname", "sim_lev_lastname", "sim_soundex_last", "sim_jacc_lastname", "org_keyword_match", "org_vs_person_conflict"}
_FULL = {"sim_jw_fullname", "sim_lev_fullname", "sim_jacc_fullname", "sim_tfidf_name", "sim_char3_name", "org_keyword_match", "org_vs_person_conflict", "suffix_match"}
_FIELDS = {"first_initial_match": ["first"], "state_match": ["state"], "zip_match": ["zip5"], "zip3_match": ["zip5"], "sim_jw_city": ["city"], "sim_jw_street1": ["street1"]}
_FIELDS |= {"credential_overlap": ["cred"], "suffix_match": ["first", "last", "suffix"], "sim_zip_num": ["zip5"]}


def inputs(only: list[str]) -> set[str]:
    """The columns that the features ``only`` are computed from."""
    out = set()
    for name in only:
        if name.startswith("miss_"):
            out.add(name.removeprefix("miss_"))
        elif name == "n_years_b":
            out.add("b_n_years")
        else:
            fields = _FIELDS.get(name) or (["first", "last"] if name in _FULL else ["last"])
            out |= {f"{s}_{f}" for s in ("b", "x") for f in fields}
    return out


def feature_rows(pairs: DataFrame, weights: DataFrame, only: list[str] | None = None) -> DataFrame:
    """pairs with one column per feature. Input columns that pairs lacks count as empty; weights: token, idf."""
    full = pairs.withColumns({n: F.lit(None).cast("string") for n in _INPUTS if n not in pairs.columns})
    made = feature_columns(only)
    wanted = set(only or FEATURES)
    vectors = {"sim_tfidf_name", "sim_char3_name"} & wanted
    named = with_vectors(full, weights if vectors else None, bool(wanted & _FULL), bool(wanted & _LAST))
    return named.withColumns({n: made[n] for n in only or FEATURES}).select(*pairs.columns, *(only or FEATURES))


def block_rows(
    left: DataFrame, right: DataFrame, ids: list[str], keys: list[tuple[str, str]], weights: DataFrame, only: list[str] | None = None, digits: int | None = None, near: bool = False
) -> DataFrame:
    """feature_rows of every pair of rows of left (b_*) and right (x_*) whose keys (a column of each) agree.

    Rows that differ in ``ids`` only are a class: features are computed once for each pair of classes, and the pairs of
    their rows are listed at the end, without a shuffle of them. digits: doubles among the features are rounded to as many;
    near: rows of equal keys are listed near each other (``classes.listed``), for results that are written.
    """
    sides = [functools.partial(classes.classes, df, [c for c in ids if c in df.columns], s) for df, s in ((left, "left"), (right, "right"))]
    a, b = at_once(left.sparkSession, *sides)
    cores = left.sparkSession.sparkContext.defaultParallelism
    met = a.drop("left_rows").join(b.drop("right_rows"), [F.col(x) == F.col(y) for x, y in keys])
    rows = feature_rows(met.repartition(cores), weights, only)
    if digits is not None:
        rows = rows.withColumns({c: F.round(c, digits) for c, t in rows.dtypes if c in (only or FEATURES) and t == "double"})
    return classes.listed(rows, a, b, tuple(x for x, _ in keys) if near else ()).select(*[c for c in (*left.columns, *right.columns)], *(only or FEATURES))


def weak_label(left_id: Column, right_id: Column) -> Column:
    """Null without a left id, else 1 if the ids agree, else 0."""
    return F.when(left_id.isNull(), None).when(left_id == right_id, 1).otherwise(0)
