"""The whole linkage of three raw provider tables: ingest, profile, candidates, features, model, validation.

    python -m tether.plans.linkage --claims a.csv --payments b.csv --registry c.csv --out DIR [--steps ingest,blocking]

Every step reads the Parquet of earlier steps from the output folder and writes its own.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from ..operators import blocking, entities, evaluate, features, learning, profile
from ..session import local_session
from ..sources import io as IO
from . import pipeline


@dataclass(frozen=True)
class Raw:
    """A raw CSV table: its columns by output name, how each is normalised, and how rows make entities."""

    key: str
    columns: dict[str, str]
    ids: tuple[str, ...] = ()
    zips: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    plain: tuple[str, ...] = ()
    first: tuple[str, ...] = ()
    sums: dict[str, str] = field(default_factory=dict)
    means: dict[str, str] = field(default_factory=dict)
    uniques: dict[str, str] = field(default_factory=dict)
    rows: str | None = None

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """The file's rows, normalised; order is their place in the file."""
        header = spark.read.option("header", True).csv(path).columns
        raw = IO.read_csv(spark, path, header)
        return raw.select(F.monotonically_increasing_id().alias("order"), *[self._clean(n, F.col(f"`{c}`")).alias(n) for n, c in self.columns.items()])

    def _clean(self, name: str, c: Column) -> Column:
        if name in self.ids:
            return T.normalize_npi(c)
        if name in self.zips:
            return T.normalize_zip(c)
        if name in self.numbers:
            return c.try_cast("double")
        return c if name in self.plain else T.normalize_text(c)

    def resolve(self, rows: DataFrame) -> DataFrame:
        return entities.resolve(rows, self.key, F.col("order"), list(self.first), self.sums, self.means, self.uniques, self.rows)


# Columns of the public claims, payments and registry files.
CLAIMS = Raw(
    key="npi",
    columns={
        "npi": "Rndrng_NPI", "first_name": "Rndrng_Prvdr_First_Name", "middle_name": "Rndrng_Prvdr_MI", "last_or_org_name": "Rndrng_Prvdr_Last_Org_Name",
        "credentials": "Rndrng_Prvdr_Crdntls", "street1": "Rndrng_Prvdr_St1", "street2": "Rndrng_Prvdr_St2", "city": "Rndrng_Prvdr_City",
        "state": "Rndrng_Prvdr_State_Abrvtn", "zip5": "Rndrng_Prvdr_Zip5", "provider_type": "Rndrng_Prvdr_Type", "hcpcs_cd": "HCPCS_Cd",
        "tot_benes": "Tot_Benes", "tot_srvcs": "Tot_Srvcs", "avg_std_amt": "Avg_Mdcr_Stdzd_Amt",
    },
    ids=("npi",), zips=("zip5",), numbers=("tot_benes", "tot_srvcs", "avg_std_amt"), plain=("hcpcs_cd",),
    first=("first_name", "middle_name", "last_or_org_name", "credentials", "street1", "street2", "city", "state", "zip5", "provider_type"),
    sums={"sum_benes": "tot_benes", "sum_srvcs": "tot_srvcs"}, means={"mean_avg_std_amt": "avg_std_amt"},
    uniques={"n_unique_hcpcs": "hcpcs_cd", "n_unique_street1": "street1", "n_unique_city": "city", "n_unique_name": "last_or_org_name"},
)
PAYMENTS = Raw(
    key="profile_id",
    columns={
        "profile_id": "Covered_Recipient_Profile_ID", "npi": "Covered_Recipient_NPI", "first_name": "Covered_Recipient_First_Name",
        "middle_name": "Covered_Recipient_Middle_Name", "last_name": "Covered_Recipient_Last_Name", "suffix": "Covered_Recipient_Name_Suffix",
        "street1": "Recipient_Primary_Business_Street_Address_Line1", "street2": "Recipient_Primary_Business_Street_Address_Line2",
        "city": "Recipient_City", "state": "Recipient_State", "zip5": "Recipient_Zip_Code", "specialty_1": "Covered_Recipient_Specialty_1",
        "primary_type_1": "Covered_Recipient_Primary_Type_1", "license_state_1": "Covered_Recipient_License_State_code1",
        "payment_amount": "Total_Amount_of_Payment_USDollars", "program_year": "Program_Year",
    },
    ids=("npi",), zips=("zip5",), numbers=("payment_amount", "program_year"), plain=("profile_id",),
    first=("npi", "first_name", "middle_name", "last_name", "suffix", "street1", "street2", "city", "state", "zip5", "specialty_1", "primary_type_1", "license_state_1"),
    sums={"sum_payment_amount": "payment_amount"}, means={"mean_payment_amount": "payment_amount"},
    uniques={"n_years": "program_year", "n_unique_street1": "street1", "n_unique_city": "city", "n_unique_last_name": "last_name"}, rows="n_payment_rows",
)
REGISTRY = Raw(
    key="npi",
    columns={
        "npi": "NPI", "first_name": "FIRST_NAME", "middle_name": "MDL_NAME", "last_name": "LAST_NAME", "org_name": "ORG_NAME", "state": "STATE_CD",
        "provider_type_cd": "PROVIDER_TYPE_CD", "provider_type_desc": "PROVIDER_TYPE_DESC",
    },
    ids=("npi",), plain=("provider_type_cd",),
    first=("first_name", "middle_name", "last_name", "org_name", "state", "provider_type_cd", "provider_type_desc"),
    uniques={"n_unique_provider_type_desc": "provider_type_desc"},
)


# Canonical concepts and their columns in the three tables.
CONCEPTS = {
    "npi": {"providers_a": "npi", "providers_b": "npi", "providers_c": "npi"},
    "first_name": {"providers_a": "first_name", "providers_b": "first_name", "providers_c": "first_name"},
    "last_name_or_org": {"providers_a": "last_or_org_name", "providers_b": "last_name", "providers_c": "last_name"},
    "state": {"providers_a": "state", "providers_b": "state", "providers_c": "state"},
    "zip5": {"providers_a": "zip5", "providers_b": "zip5", "providers_c": None},
    "city": {"providers_a": "city", "providers_b": "city", "providers_c": None},
}


@dataclass
class Linkage:
    """The steps over three CSV files and an output folder. Caps and window bound the blocks; accuracy is that of quantile sketches."""

    claims: str
    payments: str
    registry: str
    out: str
    zip_cap: int = 500
    last_cap: int = 2000
    window: int = 50
    target_precision: float = 0.95
    accuracy: int = 10_000

    def _write(self, df: DataFrame, name: str) -> None:
        IO.write_parquet(df, f"{self.out}/{name}")

    def _read(self, spark: SparkSession, name: str) -> DataFrame:
        return IO.read_parquet(spark, f"{self.out}/{name}")

    def _providers(self, spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
        a, b, c = (self._read(spark, f"providers_{x}") for x in "abc")
        return a, b, c

    def ingest(self, spark: SparkSession) -> None:
        for name, raw, path in (("a", CLAIMS, self.claims), ("b", PAYMENTS, self.payments), ("c", REGISTRY, self.registry)):
            self._write(raw.resolve(raw.read(spark, path)), f"providers_{name}")

    def eda(self, spark: SparkSession) -> None:
        tables = dict(zip(("providers_a", "providers_b", "providers_c"), self._providers(spark), strict=True))
        counts = {"n_unique", "n_payment", "n_years"}
        reports: dict[str, DataFrame] = {}
        for name, df in tables.items():
            measured = [c for c in profile.numeric_columns(df) if not any(c.startswith(x) for x in counts)]
            parts = {
                "missingness": profile.missingness(df, name),
                "info_content": profile.info_content(df, name, [c for c, t in df.dtypes if t == "string"]),
                "top_values": profile.top_values(df, name, [c for c in ("state", "city", "provider_type", "specialty_1", "provider_type_desc") if c in df.columns], 15),
            }
            parts["imputation"] = profile.imputation(parts["missingness"])
            if measured:
                parts["summary_stats"] = profile.numeric_summary(df, name, measured, accuracy=self.accuracy)
                parts["correlations"] = profile.correlations(df, name, measured)
            for report, rows in parts.items():
                reports[report] = reports[report].unionByName(rows) if report in reports else rows
        reports["outliers"] = profile.outliers(tables["providers_a"], "providers_a", "sum_benes", "npi", accuracy=self.accuracy).unionByName(
            profile.outliers(tables["providers_b"], "providers_b", "sum_payment_amount", "profile_id", accuracy=self.accuracy)
        )
        a, b, c = tables.values()
        reports["outliers"] = reports["outliers"].unionByName(profile.outliers(a, "providers_a", "sum_srvcs", "npi", accuracy=self.accuracy))
        reports["tests"] = profile.chi_square(a, F.col("zip5").isNull(), F.col("n_unique_name") > 1, "zip missing and name drift (A)").unionByName(
            profile.ks_two_sample(b, F.col("npi").isNotNull(), "sum_payment_amount", "payments by presence of npi (B)")
        )
        reports["schema_map"] = profile.schema_map(spark, CONCEPTS)
        shared = [profile.overlap_rate(a, other, "state", "state").select(F.lit("state").alias("field"), F.lit(f"providers_a, {name}").alias("pair"), "overlap_rate") for name, other in (("providers_b", b), ("providers_c", c))]
        reports["overlap"] = shared[0].unionByName(shared[1])
        for report, rows in reports.items():
            self._write(rows, f"eda/{report}")

    def _key_reports(self, spark: SparkSession) -> None:
        """Sizes of the blocks of each key, and how much the keys' attributes tell of each other."""
        last = {"a": "last_or_org_name", "b": "last_name", "c": "last_name"}
        stats, tells = None, None
        for name, df in zip("abc", self._providers(spark), strict=True):
            own = df.withColumns({"last_key": T.last_key(F.col(last[name])), "first_init": T.first_initial(F.col("first_name"))})
            keys = {"state_last": ["state", "last_key"], "state_last_fi": ["state", "last_key", "first_init"]}
            if name != "c":
                keys |= {"state_zip": ["state", "zip5"], "state_city": ["state", "city"]}
            for key, columns in keys.items():
                part = profile.key_stats(own.select(T.block_key(*map(F.col, columns)).alias(key)), key, name.upper())
                stats = part if stats is None else stats.unionByName(part)
            wanted = [c for c in ("state", "zip5", "city", "last_key", "first_init") if c in own.columns]
            part = profile.mutual_information(own, wanted, name.upper())
            tells = part if tells is None else tells.unionByName(part)
        self._write(stats, "blocking_key_stats")
        self._write(tells, "blocking_mutual_information")

    def blocking(self, spark: SparkSession) -> None:
        self._key_reports(spark)
        a, b, c = self._providers(spark)
        col = F.col
        near = lambda last: T.block_key(col("state"), T.last_key(col(last)), T.first_initial(col("first_name")))
        state_zip, state_city = T.block_key(col("state"), col("zip5")), T.block_key(col("state"), col("city"))
        state_last = T.block_key(col("state"), T.last_key(col("last_name")))
        tokens = lambda df, key, last: df.select(
            col(key).alias("id"), "state", T.block_tokens(F.concat_ws(" ", F.coalesce("first_name", F.lit("")), F.coalesce(last, F.lit("")))).alias("tokens")
        )
        left, right = tokens(b, "profile_id", "last_name"), tokens(a, "npi", "last_or_org_name")
        bare = lambda df: df.where(col("zip5").isNull())
        ba = [
            blocking.exact_id(b, a, "profile_id", "npi", "npi"),
            blocking.capped_block(b, a, "profile_id", "npi", state_zip, state_zip, "state_zip", self.zip_cap),
            blocking.capped_block(bare(b), bare(a), "profile_id", "npi", state_city, state_city, "state_city", None),
            blocking.neighbourhood(b, a, "profile_id", "npi", near("last_name"), near("last_or_org_name"), self.window),
            blocking.canopy(left, right),
            blocking.lsh_pairs(left, right),
        ]
        bc = [
            blocking.exact_id(b, c, "profile_id", "npi", "npi"),
            blocking.capped_block(b, c, "profile_id", "npi", state_last, state_last, "state_lastkey", self.last_cap),
            blocking.neighbourhood(b, c, "profile_id", "npi", near("last_name"), near("last_name"), self.window),
        ]
        for name, passes in (("ba", ba), ("bc", bc)):
            out = passes[0]
            for p in passes[1:]:
                out = out.unionByName(p)
            out = IO.materialize(out)
            self._write(blocking.dedupe(out), f"cand_{name}")
            self._write(blocking.recall_report(out, out.where(F.col("pass") == "exact_id")), f"blocking_report_{name}")
        self._write(a.select("npi").join(c.select("npi"), "npi", "left_semi").select(col("npi").alias("npi_a"), col("npi").alias("npi_c"), F.lit("exact_id").alias("pass")), "cand_ac")

    def features(self, spark: SparkSession) -> None:
        a, b, c = self._providers(spark)
        full = lambda df, last: df.select(F.concat_ws(" ", F.coalesce("first_name", F.lit("")), F.coalesce(last, F.lit(""))).alias("name"))
        corpus = full(a, "last_or_org_name").union(full(b, "last_name")).union(full(c, "last_name"))
        weights = IO.materialize(S.idf(F.col("name"), corpus))
        self._write(weights, "idf")
        fields = ["street1", "city", "state", "zip5"]
        left = b.select(F.col("profile_id").alias("left_id"), F.col("npi").alias("left_npi"), F.col("first_name").alias("b_first"), F.col("last_name").alias("b_last"), F.col("n_years").alias("b_n_years"), *[F.col(f).alias(f"b_{f}") for f in fields])
        right_a = a.select(F.col("npi").alias("right_id"), F.col("first_name").alias("x_first"), F.col("last_or_org_name").alias("x_last"), F.col("credentials").alias("x_cred"), *[F.col(f).alias(f"x_{f}") for f in fields])
        right_c = c.select(F.col("npi").alias("right_id"), F.col("first_name").alias("x_first"), F.col("last_name").alias("x_last"), F.col("state").alias("x_state"))
        for name, right in (("ba", right_a), ("bc", right_c)):
            pairs = self._read(spark, f"cand_{name}").join(left, "left_id", "left").join(right, "right_id", "left")
            rows = features.feature_rows(pairs, weights).withColumn("label_weak_npi", features.weak_label(F.col("left_npi"), F.col("right_id")).cast("byte"))
            self._write(rows.select("left_id", "right_id", "pass", "block_key", "label_weak_npi", *features.FEATURES), f"pair_features_{name}")

    def _labelled(self, spark: SparkSession) -> DataFrame:
        both = [self._read(spark, f"pair_features_{n}").withColumn("pair_type", F.lit(n.upper())) for n in ("ba", "bc")]
        return both[0].unionByName(both[1]).where("label_weak_npi IS NOT NULL").withColumn("y", F.col("label_weak_npi").cast("int")).fillna(0.0, features.FEATURES)

    def model(self, spark: SparkSession) -> None:
        own = IO.materialize(learning.training_set(self._labelled(spark), "left_id", "right_id", "pair_type"))
        results = learning.select_model(own, features.FEATURES, "left_id")
        self._write(results, "models/results")
        best = results.first().model
        train, test = learning.holdout(own, "left_id")
        fitted = learning.estimators(features.FEATURES)[best].fit(learning.balanced(train))
        scored = IO.materialize(learning.predict(fitted, test))
        self._write(evaluate.precision_targets(scored, [self.target_precision]).select(F.lit("precision target").alias("kind"), "threshold").unionByName(evaluate.best_f1(scored).select(F.lit("best F1").alias("kind"), "threshold")), "models/thresholds")
        self._write(scored, "models/holdout")
        final = learning.estimators(features.FEATURES)[best].fit(learning.balanced(own))
        IO.save_model(final, f"{self.out}/models/best")

    def stat_validation(self, spark: SparkSession) -> None:
        scored = self._read(spark, "models/holdout")  # by the model that did not see these groups
        thresholds = {r.kind: r.threshold for r in self._read(spark, "models/thresholds").collect()}
        at = thresholds["precision target"]
        self._write(evaluate.confusion(scored, at, ["pair_type"]), "validation/by_pair_type")
        self._write(evaluate.threshold_sensitivity(scored), "validation/thresholds")
        self._write(evaluate.precision_targets(scored, [0.90, 0.95, 0.98]), "validation/precision_targets")
        self._write(evaluate.interval(evaluate.bootstrap_metrics(scored, "left_id", 400), "pr_auc", ["model"]), "validation/bootstrap")

    def steps(self) -> dict[str, Callable[[SparkSession], object]]:
        return {s: getattr(self, s) for s in pipeline.STEPS}


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """The command line: 0 if all steps ran, 1 after a failure, 2 for an unknown step."""
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name in ("claims", "payments", "registry", "out"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--steps", help="comma-separated subset of " + ",".join(pipeline.STEPS))
    parser.add_argument("--skip-eda", action="store_true")
    parser.add_argument("--skip-model", action="store_true")
    given = parser.parse_args(args)
    wanted = [s.strip() for s in given.steps.split(",") if s.strip()] if given.steps else None
    try:
        todo = pipeline.resolve(wanted, given.skip_eda, given.skip_model)
    except pipeline.UnknownStep as e:
        print(f"unknown steps: {e}", file=sys.stderr)
        return 2
    spark = spark or local_session()
    report = pipeline.run(spark, todo, Linkage(given.claims, given.payments, given.registry, given.out).steps()).collect()
    for r in report:
        print(f"{r.step}: {r.status} ({r.seconds:.1f} s)" + (f" {r.error}" if r.error else ""))
    return int(any(r.status != "ok" for r in report))


if __name__ == "__main__":
    sys.exit(main())
