"""The whole linkage over small synthetic files."""

import csv
import random

from tether.plans import linkage


def write(path, columns, rows):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(columns)
        out.writerows(rows)


def files(folder):
    rng = random.Random(0)
    first, last = "John Mary Alice Bob Carol Dan Eve Frank".split(), "Smith Jones Brown Taylor Wilson Davies Evans Thomas".split()
    claims, payments, registry = [], [], []
    for i in range(160):
        npi, f, n, state, zip5 = f"{1000000000 + i}", rng.choice(first), rng.choice(last), rng.choice(["TX", "CA"]), f"0{rng.randint(2000, 2006)}"
        for k in range(rng.randint(1, 3)):
            claims.append([npi, f, "", n, "M.D.", f"{i} Main St", "", "Town", state, zip5, "Type", f"H{k}", "10", "x" if k else "20", "1.5"])
        payments.append([f"p{i}", npi if i % 4 else "", f, "", n + (" Jr" if i % 9 == 0 else ""), "", f"{i} Main Street", "", "Town", state, zip5 + "-1234", "S", "T", state, "12.5", str(2019 + i % 3)])
        registry.append([npi, f, "", n, "", state, "1", "Desc"])
    for name, raw, rows in (("a", linkage.CLAIMS, claims), ("b", linkage.PAYMENTS, payments), ("c", linkage.REGISTRY, registry)):
        write(folder / f"{name}.csv", list(raw.columns.values()), rows)
    return [f"--{n}={folder}/{f}.csv" for n, f in (("claims", "a"), ("payments", "b"), ("registry", "c"))] + [f"--out={folder}/out"]


def test_all_steps(spark, tmp_path, capsys):
    args = files(tmp_path)
    assert linkage.main([*args, "--steps=nothing"], spark) == 2
    assert linkage.main(args, spark) == 0, capsys.readouterr().out
    read = lambda name: spark.read.parquet(f"{tmp_path}/out/{name}")
    a = {r.npi: r for r in read("providers_a").collect()}
    assert len(a) == 160 and a["1000000001"].zip5.startswith("02") and a["1000000001"].credentials == "MD"
    assert read("providers_b").where("npi IS NULL").count() == 40
    report = {r["pass"]: r for r in read("blocking_report_ba").collect()}
    assert report["all"].recall == 1.0 and report["exact_id"].n_pairs == 120
    rows = read("pair_features_ba")
    assert rows.count() == read("cand_ba").count() and rows.where("label_weak_npi = 1").count() == 120
    assert read("models/results").count() == 3 and read("validation/bootstrap").first().mean > 0.3
    assert linkage.main([*args, "--steps=features,model", "--claims=none.csv", "--out=/nonexistent/x"], spark) == 1
