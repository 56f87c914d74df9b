"""The test tables in the roles of the pipeline: people to link, claims, texts, scored pairs. SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PEOPLE = """SELECT p_partkey, split_part(p_name, ' ', 1) AS first_name,
 split_part(p_name, ' ', 2) || CASE WHEN p_size % 11 = 0 THEN ' medical group' WHEN p_size % 13 = 0 THEN ' jr' ELSE '' END AS last_name,
 p_type AS state,
 CASE WHEN p_size % 10 = 0 THEN NULL ELSE CAST(10000 + 137 * CAST(substr(p_brand, 7) AS INT) AS STRING) END AS zip5,
 CASE WHEN p_size % 7 = 0 THEN NULL ELSE CAST(p_size AS STRING) || ' Main St' || CASE WHEN p_size % 4 = 0 THEN ' Apt 3' ELSE '' END END AS street1,
 p_type || ' City' AS city,
 CASE p_size % 5 WHEN 0 THEN 'MD' WHEN 1 THEN 'MD PhD' WHEN 2 THEN 'XYZ' END AS credentials,
 CASE WHEN p_size % 3 = 0 THEN lpad(CAST(p_partkey - 1 AS STRING), 10, '0') END AS npi_link,
 lpad(CAST(p_partkey AS STRING), 10, '0') AS own_npi, p_size % 25 AS n_years, p_brand FROM part"""
LEFT = f"""SELECT CAST(p_partkey AS STRING) AS profile_id, npi_link AS npi, first_name, last_name, state, zip5, street1, city,
 n_years, p_brand FROM ({PEOPLE}) p WHERE p_partkey % 2 = 1"""
RIGHT = f"""SELECT own_npi AS npi, first_name, last_name AS last_or_org_name, state, zip5, street1, city, credentials, p_brand
 FROM ({PEOPLE}) p WHERE p_partkey % 2 = 0"""
#: Candidate pairs that share state and zip, with the inputs of the feature row.
PAIRS = f"""SELECT l.profile_id AS left_id, r.npi AS right_id, l.npi AS left_npi, l.first_name AS b_first, l.last_name AS b_last,
 l.street1 AS b_street1, l.city AS b_city, l.state AS b_state, l.zip5 AS b_zip5, l.n_years AS b_n_years,
 r.first_name AS x_first, r.last_or_org_name AS x_last, r.street1 AS x_street1, r.city AS x_city, r.state AS x_state,
 r.zip5 AS x_zip5, r.credentials AS x_cred FROM ({LEFT}) l JOIN ({RIGHT}) r ON l.state = r.state AND l.zip5 = r.zip5"""
#: Scored rows for evaluation: y from labels, a score of coarse steps from the text's length and id.
SCORED = """SELECT d.doc_id, d.source AS grp, d.lang AS pair_type, l.quality AS y,
 CAST((d.doc_id * 37 + 11 * d.n_chars) % 50 + 40 * l.quality AS DOUBLE) / 90 AS score,
 CAST((d.doc_id * 53 + 7 * d.n_chars) % 50 + 30 * l.quality AS DOUBLE) / 80 AS score_b
 FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def role(spark: SparkSession, sf_dir: str, sql: str, read: dict[str, DataFrame] | None = None) -> DataFrame:
    """A role's rows; its SQL reads tables by name. read: tables that are open already, as opening one is a job of its own."""
    used = [t for t in TABLES if f" {t}" in sql]
    for t in used:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(sql, **{t: (read or {}).get(t) or table(spark, sf_dir, t) for t in used if f"{{{t}}}" in sql})
