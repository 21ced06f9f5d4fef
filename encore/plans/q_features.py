"""Registered queries: the wide feature table and its regex-filtered form."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import numeric as N
from ..functions import text as T
from ..operators import adjust as X
from ..operators.aggregate import programme_by_season
from ..operators.features import build_features, build_history, drop_matching, matching_columns
from ..session import scratch_path
from ..sources.bind import Bundle, read_bundle
from ..sources.files import KEYED, read_csv_bundle, write_csv_bundle
from ..spec import binding_spec, reference_spec, suffix
from .common import rounded
from .feature_sql import all_feature_columns, feature_names, feature_sql
from .bind_sql import ctes
from .registry import query

SPEC = binding_spec()


def _sql_select(cols: list[str]) -> str:
    numeric, _ = feature_names(SPEC)
    from .feature_sql import derived_sql
    dbl = set(numeric) | {n for n, _ in derived_sql(SPEC)}
    return "SELECT " + ", ".join(f"round({c}, 6) AS {c}" if c in dbl else c for c in cols) + " FROM features"


def feature_table_sql() -> str:
    return feature_sql(SPEC, _sql_select(all_feature_columns(SPEC)))


@query("feature_table", covers=("D6", "J1", "C6", "C8", "Q8", "D1", "D2", "D3", "D4", "D5", "A13", "A14", "A15",
                                "A17", "A18", "P9", "P6", "P10", "R3", "R4", "R5", "A1", "A2", "A3", "A6", "A8"),
       sql=feature_table_sql)
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """preparePredictors: one typed row per account with every feature family."""
    return rounded(build_features(read_bundle(spark, sf_dir)))


def gbm_filter_sql() -> str:
    cols = all_feature_columns(SPEC)
    gone = set(matching_columns(cols, K.FILTER_GBM)) - {"account_id"}
    return feature_sql(SPEC, _sql_select([c for c in cols if c not in gone]))


@query("feature_table_gbm_filter", covers=("P7", "Q6", "P3"), sql=gbm_filter_sql)
def feature_table_gbm_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table with the boosted-tree driver's regex filter applied (columns dropped by name)."""
    return rounded(build_features(read_bundle(spark, sf_dir), filter_regex=K.FILTER_GBM))


ACC_COLS = ["account_id", "amount_donated_2013", "amount_donated_lifetime", "no_donations_lifetime", "years_donating",
            "is_us", "billing_city", "relationship", "account_num", "add_donated_2013",
            "add_no_donations_lifetime_if_donated_2013", "add_avg_donation", "add_avg_donation_if_donated_2013"]


def _acc_sql() -> str:
    from .feature_sql import acc_cte, with_ctes
    txt = {"account_id", "billing_city", "relationship"}
    return with_ctes(SPEC, ["accounts"], [acc_cte(SPEC)],
                     "SELECT " + ", ".join(c if c in txt else f"round({c}, 6) AS {c}" for c in ACC_COLS) + " FROM acc_f")


@query("account_donation_features", covers=("C9", "C11", "C12", "C20", "D1", "D2", "P10", "C1"), sql=_acc_sql)
def account_donation_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed account fields, years donating, domestic flag, dense account number, donation features."""
    from ..operators.features import account_family
    b = read_bundle(spark, sf_dir)
    return rounded(account_family(b.accounts, b.spec).select(*ACC_COLS))


def _from_csv(spark: SparkSession, sf_dir: str, log_label: bool = False) -> Bundle:
    """The bundle written as eight CSV extracts and read back from them."""
    paths = write_csv_bundle(read_bundle(spark, sf_dir), scratch_path(spark, f"bundles/{uuid.uuid4().hex}"))
    return read_csv_bundle(spark, paths, SPEC, log_label, key_type="bigint")


@query("csv_bundle_features", covers=("S4", "S2", "D6"), sql=feature_table_sql)
def csv_bundle_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide feature table built from the eight extracts as CSV files."""
    return rounded(build_features(_from_csv(spark, sf_dir)))


@query("csv_bundle_log_labels", covers=("S4", "C18"),
       sql=lambda: f"WITH {ctes(SPEC)['train_labels']}\nSELECT account_id, round(ln(1 + total), 6) AS log_total, "
                   "total FROM train_labels")
def csv_bundle_log_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels read from CSV with the log-label flag, and taken back to counts."""
    labels = _from_csv(spark, sf_dir, log_label=True).labels
    return rounded(labels.select("account_id", F.col("total").alias("log_total"), N.unlog_label("total").alias("total")))


REFERENCE = reference_spec()


def _reference_sql() -> str:
    from .feature_sql import derived_sql
    numeric, _ = feature_names(REFERENCE)
    dbl = set(numeric) | {n for n, _ in derived_sql(REFERENCE)}
    return feature_sql(REFERENCE, "SELECT " + ", ".join(f"round({c}, 6) AS {c}" if c in dbl else c for c in all_feature_columns(REFERENCE)) + " FROM features")


@query("reference_season_features", covers=("D6", "A13", "A14", "A15", "A17", "A18", "R3", "R5"), sql=_reference_sql)
def reference_season_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide feature table over 18 seasons of history with windows of up to 8 seasons, composers by part."""
    return rounded(build_features(read_bundle(spark, sf_dir, REFERENCE)))


@query("reference_programme", covers=("A4", "A5"), sql=lambda: f"WITH {ctes(REFERENCE)['programme']}\nSELECT season, "
       + ", ".join(f"CAST(sum(CAST({c} AS DOUBLE)) AS DOUBLE) AS {c}" for c in REFERENCE.composers) + " FROM programme WHERE season IN (" + ", ".join(f"'{x}'" for x in (*REFERENCE.history_seasons, REFERENCE.target_season)) + ") GROUP BY season")
def reference_programme(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programme composition by season over all 33 composer columns."""
    b = read_bundle(spark, sf_dir, REFERENCE)
    return rounded(programme_by_season(b.programme, REFERENCE))


def _reference_invariant_sql() -> str:
    t = lambda n: [f"total_{suffix(s)}" for s in REFERENCE.last(n)]
    nine, six, three = t(9), t(6), t(3)
    p = f"(({' + '.join(three)}) / 3.0)"
    active = f"({p} * CAST(({' + '.join(six)}) > 0 AS DOUBLE))"
    return feature_sql(REFERENCE, f"SELECT account_id, round({active}, 6) AS inactive, round(CASE WHEN least({', '.join(nine)}) = greatest({', '.join(nine)}) "
                       f"THEN {nine[-1]} ELSE {active} END, 6) AS invariant, round(avg_8_years, 6) AS avg_8_years, round(var_8_years, 6) AS var_8_years FROM features")


@query("reference_adjustments", covers=("X6", "X3", "A13", "A14"), sql=_reference_invariant_sql)
def reference_adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity over six and invariance over nine of 18 seasons, and the window of eight."""
    h = build_history(read_bundle(spark, sf_dir, REFERENCE))
    p = F.col("avg_3_years")
    return rounded(h.select("account_id", X.inactive_zero(p, REFERENCE).alias("inactive"), X.invariant_last(p, REFERENCE).alias("invariant"),
                            "avg_8_years", "var_8_years"))


def _code_page_sql() -> str:
    city = "CASE WHEN billing_city = '' THEN '' ELSE lower(regexp_replace(billing_city, '^\\s+|\\s+$', '', 'g')) || ' ñé–€' END"
    return f"WITH {ctes(SPEC)['accounts']}\nSELECT account_id, {city} AS billing_city FROM accounts"


@query("code_page_cities", covers=("C1", "S2", "S4"), sql=_code_page_sql)
def code_page_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities with letters beyond ASCII from extracts in Windows-1252, decoded and normalised."""
    b = read_bundle(spark, sf_dir)
    # the bytes of the code page, written by the character set that keeps each byte as it is
    odd = F.when(F.col("billing_city") == "", "").otherwise(F.concat(F.col("billing_city"), F.lit(" ñé–€".encode("cp1252").decode("latin-1"))))
    b = replace(b, accounts=b.accounts.withColumn("billing_city", odd))
    paths = write_csv_bundle(b, scratch_path(spark, f"bundles/{uuid.uuid4().hex}"), encoding="ISO-8859-1")
    back = read_csv_bundle(spark, paths, SPEC, key_type="bigint", encoding="windows-1252").accounts
    spaces = F.regexp_replace(T.normalize("billing_city"), r"\s+", " ")
    return back.select("account_id", spaces.alias("billing_city"))


@query("text_key_features", covers=("P10", "J1"),
       sql=lambda: feature_table_sql().rsplit("SELECT account_id", 1)[0]
       + "SELECT 'A' || lpad(CAST(account_id AS VARCHAR), 12, '0') AS account_id"
       + feature_table_sql().rsplit("SELECT account_id", 1)[1])
def text_key_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide feature table of accounts whose keys are text."""
    b = read_bundle(spark, sf_dir)
    key = F.concat(F.lit("A"), F.lpad(F.col("account_id").cast("string"), 12, "0"))
    return rounded(build_features(replace(b, **{n: getattr(b, n).withColumn("account_id", key) for n in KEYED})))
