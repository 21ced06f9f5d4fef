"""Registered queries: CSV sinks and scans (typed, all-text, CR line ends), class-label submissions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..operators import aggregate as A
from ..session import scratch_path
from ..sources.bind import read_bundle
from ..sources.csv import read_text_csv, read_typed_csv
from ..sources.sinks import write_csv, write_submission
from ..spec import binding_spec
from .feature_sql import FEATURE_INPUTS, feature_ctes, with_ctes
from .registry import query
from .q_scoring import PRED, predictions

SPEC = binding_spec()


@query("labels_csv_roundtrip", covers=("S1", "S3", "S5", "S6", "A10"),
       sql=lambda: with_ctes(SPEC, ["train_labels"], [], "SELECT total, count(*) AS n FROM train_labels GROUP BY total"))
def labels_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels exported as CR-terminated CSV (key as an ordinary column), scanned back with a typed
    schema, and tabulated."""
    path = scratch_path(spark, f"exports/{uuid.uuid4().hex}/train")
    labels = read_bundle(spark, sf_dir).labels
    labels.write.mode("overwrite").option("header", True).option("lineSep", "\r").csv(path)
    back = read_typed_csv(spark, path, "account_id long, total double", line_sep="\r")
    return A.frequency(back, "total")


@query("class_label_submission", covers=("S8", "S2", "S9", "E3"),
       sql=lambda: with_ctes(SPEC, FEATURE_INPUTS + ["train_labels", "to_score"], feature_ctes(SPEC),
                             f"SELECT round_even(f.{PRED}, 0) AS total, count(*) AS n FROM to_score s "
                             "LEFT JOIN features f ON s.account_id = f.account_id GROUP BY 1"))
def class_label_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class predictions (rounded three-season mean) written without snapping, read back, tabulated."""
    preds = predictions(spark, sf_dir)
    cls = preds.select("account_id", N.round_half_even("prediction").alias("prediction"))
    path = write_submission(cls, scratch_path(spark, f"submissions/{uuid.uuid4().hex}"), "class_sub_", snap=False)
    back = read_text_csv(spark, path, ["account_id", "total"]).select(N.to_number("total").alias("total"))
    return A.frequency(back, "total")
