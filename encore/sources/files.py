"""The eight extracts as CSV files: scans of text with a header, no inference pass over the values."""

from __future__ import annotations

from dataclasses import fields
from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as T
from ..spec import HistorySpec
from .bind import Bundle

#: Names of the tables of a bundle, in the order of :class:`Bundle`.
TABLES = tuple(f.name for f in fields(Bundle) if f.name != "spec")
#: Columns that are numbers; all others stay text for the jobs to repair.
NUMBERS = {"directory": ("Lat", "Long"), "labels": ("total",)}
KEYED = ("accounts", "subscriptions", "tickets", "attended", "labels", "to_score")
_NEVER = "\u0001"


def _scan(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """All columns as text; 'NA' is null and a blank stays blank, quoted or not. Dots in names become underscores.

    Spark scans few character sets unless its session says otherwise; ``windows-1252`` is scanned as ISO-8859-1, and
    the characters in which the two differ are replaced as expressions."""
    page = encoding.lower() in ("windows-1252", "cp1252")
    df = (spark.read.option("header", True).option("nullValue", _NEVER).option("emptyValue", "")
          .option("encoding", "ISO-8859-1" if page else encoding).csv(path))
    if page:
        df = df.select(*[T.from_code_page(F.col(f"`{c}`")).alias(c) for c in df.columns])

    def value(c: str) -> Column:
        x = F.col(f"`{c}`")
        return F.when(x == "NA", F.lit(None)).otherwise(F.coalesce(x, F.lit(""))).alias(c.replace(".", "_"))

    return df.select(*[value(c) for c in df.columns])


def read_csv_bundle(spark: SparkSession, paths: Mapping[str, str], spec: HistorySpec, log_label: bool = False,
                    key_type: str = "string", encoding: str = "UTF-8") -> Bundle:
    """``readData``: the input bundle from CSV files, one path (file or folder) for each of ``TABLES``.

    With ``log_label`` the label becomes log(1 + total); ``functions.numeric.unlog_label`` takes
    predictions back. Keys are text unless ``key_type`` says otherwise; ``encoding`` is the files' character set.
    """
    missing = [n for n in TABLES if n not in paths]
    if missing:
        raise ValueError(f"no path for {', '.join(missing)}")
    out = {}
    for name in TABLES:
        df = _scan(spark, paths[name], encoding)
        for c in NUMBERS.get(name, ()):
            df = df.withColumn(c, F.col(c).try_cast("double"))
        if name in KEYED:
            df = df.withColumn("account_id", F.col("account_id").cast(key_type))
        out[name] = df
    if log_label:
        out["labels"] = out["labels"].withColumn("total", N.log_label("total"))
    return Bundle(**out, spec=spec)


def write_csv_bundle(bundle: Bundle, folder: str, encoding: str = "UTF-8") -> dict[str, str]:
    """Every table of ``bundle`` as CSV below ``folder``; the paths that :func:`read_csv_bundle` takes."""
    paths = {n: f"{folder.rstrip('/')}/{n}" for n in TABLES}
    for name, path in paths.items():
        (getattr(bundle, name).write.option("header", True).option("nullValue", "NA").option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).option("encoding", encoding).csv(path))
    return paths
