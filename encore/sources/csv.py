"""CSV scans with explicit schemas (no inference pass)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def text_schema(cols: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in cols])


def read_text_csv(spark: SparkSession, path: str, cols: Sequence[str], line_sep: str | None = None,
                  encoding: str | None = None) -> DataFrame:
    """All-text scan (``colClasses='character'``): blanks stay '' and only 'NA' is null."""
    r = (spark.read.schema(text_schema(cols)).option("header", True)
         .option("nullValue", "NA").option("emptyValue", ""))
    if line_sep:
        r = r.option("lineSep", line_sep)
    if encoding:
        r = r.option("encoding", encoding)
    return r.csv(path)


def read_typed_csv(spark: SparkSession, path: str, schema: StructType | str, line_sep: str | None = None) -> DataFrame:
    """Typed scan with a declared schema (the typed counterpart of an inferring ``read.csv``)."""
    r = spark.read.schema(schema).option("header", True).option("nullValue", "NA")
    if line_sep:
        r = r.option("lineSep", line_sep)
    return r.csv(path)
