"""Scans and sinks: CR line ends, Windows-1252 text, submission round trip."""

import os
import tempfile

from pyspark.sql import functions as F

from encore.sources.csv import read_text_csv
from encore.sources.sinks import write_submission


def test_cr_line_ends_and_blank_vs_na(spark):
    d = tempfile.mkdtemp(prefix="encore-test-")
    p = os.path.join(d, "zip.csv")
    with open(p, "wb") as f:
        f.write(b'"zip","count"\r"K9A 0A9","3"\r"","5"\rNA,"7"\r')
    df = read_text_csv(spark, p, ["zip", "count"], line_sep="\r")
    rows = sorted((r["zip"] is None, r["zip"] or "", r["count"]) for r in df.collect())
    assert rows == [(False, "", "5"), (False, "K9A 0A9", "3"), (True, "", "7")]


def test_windows_1252_decoding(spark):
    d = tempfile.mkdtemp(prefix="encore-test-")
    p = os.path.join(d, "acc.csv")
    with open(p, "wb") as f:
        f.write('"city"\n"Café Town"\n'.encode("cp1252"))
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    df = read_text_csv(spark, p, ["city"], encoding="windows-1252")
    assert df.first()[0] == "Café Town"


def test_submission_round_trip(spark):
    d = tempfile.mkdtemp(prefix="encore-test-")
    preds = spark.createDataFrame([(1, 0.02), (2, 1.49), (3, 2.2)], "account_id long, prediction double")
    path = write_submission(preds, d, "sub_")
    back = read_text_csv(spark, path, ["account_id", "total"])
    got = sorted((int(r[0]), float(r[1])) for r in back.collect())
    assert got == [(1, 0.0), (2, 1.5), (3, 2.2)]


def test_code_page_of_csv_extracts(spark, tmp_path):
    """Every byte of Windows-1252 that stands for a character."""
    from encore.sources.files import _scan

    text = bytes(b for b in range(0x80, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)).decode("cp1252")
    (tmp_path / "t.csv").write_bytes(f'account.id,billing.city\nA1,"San José – “{text}”"\nA2,NA\nA3,\n'.encode("cp1252"))
    rows = {r.account_id: r.billing_city for r in _scan(spark, str(tmp_path / "t.csv"), "windows-1252").collect()}
    assert rows == {"A1": f"San José – “{text}”", "A2": None, "A3": ""}
