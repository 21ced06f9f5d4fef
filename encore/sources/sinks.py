"""Sinks: submission files, CSV exports and the trial table.

Writes are distributed (one part file per task) and atomic per directory; a
lost executor only re-runs its own task. Nothing is funnelled through one task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N


def stamp(today: _dt.date | None = None) -> str:
    """'Nov_16_2014' style date stamp used in output names."""
    d = today or _dt.date.today()
    return d.strftime("%b_%d_%Y")


def write_submission(preds: DataFrame, base: str, prefix: str, snap: bool = True, mode: str = "overwrite",
                     pred_col: str = "prediction", today: _dt.date | None = None) -> str:
    """``dumpResponse``: two columns (account_id, total), snapped unless ``snap=False``."""
    path = f"{base.rstrip('/')}/{prefix}{stamp(today)}"
    val = N.snap(pred_col) if snap else F.col(pred_col)
    preds.select("account_id", val.alias("total")).write.mode(mode).option("header", True).csv(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Plain CSV export with a header (row names, if any, are an ordinary key column)."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def append_trial(trials: DataFrame, path: str) -> None:
    """Accepted search trials are appended to one Parquet table (score, metric, date are columns)."""
    trials.write.mode("append").parquet(path)
