"""Files for people and other systems."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from abono import fixed
from abono.operators.shared import materialize


def report_name(run_date) -> str:
    """run_date is a date, a datetime or ISO text."""
    if isinstance(run_date, str):
        run_date = dt.datetime.fromisoformat(run_date)
    day = run_date.date() if isinstance(run_date, dt.datetime) else run_date
    return f"{fixed.REPORT_STEM}_{day:%Y%m%d}.csv"


def write_report(df: DataFrame, out_dir: str, run_date, one_file: bool = False) -> bool:
    """Dated CSV folder, a header in each part. An empty result writes nothing and returns
    False. With one_file a single task writes all rows, so the caller must know that the
    report is small."""
    rows = materialize(df, "report")
    if rows.isEmpty():
        return False
    if one_file:
        rows = rows.coalesce(1)
    rows.write.mode("overwrite").csv(
        f"{out_dir}/{report_name(run_date)}", header=True)
    return True


def write_crm_outbox(payloads: DataFrame, path: str) -> None:
    """One JSON line (company_id, payload) per pending update, for a sender to work off."""
    payloads.write.mode("overwrite").json(path)
