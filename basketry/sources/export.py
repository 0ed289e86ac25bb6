"""Export of the feature matrix."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame


def export_name(as_of: date) -> str:
    return f"analytic_result_{as_of:%Y_%m_%d}.csv"


def export_csv(df: DataFrame, base: str, as_of: date, prefix: str = "analytics") -> str:
    """Write the matrix as CSV with a header and return its path, a dated folder of part files.

    The parts are written in parallel; making one file of them would send the whole matrix through one task.
    """
    path = "/".join(part.strip("/") if i else part.rstrip("/") for i, part in enumerate((base, prefix)) if part)
    path = f"{path}/{export_name(as_of)}"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path
