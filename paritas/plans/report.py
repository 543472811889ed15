"""Run reports: one status line and a ``section, metric, value`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .validate import Reconciliation


def status_line(recon: Reconciliation) -> DataFrame:
    """One string: ``<STATUS>: <n> issues (<metric>=<value>, ...)``."""
    s = recon.summary_with_status()
    figures = [c for c in s.columns
               if c.startswith("rows_only_in_") or c == "mismatched_data_points"
               or c.endswith("_with_count_differences")]
    parts = F.concat_ws(", ", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string"))
                                for c in figures])
    return s.select(F.concat(F.col("status"), F.lit(": "), F.col("total_issues").cast("string"),
                             F.lit(" issues ("), parts, F.lit(")")).alias("status_line"))


def validation_report(recon: Reconciliation) -> DataFrame:
    """The printed report of the reference, as rows ``section, metric,
    value``, with one row for each issue of required or output columns."""
    s = recon.summary_with_status()
    sections = []
    for c in s.columns:
        if c.endswith("_table"):
            sec = "tables"
        elif c.startswith("total_") and c.endswith("_rows"):
            sec = "row_counts"
        elif c in ("status", "total_issues"):
            sec = "status"
        elif c in ("comparison_columns", "common_columns_count"):
            sec = "details"
        else:
            sec = "results"
        sections.append(F.struct(F.lit(sec).alias("section"), F.lit(c).alias("metric"),
                                 F.col(c).cast("string").alias("value")))
    rows = s.select(F.inline(F.array(*sections)))
    issues = recon.issues().select(
        F.lit("issues").alias("section"),
        F.concat(F.col("severity"), F.lit(" "), F.col("type")).alias("metric"),
        F.concat(F.col("table_name"), F.lit(": "), F.array_join("missing_columns", ", "))
        .alias("value"))
    return rows.unionByName(issues)
