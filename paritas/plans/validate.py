"""Top-level reconciliations: the result object and the four entry points.

``Reconciliation`` holds lazy DataFrames only.  Nothing runs until a caller
acts on a frame (a sink write, a summary collect).  The one exception is the
gate: a missing required column is decided from schemas, before any scan.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import counts, cross, diff, fanout, figures, match, profile, structure
from ..sources import as_dataframe
from ..spec import ReconSpec, Resolved
from . import diagnostics


def _count(df: DataFrame, metric: str) -> DataFrame:
    return df.groupBy().agg(F.count(F.lit(1)).alias("value")).select(
        F.lit(metric).alias("metric"), "value")


def metrics_row(parts: list[DataFrame], names: list[str], wide: tuple[str, ...] = ()) -> DataFrame:
    """Fold ``(metric, value)`` frames into one row with a column per metric,
    using a union and one global aggregate (no cross join).  Metrics in
    ``wide`` may exceed 64 bits and come out as ``decimal(38,0)``."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    m = F.col("metric")
    return u.groupBy().agg(*[F.coalesce(F.sum(F.when(m == n, F.col("value"))), F.lit(0))
                             .cast("decimal(38,0)" if n in wide else "long").alias(n)
                             for n in names])


@dataclass
class Reconciliation:
    """Duplicate-aware comparison of two tables (families B-D of the reference)."""

    spark: SparkSession
    left: DataFrame
    right: DataFrame
    spec: ReconSpec
    left_table: str = "left"
    right_table: str = "right"
    rs: Resolved = field(init=False)

    def __post_init__(self):
        self.rs = self.spec.resolve(self.left, self.right)

    @property
    def ln(self) -> str:
        return self.spec.left_name

    @property
    def rn(self) -> str:
        return self.spec.right_name

    @property
    def gate_failed(self) -> bool:
        return self.rs.critical

    def issues(self) -> DataFrame:
        return profile.required_issues(self.spark, self.rs, self.left_table, self.right_table)

    @cached_property
    def key_counts(self) -> DataFrame:
        return counts.key_counts(self.left, self.right, self.rs)

    @cached_property
    def count_differences(self) -> DataFrame:
        return counts.count_differences(self.left, self.right, self.rs, self.key_counts)

    def one_sided(self, side: str, distinct: bool = True) -> DataFrame:
        return match.one_sided(self.left, self.right, self.rs, side, distinct=distinct)

    def keys_frame(self, keys) -> DataFrame:
        """Keys to inspect: a DataFrame with the key columns, one key value, or a
        list of values (tuples for a composite key).  Values become a typed
        DataFrame, never SQL text."""
        if isinstance(keys, DataFrame):
            return keys.select(*self.rs.keys)
        values = keys if isinstance(keys, list) else [keys]
        rows = [v if isinstance(v, tuple) else (v,) for v in values]
        fields = [self.left.schema[k] for k in self.rs.keys]
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
        return self.spark.createDataFrame(rows, schema)

    def spot_check(self, keys) -> DataFrame:
        """All occurrences of ``keys`` compared position by position (R3)."""
        return diagnostics.spot_check(self.left, self.right, self.rs, self.keys_frame(keys))

    def spot_check_outcomes(self, keys) -> DataFrame:
        """One row for each asked key: both counts and what became of it."""
        return diagnostics.spot_check_outcomes(self.left, self.right, self.rs,
                                               self.keys_frame(keys))

    def duplicate_details(self, keys) -> DataFrame:
        """All occurrences of ``keys`` on both sides with counts (R4)."""
        return diagnostics.duplicate_details(self.left, self.right, self.rs,
                                             self.keys_frame(keys))

    def register_views(self, prefix: str = "paritas") -> dict[str, str]:
        """Register the inputs and the main (lazy) results as temp views with
        names unique to this call, for SQL over them; returns role -> view name."""
        run = uuid.uuid4().hex[:8]
        frames = {"left": self.left, "right": self.right,
                  "mismatches": self.mismatches, "count_differences": self.count_differences,
                  "left_only": self.one_sided("left"), "right_only": self.one_sided("right")}
        names = {}
        for role, df in frames.items():
            names[role] = f"{prefix}_{role}_{run}"
            df.createOrReplaceTempView(names[role])
        return names

    def sample_mismatches(self, n: int = 10) -> DataFrame:
        """Cells of the first ``n`` differing pairs by key and ordinal; under cross
        pairing the first ``n`` rows of its cell report (R1)."""
        return diagnostics.sample_mismatches(self.left, self.right, self.rs, n)

    @cached_property
    def mismatches(self) -> DataFrame:
        """Cell report under the spec's pairing: ordinal -> one row per cell;
        cross -> one row per (left row, column) with partner counts."""
        if self.spec.pairing == "cross":
            return cross.mismatch_cells_cross(self.left, self.right, self.rs)
        return diff.mismatch_cells(self.left, self.right, self.rs)

    def results(self, count_differences: bool = True) -> fanout.Results | None:
        """All results from one reading of each side (``fanout``); ``None`` where some
        columns' types have no common exact one."""
        if self.spec.pairing == "cross":
            return fanout.cross_results(self.left, self.right, self.rs,
                                        count_differences=count_differences)
        return fanout.ordinal_results(self.left, self.right, self.rs)

    def mismatch_total(self) -> DataFrame:
        """Number of mismatched cells; under cross pairing the sum over compare
        columns of differing pairs, from frequency tables alone."""
        if self.spec.pairing == "cross":
            cc = cross.cross_column_counts(self.left, self.right, self.rs)
            return cc.groupBy().agg(F.sum("mismatch_count").alias("value")).select(
                F.lit("mismatched_data_points").alias("metric"), "value")
        return _count(self.mismatches, "mismatched_data_points")

    def summary(self, with_count_differences: bool = True) -> DataFrame:
        """A10: one row of run figures (timestamps left to the caller), from one
        reading of each side (``figures``) wherever that plan applies."""
        ln, rn_ = self.ln, self.rn
        one = self._one_pass_figures()
        if one is not None:
            wide = self.spec.pairing == "cross"
            renamed = one.select(
                F.col("left_rows").alias(f"total_{ln}_rows"),
                F.col("right_rows").alias(f"total_{rn_}_rows"),
                F.col("only_left").alias(f"rows_only_in_{ln}"),
                F.col("only_right").alias(f"rows_only_in_{rn_}"),
                F.col("cells").cast("decimal(38,0)" if wide else "long")
                .alias("mismatched_data_points"),
                *[F.col("count_differences").alias(self._differences_label())]
                * with_count_differences)
            return self._described(renamed)
        kc = self.key_counts
        totals = kc.groupBy().agg(F.sum(f"{ln}_count").alias("l"), F.sum(f"{rn_}_count").alias("r"))
        parts = [
            totals.select(F.inline(F.array(
                F.struct(F.lit(f"total_{ln}_rows").alias("metric"), F.col("l").alias("value")),
                F.struct(F.lit(f"total_{rn_}_rows").alias("metric"), F.col("r").alias("value"))))),
            _count(self.one_sided("left"), f"rows_only_in_{ln}"),
            _count(self.one_sided("right"), f"rows_only_in_{rn_}"),
            self.mismatch_total(),
        ]
        names = [f"total_{ln}_rows", f"total_{rn_}_rows", f"rows_only_in_{ln}",
                 f"rows_only_in_{rn_}", "mismatched_data_points"]
        if with_count_differences:
            label = self._differences_label()
            parts.append(_count(self.count_differences, label))
            names.append(label)
        wide = ("mismatched_data_points",) if self.spec.pairing == "cross" else ()
        row = metrics_row(parts, names, wide)
        return self._described(row)

    def _differences_label(self) -> str:
        key = self.rs.keys[0] if len(self.rs.keys) == 1 else "key"
        return f"{key}s_with_count_differences"

    def _one_pass_figures(self) -> DataFrame | None:
        mode = self.spec.null_mode
        if self.spec.pairing == "ordinal":
            return figures.ordinal_figures(self.left, self.right, self.rs, mode)
        # the sentinel rule matches NULL keys with the text 'NULL', one-sided rows do not
        return figures.cross_figures(self.left, self.right, self.rs) if mode == "safe" else None

    def _described(self, row: DataFrame) -> DataFrame:
        return row.select(
            F.lit(self.left_table).alias(f"{self.ln}_table"),
            F.lit(self.right_table).alias(f"{self.rn}_table"), *row.columns,
            F.lit(", ".join(self.rs.compare)).alias("comparison_columns"),
            F.lit(len(self.rs.common)).cast("long").alias("common_columns_count"))

    def _status_columns(self, s: DataFrame, with_count_differences: bool):
        issue_cols = [f"rows_only_in_{self.ln}", f"rows_only_in_{self.rn}",
                      "mismatched_data_points"]
        if with_count_differences:
            issue_cols.append([c for c in s.columns if c.endswith("_with_count_differences")][0])
        total = sum((F.col(c) for c in issue_cols[1:]), F.col(issue_cols[0]))
        n_issues = sum(len(self.rs.missing[s_][k]) > 0 for s_ in ("left", "right")
                       for k in ("required", "output"))
        status = F.when((total == 0) & F.lit(n_issues == 0), F.lit("PASSED")) \
            .otherwise(F.lit("FAILED"))
        wide = self.spec.pairing == "cross"
        return (status.alias("status"),
                total.cast("decimal(38,0)" if wide else "long").alias("total_issues"))

    def summary_with_status(self, with_count_differences: bool = True) -> DataFrame:
        s = self.summary(with_count_differences)
        return s.select(*s.columns, *self._status_columns(s, with_count_differences))

    def status(self, with_count_differences: bool = True) -> DataFrame:
        """A11: ``status, total_issues``; PASSED only when every figure is 0 and no
        required-column issue exists."""
        return self.summary_with_status(with_count_differences).select("status", "total_issues")


def reconcile(spark: SparkSession, left, right, spec: ReconSpec,
              left_table: str | None = None, right_table: str | None = None) -> Reconciliation:
    """Build a reconciliation from DataFrames, table names or parquet paths."""
    lt = left_table or (left if isinstance(left, str) else spec.left_name)
    rt = right_table or (right if isinstance(right, str) else spec.right_name)
    return Reconciliation(spark, as_dataframe(spark, left), as_dataframe(spark, right), spec, lt, rt)


@dataclass
class GenericComparison:
    """Family A: arbitrary tables, all common columns, unique key, schema diff."""

    spark: SparkSession
    left: DataFrame
    right: DataFrame
    keys: tuple[str, ...] | None = None
    table1: str = "table1"
    table2: str = "table2"
    rs: Resolved = field(init=False)
    frame: DataFrame | None = field(init=False, default=None)

    def __post_init__(self):
        spec = ReconSpec(keys=tuple(self.keys or ()), left_name="t1", right_name="t2",
                         case_sensitive=True)
        self.rs = spec.resolve(self.left, self.right)

    @property
    def pairs_frame(self) -> DataFrame:
        """Changed and one-sided rows of the key pairing, shared by the reports;
        replace ``frame`` with a materialised copy when several reports are written."""
        if self.frame is None:
            self.frame = diff.generic_frame(self.left, self.right, self.rs)
        return self.frame

    def structure_diff(self) -> DataFrame:
        return structure.structure_diff(self.spark, self.left, self.right)

    def changed(self) -> DataFrame:
        return match.matched_changed(self.left, self.right, self.rs)

    def full_diff(self) -> DataFrame:
        return match.full_outer_classified(self.left, self.right, self.rs,
                                           frame=self.pairs_frame).select(*self.rs.keys, "status")

    def mismatch_long(self) -> DataFrame:
        return diff.mismatch_long(self.left, self.right, self.rs, self.table1, self.table2,
                                  frame=self.pairs_frame)

    def mismatch_nested(self) -> DataFrame:
        return diff.mismatch_nested(self.left, self.right, self.rs, self.table1, self.table2,
                                    frame=self.pairs_frame)

    def fingerprint_diff(self) -> DataFrame:
        return diff.fingerprint_diff(self.left, self.right, self.rs)

    def keyless_diff(self) -> DataFrame:
        cols = self.rs.common
        return match.keyless_diff(self.left, self.right, cols, self.table1, self.table2,
                                  [self.rs.rcol(c) for c in cols])

    def mismatched_rows(self) -> DataFrame:
        """Changed or one-sided rows (the reference's mismatched rows)."""
        return self.full_diff()

    def validation_log(self, when: dt.datetime | None = None) -> DataFrame:
        """K9: structure rows (FAILED) and one data-row statistic, with the time of
        the run (``when``, default now)."""
        stamp = F.lit(f"{when or dt.datetime.now():%Y-%m-%d %H:%M:%S}").alias("timestamp")
        sd = self.structure_diff()
        details = F.concat_ws(", ",
                              F.concat(F.lit("column="), F.coalesce(F.col("column_name"), F.lit(""))),
                              F.concat(F.lit("table1_value="),
                                       F.coalesce(F.col("table1_value"), F.lit(""))),
                              F.concat(F.lit("table2_value="),
                                       F.coalesce(F.col("table2_value"), F.lit(""))))
        rows = sd.select(F.col("type").alias("validation_type"), F.lit("FAILED").alias("status"),
                         F.lit(self.table1).alias("table1"), F.lit(self.table2).alias("table2"),
                         details.alias("details"))
        n = _count(self.mismatched_rows(), "n")
        stat = n.select(
            F.lit("data_rows").alias("validation_type"),
            F.when(F.col("value") == 0, F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("status"),
            F.lit(self.table1).alias("table1"), F.lit(self.table2).alias("table2"),
            F.concat(F.lit("total_mismatched_rows="), F.col("value").cast("string"),
                     F.lit(", key_columns=" + ", ".join(self.rs.keys))).alias("details"))
        return rows.unionByName(stat).select(stamp, "*")

    def status(self) -> DataFrame:
        """E1: PASSED when there is no structure difference and no mismatched row."""
        row = metrics_row([_count(self.structure_diff(), "structure_differences"),
                           _count(self.mismatched_rows(), "mismatched_rows")],
                          ["structure_differences", "mismatched_rows"])
        total = F.col("structure_differences") + F.col("mismatched_rows")
        return row.select(F.when(total == 0, F.lit("PASSED")).otherwise(F.lit("FAILED"))
                          .alias("status"), total.cast("long").alias("total_issues"))
