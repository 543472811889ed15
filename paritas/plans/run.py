"""End-to-end runs: compute all results in one job, write, check and publish them.

A run reads each side once: one job computes all results (``operators.fanout``)
and stages them, tagged and partitioned by result, in ``spark.checkpoint.dir``;
the figures for the summary and the status are gathered *during* that write
with ``DataFrame.observe`` (no second pass, no collect of rows).  Each result is
then written to its sink from the staged rows, its row count checked against
the staged one, and a manifest naming every result is written last.  A run
without a manifest is unfinished: ``published`` does not list it.

Empty results can be left out: their counts are known before they are written.

Entry points (the reference's four families):

* ``run_validation(spark, left, right, spec, ...)``  duplicate-aware member /
  business-key validation (ordinal or cross pairing, by ``spec.pairing``);
* ``run_generic(spark, left, right, keys, ...)``     arbitrary tables, schema diff;
* ``run_job(spark, ...) -> DataFrame[status_line]``  the stored-procedure
  replacement, also used by the ``python -m paritas.plans.run`` CLI.
"""

from __future__ import annotations

import argparse
import datetime as dt
import uuid
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..operators import counts, cross, diff, fanout, match, profile
from ..session import output_dir, require_checkpoint_dir
from ..sources import as_dataframe
from ..spec import ReconSpec
from .validate import GenericComparison, Reconciliation


@dataclass
class RunResult:
    status: str
    run_id: str
    figures: dict[str, int]
    written: dict[str, str] = field(default_factory=dict)
    issues: list[tuple] = field(default_factory=list)

    @property
    def total_issues(self) -> int:
        return sum(v for k, v in self.figures.items() if k in _ISSUE_FIGURES)

    def status_line(self) -> str:
        parts = ", ".join(f"{k}={v}" for k, v in self.figures.items() if k in _ISSUE_FIGURES)
        return f"{self.status}: {self.total_issues} issues ({parts})"


_ISSUE_FIGURES = {"rows_only_in_left", "rows_only_in_right", "mismatched_data_points",
                  "keys_with_count_differences", "structure_differences", "mismatched_rows"}


def _materialise(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A frame read by several writes: a reliable checkpoint in the shared
    ``spark.checkpoint.dir`` (cuts the lineage, so a lost executor does not
    recompute the pairing)."""
    require_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def _run_id() -> str:
    """The time of the run, with a suffix that keeps runs of one second apart."""
    return f"{dt.datetime.now():%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


MANIFEST = "manifest"
_MANIFEST_SCHEMA = ("run_id string, status string, result string, sink string, location string, "
                    "rows long")


class _Writer:
    """Writes named results as CSV folders under one run folder, or as tables.

    Each observed frame runs exactly once and completely; observations are read
    only after their write finished.  With ``skip_empty`` an empty result is left
    out, but for the summary: it is not written where its count is known, else
    its folder or table is dropped after the write that counted it.
    """

    def __init__(self, spark: SparkSession, out: str | None, table_prefix: str | None,
                 run_id: str, skip_empty: bool = False):
        self.spark, self.run_id, self.skip_empty = spark, run_id, skip_empty
        self.out, self.prefix = out.rstrip("/") if out else None, table_prefix
        self.written: dict[str, str] = {}
        self.rows: dict[str, int] = {}

    def write(self, name: str, df: DataFrame, metrics: dict | None = None,
              single_file: bool = False, always: bool = False, rows: int | None = None) -> dict:
        """Write ``df`` (of ``rows`` rows, where known); returns the observed ``metrics``."""
        metrics = metrics or {}
        skip = self.skip_empty and not always
        if skip and rows == 0:
            return {"rows": 0} | dict.fromkeys(metrics, 0)
        obs = Observation(name)
        counted = {"rows": F.count(F.lit(1))} | metrics
        observed = df.observe(obs, *[e.alias(k) for k, e in counted.items()])
        if self.out:
            label, place = f"csv:{name}", f"{self.out}/{name}_{self.run_id}"
            sinks.write_csv(observed, place, single_file=single_file)
        elif self.prefix:
            label, place = f"table:{name}", f"{self.prefix}_{name}_{self.run_id}"
            sinks.clean_names(observed).write.mode("overwrite").saveAsTable(place)
        else:
            label = place = None
            observed.write.format("noop").mode("overwrite").save()
        got = {k: int(obs.get.get(k) or 0) for k in counted}
        if rows is not None and got["rows"] != rows:
            raise RuntimeError(f"{name}: {rows} rows staged, {got['rows']} written")
        if label and skip and got["rows"] == 0:
            self._drop(place)
        elif label:
            self.written[label], self.rows[label] = place, got["rows"]
        return got

    def _drop(self, place: str) -> None:
        if self.prefix and not self.out:
            self.spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": place})
            return
        path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def publish(self, status: str) -> None:
        """Writes the manifest: from now on the run counts."""
        if not self.written:
            return
        rows = [(self.run_id, status, label.split(":", 1)[1], label.split(":", 1)[0], place,
                 self.rows[label]) for label, place in self.written.items()]
        manifest = self.spark.createDataFrame(rows, _MANIFEST_SCHEMA).coalesce(1)
        if self.out:
            manifest.write.json(f"{self.out}/{MANIFEST}_{self.run_id}")
        else:
            manifest.write.saveAsTable(f"{self.prefix}_{MANIFEST}_{self.run_id}")


def published(spark: SparkSession, output: str | None = None,
              table_prefix: str | None = None) -> DataFrame:
    """The results of all finished runs under an output folder or table prefix:
    ``run_id, status, result, sink, location, rows``."""
    nothing = spark.createDataFrame([], _MANIFEST_SCHEMA)
    if output:
        try:
            return spark.read.schema(_MANIFEST_SCHEMA).json(f"{output.rstrip('/')}/{MANIFEST}_*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return nothing
    database, _, name = (table_prefix or "").rpartition(".")
    tables = spark.catalog.listTables(database or None, f"{name}_{MANIFEST}_*")
    for t in tables:
        nothing = nothing.unionByName(spark.table(f"{database}.{t.name}" if database else t.name))
    return nothing


def read_result(spark: SparkSession, sink: str, location: str, schema) -> DataFrame:
    """A published result in its types."""
    return sinks.read_csv(spark, location, schema) if sink == "csv" else spark.table(location)


@dataclass
class _Staged:
    figures: dict[str, int]
    counts: dict[str, int]
    results: fanout.Results
    rows: DataFrame | None

    def of(self, kind: str) -> DataFrame:
        return self.results.of(self.rows, kind)


def _stage(spark: SparkSession, results: fanout.Results, run_id: str, keep: bool) -> _Staged:
    """The one job of a run: all results, staged by kind and counted."""
    totals, counts_ = Observation("totals"), Observation("results")
    kind = F.col(fanout.KIND)
    rows = results.rows.observe(totals, F.sum(fanout.LEFT_ROWS).alias("l"),
                                F.sum(fanout.RIGHT_ROWS).alias("r"))
    metrics = {k: F.count(F.when(kind == k, 1)) for k in results.kinds}
    if "differing_partners" in results.kinds["mismatches"].names:
        cell = F.col("mismatches")
        metrics["cells"] = F.sum(F.when(kind == "mismatches", cell["left_rows"].cast(cross.COUNT)
                                        * cell["differing_partners"].cast(cross.COUNT)))
    frame = results.finish(rows).observe(counts_, *[e.alias(k) for k, e in metrics.items()])
    back = None
    if keep:
        path = f"{require_checkpoint_dir(spark)}/run-{run_id}"
        frame.write.partitionBy(fanout.KIND).parquet(path)
        back = spark.read.schema(frame.schema).parquet(path)
    else:
        frame.write.format("noop").mode("overwrite").save()
    sides = [{"l": totals.get["l"], "r": totals.get["r"]}, *[
        {"l": r[fanout.LEFT_ROWS], "r": r[fanout.RIGHT_ROWS]}
        for r in (part.first() for part in results.more)]]  # one row of sums each
    figures = {f"total_{side}_rows": sum(int(s[k] or 0) for s in sides)
               for side, k in (("left", "l"), ("right", "r"))}
    return _Staged(figures, {k: int(counts_.get.get(k) or 0) for k in metrics}, results, back)


def run_validation(spark: SparkSession, left, right, spec: ReconSpec, *,
                   output: str | None = None, table_prefix: str | None = None,
                   left_table: str | None = None, right_table: str | None = None,
                   count_differences: bool | None = None,
                   skip_empty: bool = False) -> RunResult:
    """Families B-D.  ``count_differences`` defaults to True for ordinal pairing."""
    run_id = _run_id()
    ldf, rdf = as_dataframe(spark, left), as_dataframe(spark, right)
    lt = left_table or (left if isinstance(left, str) else spec.left_name)
    rt = right_table or (right if isinstance(right, str) else spec.right_name)
    recon = Reconciliation(spark, ldf, rdf, spec, lt, rt)
    issues = [tuple(r) for r in recon.issues().collect()]  # metadata rows only
    if recon.gate_failed:
        return RunResult("FAILED", run_id, {}, issues=issues)
    if count_differences is None:
        count_differences = spec.pairing == "ordinal"
    w = _Writer(spark, output, table_prefix, run_id, skip_empty)
    results = recon.results(count_differences)
    if results is None:
        figures = _separate_results(recon, w, count_differences)
    else:
        figures = _staged_results(spark, results, w, run_id)
    passed = all(figures[k] == 0 for k in figures if k in _ISSUE_FIGURES) and not issues
    result = RunResult("PASSED" if passed else "FAILED", run_id, figures, issues=issues)
    summary = spark.createDataFrame([(
        run_id, lt, rt, *[Decimal(v) if k == "mismatched_data_points" else v
                          for k in _SUMMARY_FIGURES for v in [int(figures.get(k, 0))]],
        ", ".join(recon.rs.compare), len(recon.rs.common), result.status,
        Decimal(result.total_issues), dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S"))],
        _SUMMARY_SCHEMA)
    w.write("summary", summary, single_file=True, always=True)
    w.publish(result.status)
    result.written = w.written
    return result


def _staged_results(spark: SparkSession, results: fanout.Results, w: _Writer,
                    run_id: str) -> dict[str, int]:
    sinks_ = bool(w.out or w.prefix)
    staged = _stage(spark, results, run_id, keep=sinks_)
    if sinks_:
        for kind in results.kinds:
            w.write(kind, staged.of(kind), rows=staged.counts[kind])
    figures = dict(staged.figures)
    if "count_differences" in results.kinds:
        figures["keys_with_count_differences"] = staged.counts["count_differences"]
    figures["rows_only_in_left"] = staged.counts["left_only"]
    figures["rows_only_in_right"] = staged.counts["right_only"]
    figures["mismatched_data_points"] = staged.counts.get("cells", staged.counts["mismatches"])
    return figures


def _separate_results(recon: Reconciliation, w: _Writer, count_differences: bool) -> dict[str, int]:
    """The results as separate plans, for columns whose types have no common exact one."""
    spark, ldf, rdf, rs, spec = recon.spark, recon.left, recon.right, recon.rs, recon.spec
    # row totals are observed on the key-count aggregate while it feeds the
    # count-difference output (written, or run through the noop sink)
    kobs = Observation("key_counts")
    kc = counts.key_counts(ldf, rdf, rs).observe(
        kobs, F.sum(f"{spec.left_name}_count").alias("l"),
        F.sum(f"{spec.right_name}_count").alias("r"))
    cd = counts.count_differences(ldf, rdf, rs, kc)
    figures: dict[str, int] = {}
    if count_differences:
        figures["keys_with_count_differences"] = w.write(
            "count_differences", cd, always=True)["rows"]  # feeds the observed totals
    else:
        cd.write.format("noop").mode("overwrite").save()
    totals = {k: int(v or 0) for k, v in kobs.get.items()}
    figures = {"total_left_rows": totals["l"], "total_right_rows": totals["r"], **figures}
    figures["rows_only_in_left"] = w.write("left_only", recon.one_sided("left"))["rows"]
    figures["rows_only_in_right"] = w.write("right_only", recon.one_sided("right"))["rows"]
    if spec.pairing == "cross":
        m = w.write("mismatches", cross.mismatch_cells_cross(ldf, rdf, rs),
                    {"cells": F.sum(cross.cell_pairs())})
        figures["mismatched_data_points"] = m["cells"]
    else:
        # one pairing feeds both outputs: only unmatched or differing pairs are
        # kept and materialised, then read by the two writes
        pairs = match.ordinal_pairs(ldf, rdf, rs, how="full_outer")
        both = F.col("__l") & F.col("__r")
        report = _materialise(spark, pairs.filter(
            ~both | match.row_differs(pairs, rs, spec.null_mode)))
        cells = diff.cells_of_pairs(report.filter(both), rs, spec.null_mode)
        figures["mismatched_data_points"] = w.write("mismatches", cells)["rows"]
        w.write("unmatched_ordinals", match.unmatched_of_pairs(report, rs))
    return figures


_SUMMARY_FIGURES = ["total_left_rows", "total_right_rows", "rows_only_in_left",
                    "rows_only_in_right", "mismatched_data_points", "keys_with_count_differences"]
_SUMMARY_SCHEMA = ("run_id string, left_table string, right_table string, total_left_rows long, "
                   "total_right_rows long, rows_only_in_left long, rows_only_in_right long, "
                   "mismatched_data_points decimal(38,0), keys_with_count_differences long, "
                   "comparison_columns string, common_columns_count long, status string, "
                   "total_issues decimal(38,0), validation_date string")


def run_generic(spark: SparkSession, left, right, keys=None, *, output: str | None = None,
                table_prefix: str | None = None, table1: str | None = None,
                table2: str | None = None, skip_empty: bool = False) -> RunResult:
    """Family A: structure diff, long mismatch report, validation log."""
    run_id = _run_id()
    ldf, rdf = as_dataframe(spark, left), as_dataframe(spark, right)
    t1 = table1 or (left if isinstance(left, str) else "table1")
    t2 = table2 or (right if isinstance(right, str) else "table2")
    if not keys and isinstance(left, str) and spark.catalog.tableExists(left):
        keys = profile.catalog_keys(spark, left)  # as the catalog states them
    g = GenericComparison(spark, ldf, rdf, tuple(keys or ()), t1, t2)
    # one key pairing, materialised, feeds the row, cell and log reports
    g.frame = _materialise(spark, g.pairs_frame)
    w = _Writer(spark, output, table_prefix, run_id, skip_empty)
    figures = {"structure_differences": w.write("structure_diff", g.structure_diff())["rows"]}
    figures["mismatched_rows"] = w.write("mismatched_rows", g.full_diff())["rows"]
    w.write("mismatch_report", g.mismatch_long())
    now = dt.datetime.now()
    w.write("validation_log", g.validation_log(now))
    passed = all(v == 0 for v in figures.values())
    result = RunResult("PASSED" if passed else "FAILED", run_id, figures)
    summary = spark.createDataFrame([(
        run_id, t1, t2, figures["structure_differences"], figures["mismatched_rows"],
        ", ".join(g.rs.keys), len(g.rs.common), result.status, f"{now:%Y-%m-%d %H:%M:%S}")],
        "run_id string, table1 string, table2 string, structure_differences long, "
        "mismatched_rows long, key_columns string, common_columns_count long, status string, "
        "validation_date string")
    w.write("summary", summary, single_file=True, always=True)
    w.publish(result.status)
    result.written = w.written
    return result


def run_job(spark: SparkSession, left, right, keys, compare=None, output_columns=(),
            pairing: str = "ordinal", null_mode: str = "safe", output: str | None = None,
            generic: bool = False) -> DataFrame:
    """One-row ``status_line`` DataFrame (what the reference's stored procedure returned)."""
    if output is None:
        output = output_dir(spark, "run")
    if generic:
        res = run_generic(spark, left, right, keys, output=output)
    else:
        spec = ReconSpec(keys=tuple(keys), compare=tuple(compare) if compare else None,
                         output=tuple(output_columns), pairing=pairing, null_mode=null_mode)
        res = run_validation(spark, left, right, spec, output=output)
    return spark.createDataFrame([(res.status_line(),)], "status_line string")


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="python -m paritas.plans.run",
                                description="Reconcile two tables and write the results.")
    p.add_argument("left")
    p.add_argument("right")
    p.add_argument("--keys", required=True, help="comma-separated key columns")
    p.add_argument("--compare", help="comma-separated compare columns (default: all common)")
    p.add_argument("--output-columns", default="", help="extra reported columns")
    p.add_argument("--pairing", choices=["ordinal", "cross"], default="ordinal")
    p.add_argument("--null-mode", choices=["safe", "sentinel", "mixed"], default="safe")
    p.add_argument("--output", help="result folder (default: under the warehouse folder)")
    p.add_argument("--generic", action="store_true", help="schema + unique-key compare")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("paritas").getOrCreate()
    split = (lambda s: [x.strip() for x in s.split(",") if x.strip()])
    line = run_job(spark, a.left, a.right, split(a.keys),
                   split(a.compare) if a.compare else None, split(a.output_columns),
                   a.pairing, a.null_mode, a.output, a.generic)
    print(line.first()[0])


if __name__ == "__main__":
    main()
