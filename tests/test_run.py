"""End-to-end runs write every result once and report figures from observations."""

import os
import tempfile

from conftest import SF01
from paritas.plans.catalog import ENROLL_SPEC, LINE_SPEC
from paritas.plans.run import run_generic, run_job, run_validation
from paritas.sources import enroll_pair, feed_pair, line_pair


def _tmp():
    return tempfile.mkdtemp(prefix="paritas-run-")


def test_duplicate_aware_run(spark):
    dev, prod = enroll_pair(spark, SF01)
    res = run_validation(spark, dev, prod, ENROLL_SPEC, output=_tmp(),
                         left_table="enroll_dev", right_table="enroll_prod")
    f = res.figures
    assert (f["total_left_rows"], f["total_right_rows"]) == (13771, 14083)
    assert (f["rows_only_in_left"], f["rows_only_in_right"]) == (838, 919)
    assert f["mismatched_data_points"] == 14583
    assert f["keys_with_count_differences"] == 872
    assert res.status == "FAILED" and res.total_issues == 838 + 919 + 14583 + 872
    assert all(os.path.isdir(p) for p in res.written.values())
    # both reports come from one materialised pairing
    unmatched = spark.read.option("header", True).csv(res.written["csv:unmatched_ordinals"])
    assert unmatched.count() == 2414
    summary = spark.read.option("header", True).csv(res.written["csv:summary"]).first()
    assert summary.status == "FAILED" and int(summary.total_issues) == res.total_issues


def test_cross_run_counts_cells_without_pairs(spark):
    left, right = line_pair(spark, SF01)
    res = run_validation(spark, left, right, LINE_SPEC, output=_tmp())
    # FIXTURES.md: cells null-safe per column at sf0.01
    assert res.figures["mismatched_data_points"] == 31414 + 31125 + 23208 + 26699 + 31414
    assert "keys_with_count_differences" not in res.figures
    assert res.figures["total_left_rows"] == 58506


def test_generic_run_and_job(spark):
    left, right = feed_pair(spark, SF01)
    res = run_generic(spark, left, right, ["o_orderkey"], output=_tmp())
    assert res.figures == {"structure_differences": 4, "mismatched_rows": 637 + 350 + 3928}
    line = run_job(spark, left, right, ["o_orderkey"], generic=True, output=_tmp()).first()[0]
    assert line.startswith("FAILED: 4919 issues")


def test_gate_stops_before_scanning(spark):
    dev, prod = enroll_pair(spark, SF01)
    res = run_validation(spark, dev, prod.drop("group_number"), ENROLL_SPEC, output=_tmp())
    assert res.status == "FAILED" and res.figures == {} and res.written == {}
    assert res.issues[0][0] == "missing_comparison_columns_prod"
