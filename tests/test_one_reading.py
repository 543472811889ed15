"""A run's results from one reading, written, checked and published; cross
pairing under the mixed rule and on wide or bucketed tables."""

import itertools
import random

import pytest
from conftest import SF001
from test_hot_keys import _plan_nodes

from paritas import ReconSpec, sinks
from paritas.operators import cross, fanout, match
from paritas.plans import run
from paritas.plans.catalog import ENROLL_SPEC, enroll, lines, typed
from paritas.plans.validate import Reconciliation
from paritas.sources import read_table


def _scans(df, column):
    return sum(n["class"].endswith("FileSourceScanExec") and column in str(n["output"])
               for n in _plan_nodes(df))


def _rows(df, columns=None):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def _pair(spark, seed=1, rows=300):
    rng = random.Random(seed)
    schema = "k long, v string, w int, x string, o string"

    def side(n):
        return [(rng.choice([None, *range(40)]), rng.choice([None, "NULL", "a", "b"]),
                 rng.choice([None, 1, 2]), rng.choice([None, "NULL", "c"]), rng.choice("pq"))
                for _ in range(n)]

    return spark.createDataFrame(side(rows), schema), spark.createDataFrame(side(rows), schema)


SPEC = ReconSpec(keys=("k",), compare=("v", "w", "x"), output=("o",), left_name="l", right_name="r")


# --- cross pairing under the mixed rule ----------------------------------------
def _mixed_by_pairs(left, right):
    """The definition, over all pairs."""
    ls, rs = [tuple(r) for r in left.collect()], [tuple(r) for r in right.collect()]

    def text(v):
        return "NULL" if v is None else str(v)

    out, totals = {}, dict.fromkeys(("v", "w", "x"), 0)
    for k, *cells, o in ls:
        partners = [r for r in rs if text(r[0]) == text(k)]
        picked = [r for r in partners if any(text(a) != text(b) for a, b in zip(cells, r[1:4]))]
        for i, c in enumerate(("v", "w", "x")):
            n = sum(cells[i] != r[i + 1] for r in picked)
            totals[c] += n
            if n:
                value = None if cells[i] is None else str(cells[i])
                key = (k, o, c, value, len(partners), n)
                out[key] = out.get(key, 0) + 1
    return sorted(((k, o, c, v, rows, p, n) for (k, o, c, v, p, n), rows in out.items()), key=repr), totals


@pytest.mark.parametrize("hot", [0, 4])
def test_mixed_rule_by_all_pairs(spark, hot_rows, hot):
    hot_rows(hot)
    left, right = _pair(spark)
    rs = SPEC.with_(pairing="cross", null_mode="mixed").resolve(left, right)
    cells, totals = _mixed_by_pairs(left, right)
    assert _rows(cross.mismatch_cells_cross(left, right, rs)) == cells and len(cells) > 50
    counts = {r.column_name: int(r.mismatch_count)
              for r in cross.cross_column_counts(left, right, rs).collect()}
    assert counts == totals
    # the rule counts more cells than the sentinel one and fewer than the safe one
    safe = cross.cross_column_counts(left, right, rs, "safe").groupBy().sum("mismatch_count")
    assert sum(totals.values()) < int(safe.first()[0])


# --- one reading ------------------------------------------------------------------
@pytest.mark.parametrize("mode", ["safe", "sentinel", "mixed"])
@pytest.mark.parametrize("pairing", ["ordinal", "cross"])
@pytest.mark.parametrize("hot", [0, 4])
def test_results_equal_the_separate_plans(spark, hot_rows, mode, pairing, hot):
    hot_rows(hot)
    left, right = _pair(spark, seed=5)
    recon = Reconciliation(spark, left, right, SPEC.with_(pairing=pairing, null_mode=mode))
    results = recon.results()
    frame = results.frame
    want = {"left_only": recon.one_sided("left"), "right_only": recon.one_sided("right"),
            "count_differences": recon.count_differences, "mismatches": recon.mismatches}
    if pairing == "ordinal":
        want["unmatched_ordinals"] = match.unmatched_ordinals(left, right, recon.rs)
    assert set(results.kinds) == set(want)
    for kind, df in want.items():
        got = results.of(frame, kind)
        assert got.columns == df.columns and _rows(got) == _rows(df), kind
    rows = [r for f in [results.rows, *results.more] for r in f.groupBy().sum(
        fanout.LEFT_ROWS, fanout.RIGHT_ROWS).collect()]
    assert (sum(r[0] or 0 for r in rows), sum(r[1] or 0 for r in rows)) == (left.count(), right.count())


def test_reported_columns_keep_types_of_their_side(spark):
    left = spark.createDataFrame([(1, 5, "a"), (2, 6, "b")], "k int, v int, n string")
    right = spark.createDataFrame([(1, 5.5, "a"), (3, 6.0, "b")], "k long, v double, n string")
    recon = Reconciliation(spark, left, right, ReconSpec(keys=("k",), left_name="l", right_name="r"))
    for pairing in ("ordinal", "cross"):
        recon = Reconciliation(spark, left, right, recon.spec.with_(pairing=pairing))
        frame = recon.results().frame
        for side in ("left", "right"):
            got, want = recon.results().of(frame, f"{side}_only"), recon.one_sided(side)
            assert got.dtypes == want.dtypes and _rows(got) == _rows(want)
        cells = recon.results().of(frame, "mismatches").collect()
        assert [(c.mismatch_column, c.left_value) for c in cells] == [("v", "5")]


@pytest.mark.parametrize("pairing", ["ordinal", "cross"])
def test_each_side_is_read_once(spark, pairing):
    left = read_table(spark, SF001, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    right = left.filter("l_suppkey % 5 <> 0")
    spec = ReconSpec(keys=("l_orderkey",), pairing=pairing)
    results = Reconciliation(spark, left, right, spec).results()
    assert _scans(results.frame, "l_orderkey") == 2
    nodes = _plan_nodes(results.frame)
    assert sum(n["class"].endswith("ShuffleExchangeExec") for n in nodes) == 1


def test_types_without_a_common_one_are_read_separately(spark):
    r = typed(spark, SF001)
    assert r.results() is None
    res = run.run_validation(spark, r.left, r.right, r.spec)
    assert res.figures["mismatched_data_points"] == r.mismatches.count() > 0


# --- write, check, publish --------------------------------------------------------
def _run(spark, folder, **how):
    r = enroll(spark, SF001)
    return run.run_validation(spark, r.left, r.right, how.pop("spec", ENROLL_SPEC),
                              output=str(folder), **how)


def test_a_killed_run_is_not_published(spark, tmp_path, monkeypatch):
    assert run.published(spark, str(tmp_path)).count() == 0
    done = _run(spark, tmp_path)
    real, calls = sinks.write_csv, itertools.count()

    def dies(*args, **kwargs):
        if next(calls) == 2:
            raise KeyboardInterrupt
        return real(*args, **kwargs)

    monkeypatch.setattr(sinks, "write_csv", dies)
    with pytest.raises(KeyboardInterrupt):
        _run(spark, tmp_path)
    monkeypatch.undo()
    found = run.published(spark, str(tmp_path)).collect()
    assert {f.run_id for f in found} == {done.run_id}
    assert {f.result: f.location for f in found} == {
        k.removeprefix("csv:"): v for k, v in done.written.items()}
    schema = enroll(spark, SF001).one_sided("left").schema
    for f in found:
        if f.result == "left_only":
            back = run.read_result(spark, f.sink, f.location, schema)
            assert back.count() == f.rows == done.figures["rows_only_in_left"]


def test_a_short_write_is_an_error(spark, tmp_path, monkeypatch):
    real = sinks.write_csv
    monkeypatch.setattr(sinks, "write_csv", lambda df, *a, **k: real(
        df.limit(3) if "dev_count" in df.columns else df, *a, **k))
    monkeypatch.setattr(run.fanout.Results, "of", lambda self, frame, kind: frame.filter(
        f"kind = '{kind}'").select(f"{kind}.*").limit(1))
    with pytest.raises(RuntimeError, match="staged"):
        _run(spark, tmp_path)
    assert run.published(spark, str(tmp_path)).count() == 0


def test_tables_are_published(spark, tmp_path):
    prefix = "paritas_pub_" + tmp_path.name.replace("-", "_")
    r = enroll(spark, SF001)
    res = run.run_validation(spark, r.left, r.right, ENROLL_SPEC, table_prefix=prefix)
    found = {f.result: f for f in run.published(spark, table_prefix=prefix).collect()}
    assert found["mismatches"].rows == res.figures["mismatched_data_points"]
    assert spark.table(found["mismatches"].location).count() == found["mismatches"].rows
    for f in [*(x.location for x in found.values()), f"{prefix}_manifest_{res.run_id}"]:
        spark.sql(f"DROP TABLE {f}")


class _Jobs:
    """The number of jobs that ran, by the status tracker's groups."""

    def __init__(self, spark, name):
        self.context, self.name = spark.sparkContext, name

    def __enter__(self):
        self.context.setJobGroup(self.name, self.name)
        return self

    def __exit__(self, *_):
        self.n = len(self.context.statusTracker().getJobIdsForGroup(self.name))
        self.context.setLocalProperty("spark.jobGroup.id", None)


def test_empty_results_are_left_out(spark, tmp_path):
    left = spark.range(50).selectExpr("id AS k", "id AS v")
    spec = ReconSpec(keys=("k",), compare=("v",))
    res = run.run_validation(spark, left, left, spec, output=str(tmp_path / "a"), skip_empty=True)
    assert list(res.written) == ["csv:summary"] and res.status == "PASSED"
    generic = run.run_generic(spark, left, left, ["k"], output=str(tmp_path / "b"), skip_empty=True)
    assert set(generic.written) == {"csv:validation_log", "csv:summary"}
    assert sorted(p.name.split("_2")[0] for p in (tmp_path / "b").iterdir()) == [
        "manifest", "summary", "validation_log"]
    # a result whose count is not known is written once and then dropped: one job
    w = run._Writer(spark, str(tmp_path / "c"), None, "x", skip_empty=True)
    with _Jobs(spark, "empty") as jobs:
        w.write("none", left.filter("v < 0"))
    assert jobs.n == 1 and not w.written and not (tmp_path / "c" / "none_x").exists()
    with _Jobs(spark, "known") as jobs:
        w.write("none", left.filter("v < 0"), rows=0)
    assert jobs.n == 0


# --- clustering and pruning -------------------------------------------------------
def test_bucketed_inputs_cross_without_shuffle(spark, tmp_path):
    li = read_table(spark, SF001, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    other = li.selectExpr("l_orderkey", "l_linenumber",
                          "if(l_partkey % 7 = 0, l_partkey + 1, l_partkey) AS l_partkey")
    suffix = tmp_path.name.replace("-", "_")
    for name, df in (("cl", li), ("cr", other)):
        (df.write.bucketBy(8, "l_orderkey").option("path", str(tmp_path / name))
         .saveAsTable(f"paritas_{name}_{suffix}"))
    left, right = spark.table(f"paritas_cl_{suffix}"), spark.table(f"paritas_cr_{suffix}")
    spec = ReconSpec(keys=("l_orderkey",), compare=("l_partkey",), output=("l_linenumber",),
                     pairing="cross")
    rs = spec.resolve(left, right)
    for plan in (cross.mismatch_cells_cross, cross.changed_cross):
        got = plan(left, right, rs)
        assert sum(n["class"].endswith("ShuffleExchangeExec") for n in _plan_nodes(got)) == 0
        assert _rows(got) == _rows(plan(li, other, rs)) and got.count() > 0
    frame = Reconciliation(spark, left, right, spec).results().frame
    assert sum(n["class"].endswith("ShuffleExchangeExec") for n in _plan_nodes(frame)) == 0
    counts = cross.cross_column_counts(left, right, rs)  # only the last sum over all keys
    assert sum(n["class"].endswith("ShuffleExchangeExec") for n in _plan_nodes(counts)) == 1


def test_equal_columns_give_no_cells(spark):
    """Only columns that vary within a key are stacked."""
    r = lines(spark, SF001)
    t = cross._tagged(r.left, r.right, r.rs, "safe", list(
        dict.fromkeys(r.rs.keys + r.rs.output + r.rs.compare)))
    rows = cross._paired(t, r.rs.keys, r.rs, "safe")
    stacked = rows.selectExpr(f"size(filter({cross.VARY}, x -> x)) AS n").groupBy().sum("n").first()[0]
    cells = r.mismatches.count()
    assert 0 < cells <= stacked <= 3 * cells < rows.count() * len(r.rs.compare)
