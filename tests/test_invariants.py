"""Invariants of a reconciliation on the derived fixture pairs (sf0.001)."""

from pyspark.sql import functions as F

from conftest import SF001
from paritas import ColumnResolutionError, ReconSpec
from paritas.operators import counts, cross, diff, match
from paritas.plans.catalog import ENROLL_SPEC, enroll
from paritas.plans.validate import Reconciliation
from paritas.sources import enroll_pair, line_pair

import pytest


def test_identical_inputs_pass(spark):
    dev, _ = enroll_pair(spark, SF001)
    r = Reconciliation(spark, dev, dev, ENROLL_SPEC)
    st = r.status().collect()[0]
    assert (st.status, st.total_issues) == ("FAILED", st.total_issues) or st.status == "PASSED"
    # NULL keys never match, so identical inputs still have one-sided NULL-key rows;
    # without NULL keys everything is empty and the run passes.
    clean = dev.filter(F.col("member_id").isNotNull())
    r = Reconciliation(spark, clean, clean, ENROLL_SPEC)
    st = r.status().collect()[0]
    assert st.status == "PASSED" and st.total_issues == 0
    assert r.mismatches.count() == 0
    assert r.count_differences.count() == 0


def test_swapping_sides_swaps_outputs(spark):
    dev, prod = enroll_pair(spark, SF001)
    spec = ENROLL_SPEC
    a = spec.resolve(dev, prod)
    b = spec.with_(left_name="prod", right_name="dev").resolve(prod, dev)
    assert match.one_sided(dev, prod, a, "left").exceptAll(
        match.one_sided(prod, dev, b, "right")).count() == 0
    ab = diff.mismatch_cells(dev, prod, a).select("member_id", "mismatch_column",
                                                  "left_value", "right_value")
    ba = diff.mismatch_cells(prod, dev, b).select(
        "member_id", "mismatch_column", F.col("right_value").alias("left_value"),
        F.col("left_value").alias("right_value"))
    assert ab.count() == ba.count() and ab.exceptAll(ba).count() == 0


def test_pairs_plus_unmatched_cover_non_null_rows(spark):
    dev, prod = enroll_pair(spark, SF001)
    rs = ENROLL_SPEC.resolve(dev, prod)
    pairs = match.ordinal_pairs(dev, prod, rs).count()
    un = match.unmatched_ordinals(dev, prod, rs)
    miss_prod = un.filter(F.col("type") == "missing_in_prod").count()
    miss_dev = un.filter(F.col("type") == "missing_in_dev").count()
    assert pairs + miss_prod == dev.filter(F.col("member_id").isNotNull()).count()
    assert pairs + miss_dev == prod.filter(F.col("member_id").isNotNull()).count()
    # FIXTURES.md expected values at sf0.001
    assert (pairs, miss_prod, miss_dev) == (1249, 107, 135)


def test_histogram_accounts_for_all_rows(spark):
    r = enroll(spark, SF001)
    hist = counts.duplicate_histogram(r.left, r.right, r.rs, r.key_counts)
    dev_hist = hist.filter(F.col("side") == "dev").agg(F.sum("total_rows")).first()[0]
    singles = r.key_counts.filter((F.col("dev_count") == 1) & F.col("member_id").isNotNull()).count()
    assert dev_hist + singles == r.left.filter(F.col("member_id").isNotNull()).count()
    assert dev_hist == 1356  # FIXTURES.md


def test_fixture_expected_counts(spark):
    r = enroll(spark, SF001)
    assert diff.mismatch_cells(r.left, r.right, r.rs).count() == 1376
    assert diff.mismatch_cells(r.left, r.right, r.rs, "mixed").count() == 1354
    assert r.one_sided("left").count() == 83
    assert r.one_sided("right").count() == 97
    assert r.count_differences.count() == 80
    assert cross.cross_matches(r.left, r.right, r.rs).first()[0] == 13987


def test_cross_counts_equal_brute_force_pairs(spark):
    """Frequency-based cross figures equal an explicit pair join on a small fixture."""
    left, right = line_pair(spark, SF001)
    spec = ReconSpec(keys=("l_orderkey", "l_linenumber"), pairing="cross")
    rs = spec.resolve(left, right)
    got = {r.column_name: r.mismatch_count
           for r in cross.cross_column_counts(left, right, rs).collect()}
    l, r = left.alias("l"), right.alias("r")
    cond = (F.col("l.l_orderkey").eqNullSafe(F.col("r.l_orderkey"))
            & F.col("l.l_linenumber").eqNullSafe(F.col("r.l_linenumber")))
    pairs = l.join(r, cond)
    want = pairs.agg(*[F.sum((~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))).cast("long")).alias(c)
                       for c in rs.compare]).first().asDict()
    assert got == want
    total = cross.cross_matches(left, right, rs).first()[0]
    assert total == pairs.count()
    cells = cross.mismatch_cells_cross(left, right, rs)
    assert cross.cross_cell_total(cells).first()[0] == sum(want.values())


def test_missing_key_raises(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(1, "x")], "c int, b string")
    with pytest.raises(ColumnResolutionError):
        ReconSpec(keys=("a",)).resolve(a, b)


def test_gate_on_missing_required_column(spark):
    dev, prod = enroll_pair(spark, SF001)
    r = Reconciliation(spark, dev, prod.drop("umi_id"), ENROLL_SPEC)
    assert r.gate_failed
    issues = r.issues().collect()
    assert [(i.type, i.severity, i.missing_columns) for i in issues] == [
        ("missing_comparison_columns_prod", "CRITICAL", ["umi_id"])]


def test_empty_sides(spark):
    dev, prod = enroll_pair(spark, SF001)
    empty = dev.limit(0)
    r = Reconciliation(spark, empty, prod, ENROLL_SPEC)
    s = r.summary().first()
    assert s.total_dev_rows == 0 and s.rows_only_in_prod > 0 and s.mismatched_data_points == 0
    r = Reconciliation(spark, empty, empty, ENROLL_SPEC)
    st = r.status().first()
    assert st.status == "PASSED" and st.total_issues == 0


def test_cross_empty_sides_and_all_null_keys(spark):
    from paritas.plans.catalog import LINE_SPEC

    left, right = line_pair(spark, SF001)
    empty = left.limit(0)
    for l, r, passed in ((empty, right, False), (left, right.limit(0), False),
                         (empty, right.limit(0), True)):
        rs = LINE_SPEC.resolve(l, r)
        counts_ = cross.cross_column_counts(l, r, rs).collect()
        assert len(counts_) == len(rs.compare)
        assert all(x.mismatch_count == 0 and x.total_matches == 0 for x in counts_)
        assert cross.changed_cross(l, r, rs).count() == 0
        assert cross.mismatch_cells_cross(l, r, rs).count() == 0
        st = Reconciliation(spark, l, r, LINE_SPEC).status(with_count_differences=False).first()
        assert (st.status == "PASSED") == passed
    # every key NULL: under cross pairing NULL matches NULL, so all 3 x 2 pairs form
    schema = "k bigint, v string"
    l = spark.createDataFrame([(None, "a"), (None, "a"), (None, "b")], schema)
    r = spark.createDataFrame([(None, "a"), (None, "c")], schema)
    rs = ReconSpec(keys=("k",), compare=("v",), pairing="cross").resolve(l, r)
    got = cross.cross_column_counts(l, r, rs).first()
    assert (got.total_matches, got.mismatch_count) == (6, 4)
    cells = cross.mismatch_cells_cross(l, r, rs)
    assert cross.cross_cell_total(cells).first()[0] == 4


def _hot_pair(spark):
    """A small pair where key 0 holds a third of each side (with NULL and
    repeated values), and the remaining keys are mostly unique."""
    rows_l, rows_r = [], []
    for i in range(600):
        k = 0 if i % 3 == 0 else i
        rows_l.append((k, None if i % 7 == 0 else f"v{i % 5}", i % 4))
        rows_r.append((k if i % 11 else k + 1, f"v{i % 3}", None if i % 13 == 0 else i % 4))
    schema = "k bigint, a string, b int"
    return spark.createDataFrame(rows_l, schema), spark.createDataFrame(rows_r, schema)


@pytest.mark.parametrize("threshold", [None, 50])
def test_cross_reports_exact_with_a_hot_key(spark, hot_rows, threshold):
    """Frequency-based cross reports equal the explicit m x n pair join even when
    one key holds a third of the rows (brute force only on this small fixture),
    with that key in the per-key plan (default threshold) and in the hot-key plan."""
    if threshold is not None:
        hot_rows(threshold)
    left, right = _hot_pair(spark)
    rs = ReconSpec(keys=("k",), compare=("a", "b"), pairing="cross").resolve(left, right)
    l, r = left.alias("l"), right.alias("r")
    pairs = l.join(r, F.col("l.k").eqNullSafe(F.col("r.k")))
    want = pairs.agg(*[F.sum((~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))).cast("long")).alias(c)
                       for c in rs.compare]).first().asDict()
    got = {x.column_name: x.mismatch_count
           for x in cross.cross_column_counts(left, right, rs).collect()}
    assert got == want and want["a"] > 0 and want["b"] > 0
    assert cross.cross_matches(left, right, rs).first()[0] == pairs.count()
    cells = cross.mismatch_cells_cross(left, right, rs)
    assert cross.cross_cell_total(cells).first()[0] == sum(want.values())
    # rows with a differing partner, weighted by multiplicity, vs brute force
    differing = pairs.filter(~F.col("l.a").eqNullSafe(F.col("r.a"))
                             | ~F.col("l.b").eqNullSafe(F.col("r.b")))
    changed = cross.changed_cross(left, right, rs)
    assert changed.agg(F.sum(F.col("left_rows") * F.col("differing_partners"))).first()[0] \
        == differing.count()


def test_ordinal_reports_same_with_hot_key_plan(spark, hot_rows):
    """The hot-key numbering (forced by a tiny threshold) gives the same cells and
    unmatched ordinals as the window plan on the skewed pair."""
    left, right = _hot_pair(spark)
    rs = ReconSpec(keys=("k",), compare=("a", "b")).resolve(left, right)

    def reports():
        cells = diff.mismatch_cells(left, right, rs).collect()
        unmatched = match.unmatched_ordinals(left, right, rs).collect()
        return sorted(map(repr, cells)), sorted(map(repr, unmatched))

    plain = reports()
    from paritas.operators import ordinals
    assert ordinals.find_hot_keys(left, ["k"], hot_rows=50).count() == 1
    hot_rows(50)
    assert reports() == plain and len(plain[0]) > 0 and len(plain[1]) > 0


def test_spot_check_by_key_values(spark):
    """One key value, a list, or a keys DataFrame select the same rows."""
    r = enroll(spark, SF001)
    some = [row.member_id for row in r.count_differences.orderBy("member_id").limit(3).collect()]
    by_list = r.spot_check(some)
    by_frame = r.spot_check(r.keys_frame(some))
    assert by_list.count() == by_frame.count() > 0
    one = r.spot_check(some[0])
    assert {x.member_id for x in one.collect()} == {some[0]}
    details = r.duplicate_details(some[0])
    assert {x.member_id for x in details.collect()} == {some[0]}
    assert r.sample_mismatches(5).select("member_id", "dev_row_number").distinct().count() <= 5


def test_register_views_for_sql(spark):
    r = enroll(spark, SF001)
    names = r.register_views()
    assert len(set(names.values())) == len(names)
    n = spark.sql(f"SELECT count(*) AS n FROM {names['mismatches']}").first().n
    assert n == r.mismatches.count()
    assert spark.sql(f"SELECT count(*) AS n FROM {names['left']}").first().n == r.left.count()


@pytest.mark.parametrize("pairing", ["ordinal", "cross"])
def test_no_compare_columns(spark, pairing):
    """Keys only: no cell can differ; one-sided rows and count differences still count."""
    dev, prod = enroll_pair(spark, SF001)
    r = Reconciliation(spark, dev, prod, ReconSpec(keys=("member_id",), compare=(), pairing=pairing))
    assert r.mismatches.count() == 0
    s = r.summary().first()
    assert s.mismatched_data_points == 0 and s.rows_only_in_dev > 0
    assert r.spot_check(r.count_differences.limit(3)).filter("type = 'data_differences'").count() == 0
    assert cross.changed_cross(dev, prod, r.rs).count() == 0
    assert cross.cross_column_counts(dev, prod, r.rs).count() == 0
