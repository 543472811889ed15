"""Null rules on small literal tables: safe, sentinel and mixed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paritas import ReconSpec
from paritas.operators import diff, match

SCHEMA = "k bigint, v string, d date"


def _pair(spark):
    left = spark.createDataFrame([
        (1, None, dt.date(2020, 1, 1)),    # NULL vs NULL        -> equal everywhere
        (2, None, dt.date(2020, 1, 1)),    # NULL vs 'NULL'      -> differs only when safe
        (3, None, None),                   # NULL vs 'x'         -> differs everywhere
        (4, "a", dt.date(2020, 1, 1)),     # same                -> equal
        (5, None, dt.date(2020, 1, 1)),    # NULL vs 'NULL' and a changed date
    ], SCHEMA)
    right = spark.createDataFrame([
        (1, None, dt.date(2020, 1, 1)),
        (2, "NULL", dt.date(2020, 1, 1)),
        (3, "x", None),
        (4, "a", dt.date(2020, 1, 1)),
        (5, "NULL", dt.date(2020, 1, 2)),
    ], SCHEMA)
    spec = ReconSpec(keys=("k",), compare=("v", "d"), left_name="l", right_name="r")
    return left, right, spec.resolve(left, right)


def _cells(spark, mode):
    left, right, rs = _pair(spark)
    rows = diff.mismatch_cells(left, right, rs, mode).select("k", "mismatch_column").collect()
    return sorted((r.k, r.mismatch_column) for r in rows)


def test_safe_reports_null_vs_text_null(spark):
    assert _cells(spark, "safe") == [(2, "v"), (3, "v"), (5, "d"), (5, "v")]


def test_sentinel_equates_null_and_text_null(spark):
    assert _cells(spark, "sentinel") == [(3, "v"), (5, "d")]


def test_mixed_rule_reports_null_cell_only_when_row_differs_otherwise(spark):
    # rows chosen by the sentinel rule (3 and 5), cells reported null-safely
    assert _cells(spark, "mixed") == [(3, "v"), (5, "d"), (5, "v")]


def test_sentinel_rows_subset_of_safe_rows(spark):
    left, right, rs = _pair(spark)
    safe = {r.k for r in match.changed_pairs(left, right, rs, "safe").collect()}
    sentinel = {r.k for r in match.changed_pairs(left, right, rs, "sentinel").collect()}
    assert sentinel <= safe and sentinel == {3, 5}


def test_null_keys_never_match_in_one_sided(spark):
    left = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b")], "k bigint, v string")
    right = spark.createDataFrame([(None, "a"), (1, "b")], "k bigint, v string")
    rs = ReconSpec(keys=("k",), compare=("v",)).resolve(left, right)
    lo = match.one_sided(left, right, rs, "left")
    assert lo.count() == 2                       # each NULL-key row once, duplicates kept
    assert match.one_sided(left, right, rs, "left", distinct=True).count() == 1
    assert match.one_sided(left, right, rs, "right").filter(F.col("k").isNull()).count() == 1


def test_map_array_struct_columns_compare(spark):
    schema = "k int, m map<string,int>, a array<int>, s struct<x:int,y:string>"
    left = spark.createDataFrame([(1, {"a": 1, "b": 2}, [1, 2], (1, "p")),
                                  (2, {"a": 1}, [1], (2, "q"))], schema)
    right = spark.createDataFrame([(1, {"b": 2, "a": 1}, [1, 2], (1, "p")),
                                   (2, {"a": 9}, [1, 3], (2, None))], schema)
    rs = ReconSpec(keys=("k",), compare=("m", "a", "s")).resolve(left, right)
    cells = diff.mismatch_cells(left, right, rs).collect()
    assert sorted((r.k, r.mismatch_column) for r in cells) == [(2, "a"), (2, "m"), (2, "s")]


def test_cross_null_key_does_not_collide_with_default(spark):
    from paritas.operators import cross

    schema = "k bigint, s string, v string"
    left = spark.createDataFrame([(None, None, "a"), (0, "", "a"), (0, "", "b")], schema)
    right = spark.createDataFrame([(None, None, "a"), (None, None, "x"), (0, "", "a")], schema)
    rs = ReconSpec(keys=("k", "s"), compare=("v",), pairing="cross").resolve(left, right)
    # NULL group: 1 x 2 pairs, (0,'') group: 2 x 1 pairs
    assert cross.cross_matches(left, right, rs).first()[0] == 4
    counts = {r.column_name: r.mismatch_count
              for r in cross.cross_column_counts(left, right, rs).collect()}
    assert counts == {"v": 2}   # (a vs x) in the NULL group, (b vs a) in the (0,'') group


def test_generic_compare_pairs_repeated_keys_by_occurrence(spark):
    from paritas.plans.validate import GenericComparison

    schema = "id bigint, v string"
    left = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (None, "z"), (2, "q")], schema)
    right = spark.createDataFrame([(1, "a"), (1, "b"), (1, "x"), (None, "z"), (3, "q")], schema)
    g = GenericComparison(spark, left, right, ("id",))
    def order(t):
        return (t[0] is None, t[0] or 0, t[1])

    status = sorted(((r.id, r.status) for r in g.full_diff().collect()), key=order)
    # key 1 pairs by occurrence (3 pairs, 1 changed), not 3 x 3; NULL keys never match
    assert status == sorted([(1, "CHANGED"), (None, "LEFT_ONLY"), (None, "RIGHT_ONLY"),
                             (2, "LEFT_ONLY"), (3, "RIGHT_ONLY")], key=order)
    long = g.mismatch_long().collect()
    assert sorted((r.key_values, r.column) for r in long if r.key_values == "id=1") == [
        ("id=1", "v")]


@pytest.mark.parametrize("chunk", [4096, 4])
def test_keyless_diff_equals_except_all_both_ways(spark, monkeypatch, chunk):
    from paritas.operators.match import keyless_diff

    # chunk 4: blocks of 16 rows, so the 9000-row surplus takes the block path
    monkeypatch.setattr(match, "_REPEAT_CHUNK", chunk)

    schema = "a bigint, b string"
    # one row 9000 times on the left (several emission chunks), NULL cells group together
    left = spark.createDataFrame([(1, "x")] * 9000 + [(2, None), (2, None), (3, "y")], schema)
    right = spark.createDataFrame([(1, "x")] * 5 + [(2, None), (4, "z"), (4, "z")], schema)

    def counted(df):
        return sorted(map(tuple, df.groupBy("side", "a", "b").count().collect()), key=str)

    want = left.exceptAll(right).selectExpr("'left' AS side", "*").unionByName(
        right.exceptAll(left).selectExpr("'right' AS side", "*"))
    assert counted(keyless_diff(left, right, ["a", "b"])) == counted(want)


def test_keyless_diff_with_map_columns(spark):
    from paritas.operators.match import keyless_diff

    schema = "a bigint, m map<string,int>"
    left = spark.createDataFrame([(1, {"x": 1, "y": 2}), (1, {"x": 1, "y": 2}), (2, {"z": 3})],
                                 schema)
    right = spark.createDataFrame([(1, {"y": 2, "x": 1}), (2, {"z": 4})], schema)
    got = sorted((r.side, r.a, tuple(sorted(r.m.items())))
                 for r in keyless_diff(left, right, ["a", "m"]).collect())
    assert got == [("left", 1, (("x", 1), ("y", 2))), ("left", 2, (("z", 3),)),
                   ("right", 2, (("z", 4),))]


@pytest.mark.parametrize("pairing", ["ordinal", "cross"])
def test_one_sided_and_summary_with_map_columns(spark, pairing):
    from paritas.plans.validate import Reconciliation

    schema = "k bigint, m map<string,int>, a array<int>"
    left = spark.createDataFrame([(1, {"x": 1}, [1]), (2, {"y": 2}, [2]), (2, {"y": 2}, [2]),
                                  (None, {"z": 1}, [3])], schema)
    right = spark.createDataFrame([(1, {"x": 2}, [1]), (3, {"y": 2}, [2])], schema)
    r = Reconciliation(spark, left, right, ReconSpec(keys=("k",), pairing=pairing))
    assert r.one_sided("left").count() == 2      # key 2 once (distinct) + the NULL-key row
    assert r.one_sided("right").count() == 1
    # one-sided 2 + 1, one differing map cell, count differences for keys 2 and 3
    assert tuple(r.status().first()) == ("FAILED", 6)


def test_wider_right_type_is_not_narrowed(spark):
    """int on the left, bigint on the right with a value beyond int: compared in
    bigint (no ANSI overflow), reported as differing."""
    from paritas.operators import cross
    from paritas.operators.match import keyless_diff

    left = spark.createDataFrame([(1, 5), (2, 7)], "k int, v int")
    right = spark.createDataFrame([(1, 5), (2, 3000000000)], "k bigint, v bigint")
    rs = ReconSpec(keys=("k",), compare=("v",), pairing="cross").resolve(left, right)
    assert [tuple(x) for x in cross.cross_column_counts(left, right, rs).collect()] == [("v", 1, 2)]
    assert cross.mismatch_cells_cross(left, right, rs).count() == 1
    got = sorted(tuple(x) for x in keyless_diff(left, right, ["k", "v"]).collect())
    assert got == [("left", 2, 7), ("right", 2, 3000000000)]
    ordinal = ReconSpec(keys=("k",), compare=("v",)).resolve(left, right)
    assert diff.mismatch_cells(left, right, ordinal).count() == 1


def test_text_vs_number_columns_compare_as_text(spark):
    """A key and a compare column stored as text on one side and as a number on
    the other: compared through their text (no ANSI cast of 'abc' to a number)."""
    from paritas.plans.validate import GenericComparison, Reconciliation

    left = spark.createDataFrame([("1", "abc"), ("2", "7"), (None, "z")], "k string, v string")
    right = spark.createDataFrame([(1, 5), (2, 7), (3, 1)], "k bigint, v int")
    r = Reconciliation(spark, left, right, ReconSpec(keys=("k",), compare=("v",)))
    cells = sorted((x.k, x.left_value, x.right_value) for x in r.mismatches.collect())
    assert cells == [("1", "abc", "5")]
    unmatched = [(x.k, x.type) for x in match.unmatched_ordinals(left, right, r.rs).collect()]
    assert unmatched == [("3", "missing_in_dev")]
    assert sorted(str(x.k) for x in r.one_sided("left").collect()) == ["None"]
    assert [x.k for x in r.one_sided("right").collect()] == [3]
    g = GenericComparison(spark, left, right, ("k",))
    status = sorted((str(x.k), x.status) for x in g.full_diff().collect())
    assert status == [("1", "CHANGED"), ("3", "RIGHT_ONLY"), ("None", "LEFT_ONLY")]
    assert [str(x.k) for x in g.fingerprint_diff().collect()] == ["1"]


def test_number_vs_text_in_cross_and_keyless(spark):
    from paritas.operators import cross
    from paritas.operators.match import keyless_diff

    left = spark.createDataFrame([(1, 5), (2, 7)], "k bigint, v int")
    right = spark.createDataFrame([("1", "abc"), ("2", "7")], "k string, v string")
    rs = ReconSpec(keys=("k",), compare=("v",), pairing="cross").resolve(left, right)
    assert [tuple(x) for x in cross.cross_column_counts(left, right, rs).collect()] == [("v", 1, 2)]
    assert sorted(tuple(x) for x in keyless_diff(left, right, ["k", "v"]).collect()) == [
        ("left", "1", "5"), ("right", "1", "abc")]


@pytest.mark.parametrize("pairing", ["ordinal", "cross"])
def test_text_keys_against_number_keys_status(spark, pairing):
    """Keys stored as text on one side ('x' is no number) and as numbers on the
    other: counts, one-sided rows and cells compare through text."""
    from paritas.plans.validate import Reconciliation

    left = spark.createDataFrame([("1", "abc"), ("2", "7"), (None, "z"), ("x", "q")],
                                 "k string, v string")
    right = spark.createDataFrame([(1, 5), (2, 7), (3, 1)], "k bigint, v int")
    r = Reconciliation(spark, left, right, ReconSpec(keys=("k",), compare=("v",), pairing=pairing))
    diffs = sorted((x.k, x.dev_count, x.prod_count) for x in r.count_differences.collect())
    assert diffs == [("3", 0, 1), ("x", 1, 0)]
    # one-sided: NULL and 'x' (left), 3 (right); one differing cell; two count differences
    assert tuple(r.status().first()) == ("FAILED", 6)
    details = sorted((x.side, x.k) for x in r.duplicate_details(r.count_differences).collect())
    assert details == [("dev", "x"), ("prod", "3")]
    spot = sorted((x.k, x.type) for x in r.spot_check(r.count_differences).collect())
    assert spot == [("3", "missing_in_dev"), ("x", "missing_in_prod")]
