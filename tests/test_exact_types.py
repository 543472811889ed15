"""Values that a double cannot tell apart, sinks that keep them, products beyond
64 bits, and join plans that split a hot key."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas import Reconciliation, ReconSpec, sinks
from paritas.functions import cell_text, exact_type, number_text
from paritas.operators import cross, match
from paritas.plans.report import validation_report

SPEC = ReconSpec(keys=("k",), left_name="left", right_name="right")


def pair(spark, left_type, right_type, left_values, right_values, key="k int"):
    return (spark.createDataFrame(list(enumerate(left_values)), f"{key}, v {left_type}"),
            spark.createDataFrame(list(enumerate(right_values)), f"{key}, v {right_type}"))


@pytest.mark.parametrize("left_type,right_type,a,b", [
    ("bigint", "decimal(38,0)", 9007199254740993, Decimal(9007199254740992)),
    ("decimal(19,2)", "decimal(20,2)", Decimal("12345678901234567.89"),
     Decimal("12345678901234567.88")),
    ("decimal(38,30)", "decimal(38,0)", Decimal("1.000000000000000000000000000001"), Decimal(1)),
    ("bigint", "double", 9007199254740993, 9007199254740992.0),
    ("double", "double", 1e-11, 2e-11),
    ("double", "string", 1e-11, "0.0"),
    ("date", "timestamp_ntz", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 1)),
    ("array<timestamp_ntz>", "array<timestamp_ntz>", [dt.datetime(2024, 1, 1, 0, 0, 0, 1)],
     [dt.datetime(2024, 1, 1, 0, 0, 0, 2)]),
    ("map<string,int>", "map<string,int>", {"a": None}, {}),
])
def test_every_path_sees_the_difference(spark, left_type, right_type, a, b):
    left, right = pair(spark, left_type, right_type, [a], [b])
    r = Reconciliation(spark, left, right, SPEC)
    x = Reconciliation(spark, left, right, SPEC.with_(pairing="cross"))
    cells = r.mismatches.collect()
    assert len(cells) == 1 and cells[0].left_value != cells[0].right_value
    assert x.mismatches.count() == 1 and x.status().first().status == "FAILED"
    assert r.status().first().status == "FAILED"
    assert match.keyless_diff(left, right, ["k", "v"]).count() == 2
    from paritas.operators.diff import fingerprint_diff
    assert fingerprint_diff(left, right, r.rs).count() == 1


@pytest.mark.parametrize("left_type,right_type,a,b", [
    ("decimal(10,2)", "int", Decimal("5.00"), 5),
    ("double", "decimal(3,1)", 0.1, Decimal("0.1")),
    ("float", "string", 0.1, "0.1"),
    ("double", "bigint", 1e15, 10**15),
    ("date", "timestamp_ntz", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1)),
    ("decimal(38,20)", "decimal(38,0)", Decimal("7"), Decimal(7)),
])
def test_equal_values_of_different_types(spark, left_type, right_type, a, b):
    left, right = pair(spark, left_type, right_type, [a, None], [b, None])
    for pairing in ("ordinal", "cross"):
        r = Reconciliation(spark, left, right, SPEC.with_(pairing=pairing))
        assert r.mismatches.count() == 0 and r.status().first().status == "PASSED"
    assert match.keyless_diff(left, right, ["k", "v"]).count() == 0


def test_keys_beyond_double(spark):
    left = spark.createDataFrame([(9007199254740993, 1), (9007199254740992, 1)], "k long, v int")
    right = left.withColumn("k", F.col("k").cast("decimal(38,0)"))
    r = Reconciliation(spark, left, right, SPEC)
    assert r.key_counts.count() == 2
    assert cross.cross_matches(left, right, r.rs).first()[0] == 2
    assert r.one_sided("left").count() == 0 and r.status().first().status == "PASSED"


def test_common_types():
    d = T.DecimalType
    assert exact_type(T.LongType(), d(20, 2)) == d(21, 2)
    assert exact_type(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    assert exact_type(T.LongType(), T.DoubleType()) is None
    assert exact_type(d(38, 10), d(38, 0)) is None
    assert exact_type(T.StringType(), T.LongType()) is None


def test_number_text(spark):
    values = [0.0, -0.0, 1e-11, -1.25e-5, 1.5e10, 388246.03, 1e22, 100.0, float("nan"), None]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        number_text(F.col("v")), cell_text(F.col("v"), T.DoubleType())).collect()
    assert [r[0] for r in rows] == ["0", "0", "0.00000000001", "-0.0000125", "15000000000",
                                    "388246.03", "1" + "0" * 22, "100", "NaN", None]
    assert [r[1] for r in rows][:3] == ["0.0", "0.0", "0.00000000001"]


def test_products_beyond_64_bits(spark):
    rows = spark.createDataFrame([(4 * 10**9, 4 * 10**9)] * 2,
                                 "left_rows long, differing_partners long")
    assert cross.cross_cell_total(rows).first()[0] == Decimal(32 * 10**18)


def test_csv_keeps_microseconds_and_nested_values(spark, tmp_path):
    schema = ("k int, at timestamp_ntz, tags array<string>, box struct<a:int,b:timestamp_ntz>, "
              "m map<string,int>")
    at = dt.datetime(2024, 1, 1, 1, 2, 3, 123456)
    df = spark.createDataFrame([(1, at, ["a", None, "b, c"], (None, at), {"x": None}),
                                (2, None, None, None, None), (3, at, [], (1, None), {})], schema)
    sinks.write_csv(df, f"{tmp_path}/out")
    back = sinks.read_csv(spark, f"{tmp_path}/out", df.schema)
    assert sorted(back.collect(), key=lambda r: r.k) == sorted(df.collect(), key=lambda r: r.k)


def test_report_lists_issues(spark):
    left, right = pair(spark, "int", "int", [1], [1])
    r = Reconciliation(spark, left, right, SPEC.with_(output=("absent",)))
    rows = [tuple(x) for x in validation_report(r).collect() if x.section == "issues"]
    assert ("issues", "WARNING missing_output_columns_left", "left: absent") in rows


def test_outcomes_of_asked_keys(spark):
    left = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (3, 1), (5, 1)], "k int, v int")
    right = spark.createDataFrame([(1, 1), (2, 1), (4, 1), (5, 2)], "k int, v int")
    r = Reconciliation(spark, left, right, SPEC)
    got = {x.k: (x.left_count, x.right_count, x.outcome)
           for x in r.spot_check_outcomes([1, 2, 3, 4, 5, 9]).collect()}
    assert got == {1: (1, 1, "EQUAL"), 2: (2, 1, "DIFFERENT"), 3: (1, 0, "ONLY_IN_LEFT"),
                   4: (0, 1, "ONLY_IN_RIGHT"), 5: (1, 1, "DIFFERENT"), 9: (0, 0, "NOT_FOUND")}


def test_one_sided_splits_a_hot_key(spark):
    """With a third of all rows under one key, AQE splits its partition."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
        left = spark.range(n).select(key.alias("k"), F.hash("id").alias("v"))
        right = spark.range(n).where("id % 5 <> 0").select(key.alias("k"), F.hash("id").alias("v"))
        r = Reconciliation(spark, left.repartition(8), right.repartition(8), SPEC)
        df = match.one_sided(r.left, r.right, r.rs)
        assert len(df.collect()) == n * 2 // 3 // 5
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_summary_reads_each_side_once(spark):
    """The plan of a status holds two scans for each side (rows with and without a key)."""
    from paritas.plans.catalog import enroll, lines

    def scans(df, table):
        return df._jdf.queryExecution().executedPlan().toString().count(f"/{table}.parquet")

    sf = "/root/testdata/sf0.001"
    assert scans(lines(spark, sf).status(with_count_differences=False), "lineitem") <= 4
    # each side joins orders and customers once; prod repeats some of its rows
    assert scans(enroll(spark, sf).status(), "orders") <= 6
