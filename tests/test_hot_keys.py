"""The range plan for hot keys numbers rows exactly like the window plan, and
the plan shapes every registered query must keep."""

import json

from conftest import SF001, SF01
from paritas.operators import diff, ordinals
from paritas.plans.catalog import enroll
from paritas.sources import read_table


def test_range_ordinals_equal_window_on_skewed_keys(spark):
    # l_returnflag has three values: every key is "hot"
    li = read_table(spark, SF001, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    order = ["l_orderkey", "l_linenumber"]
    win = ordinals.window_ordinals(li, ["l_returnflag"], order)
    rng = ordinals.range_ordinals(li, ["l_returnflag"], order)
    assert win.count() == rng.count()
    assert win.exceptAll(rng).count() == 0


def test_with_ordinals_splits_hot_and_cold(spark, hot_rows):
    li = read_table(spark, SF001, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber")
    hot_rows(30)  # parts have 17..48 rows: about half are hot
    hot = ordinals.find_hot_keys(li, ["l_partkey"])
    assert hot is not None and 0 < hot.count() < li.select("l_partkey").distinct().count()
    mixed = ordinals.with_ordinals(li, ["l_partkey"], ["l_orderkey", "l_linenumber"], hot=hot)
    plain = ordinals.window_ordinals(li, ["l_partkey"], ["l_orderkey", "l_linenumber"])
    assert mixed.exceptAll(plain).count() == 0 and plain.exceptAll(mixed).count() == 0


def test_sampled_detection_finds_a_hot_key(spark):
    """Above SAMPLE_ROWS_PER_HOT_KEY the hot set is estimated from a sample; a key
    holding ~30% of the rows is found, keys of a few rows are not, and the
    numbering through the hot plan equals the window plan."""
    from pyspark.sql import functions as F

    li = read_table(spark, SF01, "lineitem").select(
        F.when(F.col("l_linenumber") <= 2, F.lit(0)).otherwise(F.col("l_orderkey")).alias("k"),
        "l_orderkey", "l_linenumber")
    big = li.filter("k = 0").count()
    assert 15000 < big < 20000
    hot = ordinals.find_hot_keys(li, ["k"], hot_rows=8000)  # sampled at 50%
    assert hot is not None and [r.k for r in hot.collect()] == [0]
    assert ordinals.find_hot_keys(li, ["k"], hot_rows=40000) is None  # sampled at 10%
    mixed = ordinals.with_ordinals(li, ["k"], ["l_orderkey", "l_linenumber"], hot=hot)
    plain = ordinals.window_ordinals(li, ["k"], ["l_orderkey", "l_linenumber"])
    assert mixed.exceptAll(plain).count() == 0 and plain.exceptAll(mixed).count() == 0


def test_flagship_same_result_with_hot_path(spark, hot_rows):
    r = enroll(spark, SF01)
    plain = diff.mismatch_cells(r.left, r.right, r.rs).cache()
    hot_rows(8)  # a large share of member ids exceed 8 rows
    hot = diff.mismatch_cells(r.left, r.right, r.rs)
    assert plain.count() == 14583
    assert hot.exceptAll(plain).count() == 0 and plain.exceptAll(hot).count() == 0
    plain.unpersist()


# queries whose construction writes a sink (checked in test_sinks_and_entry)
_WRITES = {"sink_table_roundtrip", "sink_csv_roundtrip"}


def _plan_nodes(df):
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.initialPlan()
    return json.loads(plan.toJSON())


def test_plan_shapes_of_every_query(spark):
    """No query plans a cartesian / nested-loop join, a window without a
    partition key (a whole-table single task), or a collect_list/collect_set
    aggregate (a whole group gathered into one value)."""
    from paritas.plans.catalog import QUERIES

    bad = []
    for key, fn in sorted(QUERIES.items()):
        if key in _WRITES:
            continue
        for node in _plan_nodes(fn(spark, SF001)):
            cls = node["class"].rsplit(".", 1)[-1]
            if cls in ("CartesianProductExec", "BroadcastNestedLoopJoinExec"):
                bad.append((key, cls))
            if cls == "WindowExec" and not node.get("partitionSpec"):
                bad.append((key, "unpartitioned window"))
            text = json.dumps(node)
            if "CollectList" in text or "CollectSet" in text:
                bad.append((key, "collect aggregate"))
    assert not bad, bad


# upper bounds on shuffle nodes in the initial physical plan (fixture derivation
# included); keyless_diff reads its aggregate in two branches, so that exchange
# is listed twice (and reused at run time), plus the chunk-row repartition
_MAX_SHUFFLES = {"mismatch_cells": 1, "unmatched_ordinals": 1, "generic_mismatch_long": 1,
                 "business_mismatch_cells": 3, "keyless_diff": 3, "count_differences": 2}


def test_shuffle_counts_of_headline_plans(spark):
    from paritas.plans.catalog import QUERIES

    got = {}
    for key, limit in _MAX_SHUFFLES.items():
        nodes = _plan_nodes(QUERIES[key](spark, SF001))
        got[key] = sum(n["class"].endswith("ShuffleExchangeExec") for n in nodes)
    assert all(got[k] <= v for k, v in _MAX_SHUFFLES.items()), got


def test_identical_hot_rows_spread_over_range_partitions(spark):
    """A hot key whose rows are all identical still spans several range
    partitions, and the numbering is the window plan's (1..n)."""
    from pyspark.sql import functions as F

    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")  # small test data would be coalesced into one partition
    try:
        # values equal on every row but computed from the data (constant sort
        # keys would be removed by the optimizer)
        same = F.col("id") >= 0
        df = spark.range(20000).select(F.when(same, F.lit(7)).alias("k"),
                                       F.when(same, F.lit("same")).alias("v"))
        out = ordinals.range_ordinals(df.repartition(8), ["k"], ["v"])
        parts = out.select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 1
        rns = out.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first()
        assert tuple(rns) == (1, 20000, 20000)
    finally:
        spark.conf.set(key, old)


def test_large_hot_set_joins_by_shuffle(spark, hot_rows):
    """The hot-key set carries no broadcast hint: Spark picks by its bytes, and
    the ordinals are unchanged."""
    li = read_table(spark, SF001, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber")
    hot_rows(30)
    hot = ordinals.find_hot_keys(li, ["l_partkey"])
    assert hot is not None and hot.count() > 2
    assert "broadcast" not in hot._jdf.queryExecution().analyzed().toString().lower()
    mixed = ordinals.with_ordinals(li, ["l_partkey"], ["l_orderkey", "l_linenumber"], hot=hot)
    plain = ordinals.window_ordinals(li, ["l_partkey"], ["l_orderkey", "l_linenumber"])
    assert mixed.exceptAll(plain).count() == 0 and plain.exceptAll(mixed).count() == 0


def test_bucketed_inputs_pair_without_shuffle(spark, tmp_path):
    """Inputs bucketed by the key are paired without any exchange: the
    numbering window only requires clustering by key."""
    from paritas import ReconSpec
    from paritas.operators import match

    li = read_table(spark, SF001, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    suffix = tmp_path.name.replace("-", "_")
    for name, df in (("bl", li), ("br", li.filter("l_partkey % 7 <> 0"))):
        (df.write.bucketBy(8, "l_orderkey").option("path", str(tmp_path / name))
         .saveAsTable(f"paritas_{name}_{suffix}"))
    left, right = spark.table(f"paritas_bl_{suffix}"), spark.table(f"paritas_br_{suffix}")
    rs = ReconSpec(keys=("l_orderkey",), compare=("l_partkey",),
                   output=("l_linenumber",)).resolve(left, right)
    pairs = match.ordinal_pairs(left, right, rs, how="full_outer")
    nodes = _plan_nodes(pairs)
    # hot-key detection may add its own small job; the pairing plan has no exchange
    assert sum(n["class"].endswith("ShuffleExchangeExec") for n in nodes) == 0
    plain = match.ordinal_pairs(li, li.filter("l_partkey % 7 <> 0"), rs, how="full_outer")
    assert pairs.count() == plain.count() > 0
    assert pairs.exceptAll(plain).count() == 0
