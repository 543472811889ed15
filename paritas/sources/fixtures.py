"""Left/right table pairs derived from the generated TPC-H-like tables.

The given tables contain no second side and no NULLs, so each pair is
derived by rules on the order/customer/lineitem ids (FIXTURES.md): rows
dropped from one side, keys present on one side only, NULL keys, NULLed and
changed cells, extra duplicates.  The rules select which rows *differ*; both
sides always span the whole input table, so the work grows with the data.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

ENROLL_COLUMNS = ["member_id", "umi_id", "group_number", "eligibility_start_date",
                  "last_name", "first_name"]
ENROLL_COMPARE = ["umi_id", "group_number", "eligibility_start_date"]
ENROLL_OUTPUT = [*ENROLL_COMPARE, "last_name", "first_name"]

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_OUTPUT = ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"]


def _enroll_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    ok = F.col("o_orderkey")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.when(ok % 97 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("member_id"),
        ok.alias("umi_id"),
        F.col("o_orderpriority").alias("group_number"),
        F.col("o_orderdate").cast("date").alias("eligibility_start_date"),
        F.col("c_mktsegment").alias("last_name"),
        F.col("c_name").alias("first_name"),
        ok.alias("ok"), F.col("o_custkey").alias("ck"), F.col("o_orderdate").alias("od"),
    )


def enroll_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(enroll_dev, enroll_prod)``: repeated member ids, NULL keys, NULL/'NULL' cells."""
    base = _enroll_base(spark, sf_dir)
    ok, ck = F.col("ok"), F.col("ck")
    dev = base.filter((ok % 41 != 0) & (ck % 17 != 0)).select(
        "member_id", "umi_id",
        F.when(ok % 37 == 0, F.lit(None).cast("string")).otherwise(F.col("group_number"))
        .alias("group_number"),
        "eligibility_start_date", "last_name", "first_name")
    prod_once = base.filter((ok % 23 != 0) & (ck % 19 != 0)).select(
        "member_id", "umi_id",
        F.when(ok % 31 == 0, F.lit(None).cast("string"))
        .when(ok % 37 == 0, F.lit("NULL"))
        .when(ok % 7 == 0, F.lit("0-CHANGED"))
        .otherwise(F.col("group_number")).alias("group_number"),
        F.when(ok % 11 == 0, F.expr("CAST(od + INTERVAL '1' DAY AS DATE)"))
        .otherwise(F.col("eligibility_start_date")).alias("eligibility_start_date"),
        "last_name", "first_name", "ok")
    prod = prod_once.drop("ok").unionByName(prod_once.filter(ok % 29 == 0).drop("ok"))
    return dev, prod


def feed_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(feed_left, feed_right)``: unique key, one extra column per side, a type change."""
    orders = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    left = orders.filter(k % 41 != 0).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority", (k % 5).alias("left_extra"))
    right = orders.filter(k % 23 != 0).select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus"))
        .alias("o_orderstatus"),
        F.when(k % 11 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
        .alias("o_totalprice"),
        "o_orderdate",
        F.when(k % 7 == 0, F.lit("0-CHANGED")).otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"),
        F.lit("R").alias("right_extra"))
    return left, right


def line_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(line_left, line_right)``: composite key ``(l_orderkey, l_linenumber)`` that repeats."""
    li = read_table(spark, sf_dir, "lineitem")
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    left = li.filter(pk % 41 != 0).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        "l_shipdate")
    right = li.filter(pk % 23 != 0).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(pk % 31 == 0, F.lit(None).cast("string")).otherwise(F.col("l_returnflag"))
        .alias("l_returnflag"),
        F.when(sk % 7 == 0, F.lit("X")).otherwise(F.col("l_linestatus")).alias("l_linestatus"),
        "l_shipdate")
    return left, right


def mixed_type_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(exact_left, exact_right)``: the same columns in different types, with
    values that agree in all digits a double holds: keys and amounts beyond
    2**53, rates 1e-11 apart, times a microsecond apart, nested values."""
    orders = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")

    def side(key: str, amount: str, cents, step, micros, mark_micros, priority) -> DataFrame:
        at = F.col("o_orderdate") + F.make_dt_interval(secs=(k % 1_000_000 + micros) / F.lit(1e6))
        mark = F.col("o_orderdate") + F.make_dt_interval(secs=mark_micros / F.lit(1e6))
        return orders.select(
            (k + F.lit(2**53)).cast(key).alias("key_id"),
            (F.col("o_totalprice").cast("decimal(19,2)") + F.lit(10**15).cast("decimal(17,0)")
             + cents.cast("decimal(3,2)")).cast(amount).alias("amount"),
            ((k + step) / F.lit(1e11)).alias("rate"), at.alias("seen"),
            F.array(mark, F.lit(None)).alias("marks"),
            F.struct(k.alias("id"), priority.alias("priority")).alias("box"))

    zero, prio = F.lit(0), F.col("o_orderpriority")
    left = side("bigint", "decimal(19,2)", zero, zero, zero, zero, prio)
    right = side(
        "decimal(38,0)", "decimal(20,2)", F.when(k % 13 == 0, F.lit(0.01)).otherwise(0),
        F.when(k % 11 == 0, 1).otherwise(0), F.when(k % 7 == 0, 1).otherwise(0),
        F.when(k % 17 == 0, 1).otherwise(0), F.when(k % 19 != 0, prio))
    return left.filter((F.col("box.id") % 41) != 0), right.filter((F.col("box.id") % 23) != 0)


def typed_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(typed_left, typed_right)``: equal values in types that no one type or only a
    wider one holds: whole numbers against floating ones, decimals against doubles,
    numbers against texts; NULL against the text 'NULL'."""
    orders = read_table(spark, sf_dir, "orders")
    k, note = F.col("o_orderkey"), F.col("o_orderpriority")
    left = orders.filter(k % 41 != 0).select(
        k.alias("order_id"), (k % 100).cast("int").alias("units"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"), F.col("o_custkey").alias("code"),
        F.when(k % 13 != 0, note).alias("note"))
    right = orders.filter(k % 23 != 0).select(
        k.cast("decimal(20,0)").alias("order_id"),
        (k % 100 + F.when(k % 29 == 0, 0.5).otherwise(0.0)).alias("units"),
        (F.col("o_totalprice").cast("decimal(12,2)")
         + F.when(k % 31 == 0, 1).otherwise(0)).cast("double").alias("price"),
        F.when(k % 37 == 0, F.lit("none")).otherwise(F.col("o_custkey").cast("string")).alias("code"),
        F.when(k % 26 == 0, F.lit("NULL")).when(k % 13 != 0, note).alias("note"))
    return left, right


#: Lines whose wide rows one task holds.
WIDE_TASK_LINES = 25_000
#: Compared columns of ``wide_pair`` made from the part key.
WIDE_MADE = [f"m{i:02d}" for i in range(1, 31)]
WIDE_COMPARE = ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate",
                "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "c_name",
                "c_nationkey", "c_mktsegment", *WIDE_MADE]


def wide_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(wide_left, wide_right)``: order lines with their order and customer, 42
    compared columns."""
    lines = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders").join(
        read_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    # the join by order comes last: both sides are then clustered by a part of their
    # key, and their wide rows need not be shuffled again to be paired
    tasks = math.ceil(lines.count() / WIDE_TASK_LINES)
    if tasks > 1:
        lines, orders = lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    plain = WIDE_COMPARE[:-len(WIDE_MADE)]
    pk = F.col("l_partkey")
    made = {m: pk * i % 97 for i, m in enumerate(WIDE_MADE, 1)}
    left = rows.filter(pk % 41 != 0).select(
        *LINE_KEYS, *plain, *[e.alias(m) for m, e in made.items()])
    right = rows.filter(pk % 23 != 0).select(
        *LINE_KEYS, *plain, *[F.when(pk % (i + 30) == 0, e + 1).otherwise(e).alias(m)
                              for i, (m, e) in enumerate(made.items(), 1)])
    return left, right
