"""Clusterings by key take as many tasks as their rows need."""

from collections import Counter

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from paritas.operators import cross, fanout, figures, match, ordinals
from paritas.sources import fixtures
from paritas.spec import ReconSpec

SCHEMA = "k long, a long, b string, note string"


def _rows(seed: int, n: int) -> list[tuple]:
    return [(None if i % 11 == 0 else i // 3, None if (i * seed) % 7 == 0 else i % 2,
             [None, "NULL", "u"][(i + seed * (i % 5)) % 3], f"n{i % 4}") for i in range(n)]


@pytest.fixture
def few(monkeypatch):
    """Tasks of some ten values, tables counted in full."""
    monkeypatch.setattr(ordinals, "TASK_VALUES", 50)
    monkeypatch.setattr(cross, "WINDOW_ROWS", 100)


def _sides(spark, n=300):
    return [spark.createDataFrame(_rows(s, n), SCHEMA) for s in (1, 2)]


def _rs(left, right, mode="safe", pairing="cross"):
    return ReconSpec(keys=("k",), compare=("a", "b"), output=("note",), null_mode=mode,
                     pairing=pairing).resolve(left, right)


def _exchanges(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows,columns", [(3_000_000, 5), (30_000_000, 5), (3_000_000, 50)])
def test_tasks_grow_with_the_rows(spark, rows, columns):
    df = spark.range(10).select((F.col("id") % 7).alias("id"), *[F.lit(i).alias(f"c{i}") for i in range(columns - 1)])
    tasks = ordinals.spread(df, ["id"], rows).rdd.getNumPartitions()
    assert tasks == rows * columns // ordinals.TASK_VALUES
    clustered = df.repartition(4, "id")
    assert ordinals.spread(clustered, ["id"], rows) is clustered
    assert ordinals.spread(df, ["id"], 10) is df


def test_rows_are_counted_with_the_hot_keys(spark):
    df = spark.range(1000).select(F.when(F.col("id") >= 400, 7).alias("k"))
    hot, rows = ordinals.hot_keys_and_rows(df, ["k"], hot_rows=500)
    assert ([r[0] for r in hot.collect()], rows) == ([7], 1000)
    hot, rows = ordinals.hot_keys_and_rows(df, ["k"], hot_rows=700)
    assert (hot, rows) == (None, 1000)
    assert ordinals.hot_keys_and_rows(df.limit(0), ["k"], hot_rows=5) == (None, 0)


def test_clusterings_are_spread(spark, few, hot_rows):
    hot_rows(1000)
    left, right = _sides(spark)
    rs, by_rank = _rs(left, right), _rs(left, right, pairing="ordinal")
    for df in (cross.mismatch_cells_cross(left, right, rs),
               cross.cross_column_counts(left, right, rs, "mixed"),
               cross.right_values_cross(left, right, rs),
               figures.cross_figures(left, right, rs),
               figures.ordinal_figures(left, right, by_rank, "safe"),
               match.ordinal_pairs(left, right, by_rank),
               fanout.cross_results(left, right, rs).frame,
               fanout.ordinal_results(left, right, by_rank).frame):
        assert "REPARTITION_BY_NUM" in _exchanges(df)


@pytest.mark.parametrize("mode", ["safe", "sentinel", "mixed"])
@pytest.mark.parametrize("threshold", [10, 10_000])  # the NULL key apart, and with the others
def test_right_values_of_all_pairs(spark, few, hot_rows, mode, threshold):
    hot_rows(threshold)
    left, right = _sides(spark, 120)
    rs = _rs(left, right, mode)
    text = lambda v: "NULL" if v is None else v
    named, want = set(), Counter()
    for x in _rows(1, 120):
        for y in (y for y in _rows(2, 120) if y[0] == x[0]):
            sentinel = [text(p) != text(q) for p, q in zip(x[1:3], y[1:3])]
            safe = [p != q for p, q in zip(x[1:3], y[1:3])]
            found = (safe if mode == "safe" else sentinel if mode == "sentinel"
                     else [d and any(sentinel) for d in safe])
            named |= {(x[0], c) for c, d in zip("ab", found) if d}
    alike = (lambda v: text(v)) if mode == "sentinel" else (lambda v: v)
    for y in _rows(2, 120):
        for c, v in zip("ab", y[1:3]):
            if (y[0], c) in named:
                want[y[0], c, None if alike(v) is None else str(alike(v))] += 1
    got = Counter()
    for k, c, v, n in cross.right_values_cross(left, right, rs).collect():
        got[k, c, text(v) if mode == "sentinel" else v] += n
    assert got == want


def test_wide_rows_are_not_shuffled_to_be_paired(spark, monkeypatch):
    """Before, the join by customer came last, and rows of 45 columns were shuffled by key."""
    monkeypatch.setattr(fixtures, "WIDE_TASK_LINES", 500)
    left, right = fixtures.wide_pair(spark, SF001)
    both = left.withColumn("s", F.lit(0)).unionByName(right.withColumn("s", F.lit(1)))
    assert ordinals.is_clustered(both, fixtures.LINE_KEYS)
