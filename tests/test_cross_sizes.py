"""Cross pairing of keys of all sizes: by stacked cells or by frequency tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from paritas.operators import cross, figures
from paritas.spec import ReconSpec

SCHEMA = "k long, a long, b string, c double, note string"


def _rows(seed: int, sizes: dict) -> list[tuple]:
    out = []
    for k, n in sizes.items():
        for i in range(n):
            x = (i * 7 + seed * 3 + (k or 0)) % 5
            out.append((k, None if x == 4 else x % 3, [None, "NULL", "u", "v", "u"][(x + i) % 5],
                        [0.0, -0.0, float("nan"), 1.5, None][(x * i) % 5], "n" if i % 2 else None))
    return out


def _same(x, y) -> bool:
    return x == y or (x is not None and y is not None and x != x and y != y)


LEFT = _rows(1, {1: 1, 2: 2, 3: 9, 4: 16, 5: 40, 6: 3, None: 7})
RIGHT = _rows(2, {1: 1, 2: 5, 3: 9, 4: 17, 5: 30, 7: 2, None: 60})


def _differ(mode, x, y):
    text = lambda v: "NULL" if v is None else v
    sentinel = [not _same(text(p), text(q)) for p, q in zip(x[1:4], y[1:4])]
    safe = [not _same(p, q) for p, q in zip(x[1:4], y[1:4])]
    if mode == "mixed":
        return safe if any(sentinel) else [False] * 3
    return sentinel if mode == "sentinel" else safe


@pytest.mark.parametrize("mode", ["safe", "sentinel", "mixed"])
@pytest.mark.parametrize("output", [("note",), ("a", "b", "c", "note")])
def test_cells_equal_all_pairs(spark, mode, output):
    spec = ReconSpec(keys=("k",), compare=("a", "b", "c"), output=output, null_mode=mode,
                     pairing="cross")
    left, right = (spark.createDataFrame(r, SCHEMA) for r in (LEFT, RIGHT))
    rs = spec.resolve(left, right)
    cells, per_key = Counter(), Counter()
    for x in LEFT:
        for y in (y for y in RIGHT if y[0] == x[0]):
            per_key["__total__"] += 1
            for c, d in zip("abc", _differ(mode, x, y)):
                cells[x[0], c] += d
                per_key[c] += d
    got = cross.mismatch_cells_cross(left, right, rs).groupBy("k", "mismatch_column").agg(
        F.sum(F.col("left_rows") * F.col("differing_partners"))).collect()
    assert {(k, c): n for k, c, n in got} == {k: n for k, n in cells.items() if n}
    counted = cross.cross_column_counts(left, right, rs).collect()
    assert {r["column_name"]: int(r["mismatch_count"]) for r in counted} == {
        c: per_key[c] for c in "abc"}
    assert {int(r["total_matches"]) for r in counted} == {per_key["__total__"]}
    if mode == "safe":
        row = figures.cross_figures(left, right, rs).first()
        assert int(row["cells"]) == sum(cells.values())
        assert (row["left_rows"], row["right_rows"]) == (len(LEFT), len(RIGHT))


def test_a_key_too_large_for_one_task_is_split_off(spark):
    """Before, a window over stacked cells held up to 2,000,000 rows of a key in one task."""
    n = cross.WINDOW_ROWS + 20_000
    t = spark.range(n + 100).select(F.when(F.col("id") >= n, F.col("id")).alias("k"),
                                    F.col("id").alias("a"), F.lit(0).alias(cross.SIDE))
    rs = ReconSpec(keys=("k",), compare=("a",)).resolve(t, t)
    cold, hot, _ = cross._split(t, rs)
    assert hot is not None and hot.count() == n
    assert cold.count() == 100


WIDE = [f"c{i:02d}" for i in range(18)]
WIDE_SCHEMA = "k long, kk string, note string, " + "".join(f"{c} long, " for c in WIDE) + "d double, s string"


def _wide_rows(seed: int, sizes: dict) -> list[tuple]:
    out = []
    for k, n in sizes.items():
        for i in range(n):
            x = (i // 2 * 5 + seed * (i % 3) + (k or 0)) % 7  # some rows twice
            out.append((k, None if k == 2 else "b", ["n", None, "m"][x % 3],
                        *[None if (x + j) % 6 == 0 else (x * j) % 4 for j in range(len(WIDE))],
                        [0.0, -0.0, float("nan"), 1.5, None][x % 5], [None, "NULL", "u"][x % 3]))
    return out


@pytest.mark.parametrize("few", [2, 8])
@pytest.mark.parametrize("output", [("note",), ("s", "note")])
def test_wide_cells_equal_all_pairs(spark, monkeypatch, few, output):
    """Before, each cell of each key became a sorted row; now those of larger keys only."""
    monkeypatch.setattr(cross, "FEW_ROWS", few)
    a = _wide_rows(1, {1: 1, 2: 3, 3: 4, 4: 5, 5: 20, 6: 3, 8: 1, None: 4})
    b = _wide_rows(2, {1: 1, 2: 2, 3: 4, 4: 4, 5: 15, 7: 2, 8: 9, None: 3})
    left, right = (spark.createDataFrame(r, WIDE_SCHEMA) for r in (a, b))
    names = left.columns
    compare = (*WIDE, "d", "s")
    rs = ReconSpec(keys=("k", "kk"), compare=compare, output=output, pairing="cross").resolve(left, right)
    stacked, stack = [], cross.cells_of_clustered
    monkeypatch.setattr(cross, "cells_of_clustered", lambda rows, *more: stacked.append(rows) or stack(rows, *more))
    same_text = lambda v: None if v is None else "NaN" if v != v else str(v + 0.0 if isinstance(v, float) else v)
    want = Counter()
    for x in a:
        partners = [y for y in b if y[:2] == x[:2]]
        for c in compare:
            i = names.index(c)
            differ = sum(not _same(x[i], y[i]) for y in partners)
            if differ:
                want[(*x[:2], *[x[names.index(o)] for o in output], c, same_text(x[i]), len(partners), differ)] += 1
    got = [tuple(r) for r in cross.mismatch_cells_cross(left, right, rs).collect()]
    assert sorted((*r[:-3], *r[-2:], r[-3]) for r in [tuple(map(str, r)) for r in got]) == sorted(
        tuple(map(str, (*r, n))) for r, n in want.items())
    sizes = Counter(r[:2] for r in a + b)
    assert {tuple(r) for r in stacked[0].select("k", "kk").collect()} == {
        k for k, n in sizes.items() if n > few and k in {r[:2] for r in a} & {r[:2] for r in b}}


def test_wide_cells_of_small_keys_alone(spark, monkeypatch):
    """Where no key has more rows, the plan of larger keys is left out; rows of a larger
    key that come after the count end the run, they are not left out."""
    sizes = {1: 1, 2: 3, 3: 4, None: 5}
    left, right = (spark.createDataFrame(_wide_rows(s, sizes), WIDE_SCHEMA) for s in (1, 2))
    rs = ReconSpec(keys=("k", "kk"), compare=(*WIDE, "d", "s"), output=("note",), pairing="cross").resolve(left, right)
    rows = lambda: sorted(map(str, cross.mismatch_cells_cross(left, right, rs).collect()))
    plan = lambda: cross.mismatch_cells_cross(left, right, rs)._jdf.queryExecution().analyzed().toString()
    alone = rows()
    assert "Union" in plan() and "column_name" not in plan()  # the sides' union, no stacked cells
    monkeypatch.setattr(cross, "FEW_ROWS", 2)
    assert alone == rows() and "column_name" in plan()
    monkeypatch.setattr(cross, "_most_rows", lambda *_: 2)
    with pytest.raises(Exception, match="changed while it was read"):
        rows()
