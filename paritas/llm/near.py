"""Candidate groups, exact links and components for near-duplicate texts.

Nodes (distinct texts) have rows in several sorted orders: (tree, high, low)
with ``high`` the part of a signature that candidates must share and ``low``
what sorts them further, and a sketch of 128 bits, each of which agrees with
probability (1 + J) / 2. Rows whose ``high`` no other node has drop out.

Within a region (equal tree and high) the rows whose sketches leave a chance
of a link are joined into candidate groups, each row giving one edge at most;
all rows of a region with more rows than are compared are one group.
So every pair that can be a link lies within one group, and no table holds
pairs. Links are then computed on full sets where a group's rows meet: first
in runs of rows in MinHash order, which settles all groups of up to a run and
links most of a larger one; then, for the larger ones, between the components
found so far, block by block. Blocks that one component fills are not compared
with each other, so a group that is one component by then costs nothing more.
A task gives one edge for a row at most (a spanning forest of what it found).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import (
    Words,
    mixed,
    saved,
    shingle_hashes,
    slices,
    word_hashes,
    words,
)
from paritas.llm.graph import components

#: Sketch bits that may differ: five standard deviations beyond those of J = 0.8.
MOST_APART = 30
#: Rows of a region whose sketches are all compared; all rows of a larger one are one group.
REGION = 1024
#: Rows of a run and of a block, whose sets are all compared, and the shingles
#: that either holds at most (a longer set is a run of its own).
RUN_ROWS, BLOCK_ROWS, MOST_SHINGLES = 512, 1024, 4_000_000
#: Shingles counted by one matrix product.
COLUMNS = 8192


def signatures(h: np.ndarray, owner: np.ndarray, texts: int, functions: int, seed: int = 7,
               ) -> np.ndarray:
    """MinHash values (texts x functions, 32 bits each) of the shingles h of each text."""
    out = np.full((texts, functions), 0xFFFFFFFF, np.uint32)
    if not len(h):
        return out
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    rng = np.random.default_rng(seed)
    factor = rng.integers(0, 2**63, functions, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for i in range(functions):
        out[owner[first], i] = np.minimum.reduceat(
            ((h * factor[i]) >> np.uint64(32)).astype(np.uint32), first)
    return out


def sketches(signature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit halves made of one bit of each of the first 128 values."""
    bits = np.packbits((signature[:, :128] & 1).astype(np.uint8), axis=1)
    halves = np.ascontiguousarray(bits).view(np.int64)
    return halves[:, 0], halves[:, 1]


def packed(values: np.ndarray) -> np.ndarray:
    """16 bits of each of four values (last axis) as one number. The bits are
    mixed from all 32, as the upper ones of a long text's minima are all zero."""
    bits = (values * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return np.ascontiguousarray(bits.astype(np.uint16)).view(np.int64)[..., 0]


def digests(h: np.ndarray, owner: np.ndarray, texts: int,
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's number of distinct shingles and two 64-bit sums over them."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[keep], owner[keep]
    begin = np.searchsorted(owner, np.arange(texts + 1))
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(h ^ np.uint64(salt)))])
        out.append((total[begin[1:]] - total[begin[:-1]]).view(np.int64))
    return np.diff(begin), out[0], out[1]


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, Words]:
    w = words(texts)
    return *shingle_hashes(w, word_hashes(w, lower=True), k), w


def _apart(a1, a2, b1, b2) -> np.ndarray:
    return (np.bitwise_count((a1 ^ b1).view(np.uint64)).astype(np.int16)
            + np.bitwise_count((a2 ^ b2).view(np.uint64)))


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [np.asarray(batch.column(n)) for n in names]


_ROWS = "tree int, high long, low long, id long, s1 long, s2 long"


def in_company(rows: DataFrame) -> DataFrame:
    """The rows (tree, high, low, id, s1, s2) whose (tree, high) another row has.

    Rows are sorted by range, so that a region of any size is spread over
    tasks; rows at a task's edges are kept without having been compared."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, wanted = None, True  # the last row, and whether it is kept in any case
        for b in batches:
            if not b.num_rows:
                continue
            b = _after(held, b)
            tree, high = _columns(b, "tree", "high")
            same = (tree[1:] == tree[:-1]) & (high[1:] == high[:-1])
            keep = np.append(same, False) | np.append(wanted, same)
            held, wanted = b.slice(b.num_rows - 1), bool(keep[-1])
            yield b.take(pa.array(np.flatnonzero(keep[:-1])))
        if held is not None:
            yield held

    ordered = (rows.repartitionByRange("tree", "high", "low", "id")
               .sortWithinPartitions("tree", "high", "low", "id"))
    return saved(ordered.mapInArrow(kept, _ROWS), "company")


def _after(held: pa.RecordBatch | None, b: pa.RecordBatch) -> pa.RecordBatch:
    if held is None or not held.num_rows:
        return b
    return pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n places the least one that the edges a-b connect it with."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _edges(ident: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(ident != ident[label])
    return pa.RecordBatch.from_arrays(
        [pa.array(ident[label[some]]), pa.array(ident[some])], ["a", "b"])


def candidate_groups(company: DataFrame, most_apart: int, region: int = REGION) -> DataFrame:
    """(id, component): groups outside of which there is no candidate."""
    ordered = (company.repartition("tree", "high")
               .sortWithinPartitions("tree", "high", "low", "id"))
    return components(ordered.mapInArrow(
        lambda batches: _candidates(batches, most_apart, region), "a long, b long"))


def _candidates(batches: Iterator[pa.RecordBatch], most_apart: int, region: int,
                ) -> Iterator[pa.RecordBatch]:
    """Edges of sorted rows: by sketches in regions of up to ``region`` rows, of
    each row with the one before it in larger ones."""
    held, large = None, False  # the last part of a region, and whether others came before it
    for b in batches:
        b = _after(held, b)
        if not b.num_rows:
            continue
        part, later = _parts(b, region)
        n = int(np.flatnonzero(part == part[-1])[0])
        held = b.slice(n)
        if n:
            yield _region_edges(b.slice(0, n), part[:n], later[:n],
                                _whole(part, later, large)[:n], most_apart)
            large = bool(later[n])
        if large and n:
            ident = np.asarray(b.column("id"))[n - 1:n + 1]
            yield _edges(ident, np.zeros(2, np.int64))
    if held is not None and held.num_rows:
        part, later = _parts(held, region)
        yield _region_edges(held, part, later, _whole(part, later, large), most_apart)


def _parts(b: pa.RecordBatch, region: int) -> tuple[np.ndarray, np.ndarray]:
    """Regions in parts of ``region`` rows: each row's part, counted from 0, and
    whether it begins a part other than the first of its region."""
    tree, high = _columns(b, "tree", "high")
    new = np.append(True, (tree[1:] != tree[:-1]) | (high[1:] != high[:-1]))
    place = np.arange(len(new))
    within = place - np.maximum.accumulate(np.where(new, place, 0))
    later = ~new & (within % region == 0)
    return np.cumsum(new | later) - 1, later


def _whole(part: np.ndarray, later: np.ndarray, large: bool) -> np.ndarray:
    """Whether each row's region has several parts; large: that of the first row has."""
    several = np.zeros(part[-1] + 1, bool)
    several[0] = large
    after = part[later]
    several[after] = several[after - 1] = True
    return several[part]


def _region_edges(b: pa.RecordBatch, part: np.ndarray, later: np.ndarray, whole: np.ndarray,
                  most_apart: int) -> pa.RecordBatch:
    ident, s1, s2 = _columns(b, "id", "s1", "s2")
    # rows of a larger region with the one before, over the parts' borders as well
    right = np.flatnonzero(whole[1:] & ((part[1:] == part[:-1]) | later[1:])) + 1
    left, right = [right - 1], [right]
    size = int(np.bincount(part[~whole]).max()) if not whole.all() else 0
    for d in range(1, size):
        a = np.flatnonzero((part[d:] == part[:-d]) & ~whole[d:])
        a = a[_apart(s1[a], s2[a], s1[a + d], s2[a + d]) <= most_apart]
        left.append(a)
        right.append(a + d)
    return _edges(ident, _spanning(np.concatenate(left), np.concatenate(right), len(ident)))


def shared(sets: list[np.ndarray], first: int) -> np.ndarray:
    """Sizes of the intersections of the first sets with all (first: how many)."""
    h = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, count = np.unique(h, return_inverse=True, return_counts=True)
    often = count > 1  # the others are in no intersection
    number = np.cumsum(often) - 1
    row, column = row[often[column]], number[column[often[column]]]
    out = np.zeros((first, len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, int(often.sum()), COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        held = np.zeros((len(sets), min(COLUMNS, int(often.sum()) - low)), np.float32)
        held[row[a:b], column[a:b] - low] = 1
        out += held[:first] @ held.T
    np.fill_diagonal(out[:, :first], [len(x) for x in sets[:first]])
    return out


def _links(sets: list[np.ndarray], first: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of linked sets, a among the first ones."""
    size = np.array([len(x) for x in sets], np.int64)
    both = shared(sets, first).astype(np.int64)
    a, b = np.nonzero(100 * both >= percent * (size[:first, None] + size[None, :] - both))
    return a, b


def _arrays(b: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in b.column("set").to_pylist()]


def _runs(sets: DataFrame, percent: int, run_rows: int) -> DataFrame:
    """Links within runs of a group's rows: (component, id, size, root, run)."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done, held = TaskContext.get().partitionId(), 0, None

        def out(b: pa.RecordBatch) -> pa.RecordBatch:
            label = _spanning(*_links(_arrays(b), b.num_rows, percent), b.num_rows)
            ident = np.asarray(b.column("id"))
            return pa.RecordBatch.from_arrays(
                [b.column("component"), b.column("id"), b.column("size"), pa.array(ident[label]),
                 pa.array(np.full(b.num_rows, task << 32 | done))],
                ["component", "id", "size", "root", "run"])

        for b in batches:
            b = _after(held, b)
            if not b.num_rows:
                continue
            group = np.asarray(b.column("component"))
            cut = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, b.num_rows)
            size = np.concatenate([[0], np.cumsum(_columns(b, "size")[0])])
            at = 0
            for end in cut.tolist():
                while at < end:
                    fits = int(np.searchsorted(size, size[at] + MOST_SHINGLES, "right")) - 1 - at
                    n = max(1, min(run_rows, fits, end - at))
                    if end == b.num_rows and n == end - at:
                        break  # it may go on in the next batch
                    yield out(b.slice(at, n))
                    at, done = at + n, done + 1
            held = b.slice(at)
        if held is not None and held.num_rows:
            yield out(held)

    ordered = (sets.repartitionByRange("component", "k1", "k2", "id")
               .sortWithinPartitions("component", "k1", "k2", "id"))
    return saved(ordered.select("component", "id", "size", "set").mapInArrow(
        compared, "component long, id long, size long, root long, run long"), "runs")


def _cells(found: DataFrame, parts: DataFrame, block_rows: int) -> DataFrame:
    """(component, id, i, j, own): pairs of blocks that are left to compare, of
    groups in several runs and components. ``i`` and ``j`` number the blocks."""
    unsettled = found.groupBy("component").agg(
        F.min("run").alias("low"), F.max("run").alias("high")).where("low < high").select("component")
    rows = (found.select("component", "id", "size").join(unsettled, "component", "left_semi")
            .join(parts.select("id", F.col("component").alias("part")), "id", "left")
            .withColumn("part", F.coalesce("part", "id")))
    rows = saved(rows, "unsettled")
    # blocks that a set of rows fills, by their number or their shingles
    size = rows.groupBy("component", "part").agg(F.greatest(
        F.count("*") / block_rows, F.sum("size") / MOST_SHINGLES).alias("fills"))
    small = size.where("fills < 1").groupBy("component").agg(F.ceil(F.sum("fills")).alias("blocks"))
    large = size.where("fills >= 1").select("component", "part",
                                            F.ceil("fills").alias("own_blocks"))
    # a large component has blocks of its own; small ones are dealt out whole
    number = F.when(F.col("own_blocks").isNotNull(),
                    F.pmod(F.xxhash64("id"), F.col("own_blocks"))).otherwise(
        F.pmod(F.xxhash64("part"), F.col("blocks")))
    placed = (rows.join(large, ["component", "part"], "left").join(small, "component", "left")
              .select("component", "id",
                      F.when(F.col("own_blocks").isNotNull(), F.col("part")).alias("whole"),
                      number.alias("number")))
    placed = saved(placed, "placed")
    one = placed.select("component", "whole", "number").distinct()
    a = one.select("component", *[F.col(c).alias(f"{c}_a") for c in ("whole", "number")])
    b = one.select("component", *[F.col(c).alias(f"{c}_b") for c in ("whole", "number")])
    key = lambda x: F.struct(F.coalesce(F.col(f"whole_{x}"), F.lit(-1).cast("long")),
                             F.col(f"whole_{x}").isNull(), F.col(f"number_{x}"))
    cells = (a.join(b, "component").where(key("a") <= key("b"))
             .where(F.coalesce(F.col("whole_a") != F.col("whole_b"), F.lit(True)))
             .withColumn("cell", F.xxhash64("component", "whole_a", "number_a", F.col(
                 "whole_a").isNull(), "whole_b", "number_b", F.col("whole_b").isNull())))
    cells = saved(cells, "cells")
    same = lambda x: [placed["component"] == cells["component"],
                      placed["whole"].eqNullSafe(cells[f"whole_{x}"]),
                      placed["number"] == cells[f"number_{x}"]]
    left = placed.join(cells, same("a")).select("cell", "id", F.lit(0).alias("side"))
    right = (placed.join(cells.where(key("a") != key("b")), same("b"))
             .select("cell", "id", F.lit(1).alias("side")))
    return left.union(right)


def _across(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) found by comparing the blocks of each cell."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            b = _after(held, b)
            if not b.num_rows:
                continue
            cell = np.asarray(b.column("cell"))
            cut = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist()]
            for at, end in zip(cut, cut[1:]):
                yield _compared(b.slice(at, end - at), percent)
            held = b.slice(cut[-1])
        if held is not None and held.num_rows:
            yield _compared(held, percent)

    rows = cells.join(sets.select("id", "set"), "id").select("cell", "side", "id", "set")
    return (rows.repartition("cell").sortWithinPartitions("cell", "side", "id")
            .mapInArrow(compared, "a long, b long"))


def _compared(b: pa.RecordBatch, percent: int) -> pa.RecordBatch:
    ident, side = _columns(b, "id", "side")
    first = int((side == 0).sum())
    label = _spanning(*_links(_arrays(b), first, percent), b.num_rows)
    return _edges(ident, label)


def _sets(texts: DataFrame, k: int) -> DataFrame:
    """(component, id, k1, k2, size, set) of texts (component, id, text): the
    distinct shingles as ascending 64-bit numbers, the two least, their number."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch):
                h, owner, _ = shingles(b.column("text"), k)
                h, owner = _own(h, owner)
                begin = np.searchsorted(owner, np.arange(b.num_rows + 1))
                held = pa.BinaryArray.from_buffers(
                    pa.binary(), b.num_rows,
                    [None, pa.py_buffer((8 * begin).astype(np.int32)), pa.py_buffer(h)])
                least = [np.append(h, np.uint64(0))[np.minimum(begin[:-1] + i, len(h))].view(np.int64)
                         for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("component"), b.column("id"), *map(pa.array, least),
                     pa.array(np.diff(begin)), held],
                    ["component", "id", "k1", "k2", "size", "set"])

    return saved(texts.select("component", "id", "text").mapInArrow(
        made, "component long, id long, k1 long, k2 long, size long, set binary"), "sets")


def _own(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ascending."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))[:len(h)]
    return h[keep], owner[keep]


def linked(rows: DataFrame, texts_of: Callable[[DataFrame], DataFrame], k: int, percent: int,
           most_apart: int = MOST_APART, run_rows: int = RUN_ROWS,
           block_rows: int = BLOCK_ROWS, region: int = REGION) -> DataFrame:
    """(id, component) of all nodes that have a link.

    rows: (tree, high, low, id, s1, s2); texts_of: gives (component, id, text)
    for a table of (component, id)."""
    groups = saved(candidate_groups(in_company(rows), most_apart, region), "groups")
    sets = _sets(texts_of(groups), k)
    found = _runs(sets, percent, run_rows)
    links = found.where("id <> root").select(F.col("root").alias("a"), F.col("id").alias("b"))
    parts = saved(components(links), "components")
    cells = saved(_cells(found, parts, block_rows), "cell-rows")
    if cells.isEmpty():
        return parts
    return saved(components(links.union(_across(cells, sets, percent))), "components")
