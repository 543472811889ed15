"""MinHash near-duplicate groups by an LSH forest.

A text's set holds its distinct runs of k words (all of its words as one run
if they are fewer). Texts with equal sets are one node. The forest is a number
of trees, each a sorted order of the nodes by eight MinHash values. Candidates
have the first four values of a tree in common and sketches that leave a chance
of a link: a prefix of fixed depth with sketches stands in for the neighbours
of longest common prefix, whose depth would adapt to how dense a region is. The
other four values only sort what shares a prefix. Candidates are joined into
groups; links are computed there on full sets, and give connected components
(see ``near``).

With 20 trees and a prefix of four values, a pair with Jaccard similarity 0.8
shares no region with probability (1 - 0.8**4)**20 = 3e-5.

Edge cases: a text that is null, empty or without words has an empty set, is
linked with nothing and kept. Rows with the same ``doc_id`` are one document:
they share their links. A null ``doc_id`` gets a null component and is kept,
as no row can stand for it. An empty table gives an empty result. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import documents, saved, slices
from paritas.llm.near import digests, linked, packed, shingles, signatures, sketches

TREES, DEPTH = 20, 8
PERCENT = 80


def _nodes(docs: DataFrame, k: int) -> DataFrame:
    """Each document with its set's size and digest, its signature and sketch."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch):
                h, owner, _ = shingles(b.column("text"), k)
                n, d1, d2 = digests(h, owner, b.num_rows)
                signature = signatures(h, owner, b.num_rows, TREES * DEPTH)
                s1, s2 = sketches(signature)
                keys = packed(signature.reshape(b.num_rows, TREES * 2, 4))
                keys = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(TREES * 16), b.num_rows,
                    [None, pa.py_buffer(np.ascontiguousarray(keys))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(n), pa.array(d1), pa.array(d2), keys,
                     pa.array(s1), pa.array(s2)],
                    ["doc_id", "n_shingles", "d1", "d2", "keys", "s1", "s2"])

    return saved(documents(docs).mapInArrow(
        signed, "doc_id long, n_shingles long, d1 long, d2 long, keys binary, s1 long, s2 long"),
        "signatures")


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = np.frombuffer(b"".join(b.column("keys").to_pylist()), np.int64).reshape(-1, TREES, 2)
        again = lambda c: pa.array(np.repeat(np.asarray(b.column(c)), TREES))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.tile(np.arange(TREES, dtype=np.int32), b.num_rows)),
             pa.array(keys[:, :, 0].ravel()), pa.array(keys[:, :, 1].ravel()),
             again("id"), again("s1"), again("s2")], ["tree", "high", "low", "id", "s1", "s2"])


def groups(docs: DataFrame, k: int = 2, percent: int = PERCENT, **sizes: int) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept.

    sizes: those of runs, blocks and regions, see ``near.linked``."""
    nodes = _nodes(docs, k)
    one = ["n_shingles", "d1", "d2"]
    sets = (nodes.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*one)
            .agg(F.min("doc_id").alias("id"), F.first("keys").alias("keys"),
                 F.first("s1").alias("s1"), F.first("s2").alias("s2")))
    sets = saved(sets, "sets")
    texts = documents(docs).withColumnRenamed("doc_id", "id")
    rows = sets.select("id", "keys", "s1", "s2").mapInArrow(
        _trees, "tree int, high long, low long, id long, s1 long, s2 long")
    parts = linked(rows, lambda ids: texts.join(ids.hint("merge"), "id"), k, percent, **sizes)
    # sets whose smallest document is the same are one document's
    parts = sets.select(*one, "id").join(parts, "id", "left").select(
        *one, F.coalesce("component", "id").alias("component"))
    out = (nodes.select("doc_id", *one).join(parts, one, "left")
           .withColumn("component_id", F.when(F.col("doc_id").isNull(), None).otherwise(
               F.coalesce("component", "doc_id"))))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(
        F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
