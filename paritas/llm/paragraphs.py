"""Substring dedup: near-equal paragraphs by MinHash banding, repeated passages by content.

Two kinds of paragraphs are compared. Lines of at least 24 words are near
copies of each other if their sets of 5-word runs have a Jaccard similarity of
0.8 or more: eight bands of three MinHash values bring candidates together
(a pair at 0.8 is missed by all with probability (1 - 0.8**3)**8 = 0.3 per
cent, at 0.9 with 3e-5), sets are verified in full, and links give connected
components. Passages that stand inside other text have no borders of their
own, so content sets them: in every 24 successive 5-word runs the one with the
least hash begins a paragraph of 24 words. Any run of 51 words that two texts
share holds such a paragraph in both, and those are compared for equality.
Shorter shared passages inside lines, and edited ones, are found only where a
paragraph happens to lie in an unedited part.

Clusters within one document alone are left to the rules on repetition. In
each other cluster the copy with the smallest (doc_id, start) stays; the others are
removals. Overlapping spans of a document are merged.

Edge cases: null, empty and shorter texts have no paragraphs; a null
``doc_id`` takes no part, as it cannot be told from others. Rows repeated with
one ``doc_id`` are one document. An empty table gives an empty
result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paritas.llm.common import documents, mixed, saved, slices, word_hashes, words
from paritas.llm.near import digests, in_company, linked, signatures, sketches

RUN = 5
PERCENT = 80
#: Lines of fewer words are compared as parts of the text around them only.
LINE_WORDS = 24
BANDS, BAND_VALUES = 8, 3
#: Words of a content-set paragraph, and runs of which one begins one.
BLOCK_WORDS, CHOICE = 24, 24
LINE, BLOCK = 0, 1

_STEP = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)


def _sliding(values: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """pick over each n successive values."""
    width = 1
    while 2 * width <= n:
        values = pick(values[:-width], values[width:])
        width *= 2
    return pick(values[:len(values) - (n - width)], values[n - width:])


def _runs(h: np.ndarray) -> np.ndarray:
    """A hash of each RUN successive words."""
    n = max(0, len(h) - RUN + 1)
    out = np.zeros(n, np.uint64)
    for j in range(RUN):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[j:n + j]
    return mixed(out)


def _chosen(runs: np.ndarray) -> np.ndarray:
    """Places whose run has the least hash of CHOICE successive ones."""
    if len(runs) < CHOICE:
        return np.zeros(0, np.int64)
    least = _sliding(runs, CHOICE, np.minimum)
    most = np.zeros(len(runs) + CHOICE - 1, np.uint64)
    most[CHOICE - 1:CHOICE - 1 + len(least)] = least
    # the largest of the minima of all stretches that hold the place
    out = _sliding(most, CHOICE, np.maximum) == runs
    out[1:] &= runs[1:] != runs[:-1]  # of a word said again and again, the first
    return np.flatnonzero(out)


def _sequence_digest(h: np.ndarray, at: np.ndarray, n: int, step: int) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for j in range(n):
        out = out * np.uint64(step) + h[at + j]
    return mixed(out).view(np.int64)


_KIND = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()),
                   ("end", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                   ("bands", pa.binary()), ("s1", pa.int64()), ("s2", pa.int64())])


def _paragraphs(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    w = words(b.column("text"))
    h = word_hashes(w, lower=True)
    if len(h) < RUN:
        return
    lead = np.concatenate([[0], np.cumsum((w.buf & 0xC0) != 0x80)])
    start = lead[w.start] - lead[w.offsets[w.doc]]
    end = lead[w.end] - lead[w.offsets[w.doc]]
    ident = np.asarray(b.column("doc_id"))
    runs = _runs(h)
    # content-set paragraphs
    at = _chosen(runs)
    at = at[at + BLOCK_WORDS <= len(h)]
    at = at[w.doc[at] == w.doc[at + BLOCK_WORDS - 1]]
    none = pa.nulls(len(at), pa.int64())
    yield pa.RecordBatch.from_arrays([
        pa.array(np.full(len(at), BLOCK, np.int32)), pa.array(ident[w.doc[at]]),
        pa.array(start[at]), pa.array(end[at + BLOCK_WORDS - 1]),
        *(pa.array(_sequence_digest(h, at, BLOCK_WORDS, s)) for s in _STEP),
        pa.nulls(len(at), pa.binary()), none, none], schema=_KIND)
    # lines
    breaks = np.concatenate([[0], np.cumsum(w.buf == 10)])[w.start]
    new = np.append(True, (breaks[1:] != breaks[:-1]) | (w.doc[1:] != w.doc[:-1]))
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(h)))
    first, size = first[size >= LINE_WORDS], size[size >= LINE_WORDS]
    if not len(first):
        return
    n = size - RUN + 1
    owner = np.repeat(np.arange(len(first)), n)
    own = runs[np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)]
    signature = signatures(own, owner, len(first), 128)
    s1, s2 = sketches(signature)
    _, d1, d2 = digests(own, owner, len(first))
    bands = np.zeros((len(first), BANDS), np.uint64)
    for j in range(BAND_VALUES):
        bands = bands * np.uint64(_STEP[0]) + signature[:, j:BANDS * BAND_VALUES:BAND_VALUES]
    bands = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(8 * BANDS), len(first), [None, pa.py_buffer(mixed(bands))]).cast(pa.binary())
    yield pa.RecordBatch.from_arrays([
        pa.array(np.full(len(first), LINE, np.int32)), pa.array(ident[w.doc[first]]),
        pa.array(start[first]), pa.array(end[first + size - 1]), pa.array(d1), pa.array(d2),
        bands, pa.array(s1), pa.array(s2)], schema=_KIND)


def paragraphs(docs: DataFrame) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch):
                yield from _paragraphs(b)

    return documents(docs).where("doc_id IS NOT NULL").mapInArrow(
        cut, "kind int, doc_id long, start long, end long, d1 long, d2 long, bands binary, "
             "s1 long, s2 long")


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = np.frombuffer(b"".join(b.column("bands").to_pylist()), np.int64)
        again = {c: np.repeat(np.asarray(b.column(c)), BANDS) for c in ("id", "s1", "s2")}
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.tile(np.arange(BANDS, dtype=np.int32), b.num_rows)), pa.array(keys),
             *(pa.array(again[c]) for c in ("s1", "id", "s1", "s2"))],
            ["tree", "high", "low", "id", "s1", "s2"])


def _near_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(d1, d2, group) of lines that have a near copy."""
    sets = saved(lines.groupBy("d1", "d2").agg(
        F.first("bands").alias("bands"), F.first("s1").alias("s1"), F.first("s2").alias("s2"),
        F.min(F.struct("doc_id", "start", "end")).alias("at")), "lines")
    rows = sets.select(F.col("d1").alias("id"), "bands", "s1", "s2").mapInArrow(
        _bands, "tree int, high long, low long, id long, s1 long, s2 long")
    texts = documents(docs)

    def texts_of(ids: DataFrame) -> DataFrame:
        at = sets.select(F.col("d1").alias("id"), "at.*").join(ids, "id")
        part = F.substring(F.col("text"), F.col("start") + 1, F.col("end") - F.col("start"))
        return texts.join(at.hint("merge"), "doc_id").select("component", "id", part.alias("text"))

    found = linked(rows, texts_of, RUN, PERCENT)
    return sets.join(found, F.col("d1") == F.col("id")).select(
        "d1", "d2", F.col("component").alias("group"))


def repeats(docs: DataFrame) -> DataFrame:
    """Spans that repeat: doc_id, start, end (code points), first_doc_id, kept.

    ``kept`` spans are the first copies, the others are to be removed;
    ``first_doc_id`` is the smallest document that holds a copy."""
    found = saved(paragraphs(docs), "paragraphs")
    lines = found.where(F.col("kind") == LINE)
    near = saved(_near_lines(docs, lines), "near-lines")
    # equal paragraphs of both kinds; the sorted order brings equal digests together
    company = in_company(found.select(
        F.col("kind").alias("tree"), F.col("d1").alias("high"), F.col("d2").alias("low"),
        F.col("doc_id").alias("id"), F.col("start").alias("s1"), F.col("end").alias("s2")))
    equal = company.select(F.col("tree").alias("kind"), F.col("high").alias("d1"),
                           F.col("low").alias("d2"), F.col("id").alias("doc_id"),
                           F.col("s1").alias("start"), F.col("s2").alias("end"))
    similar = lines.select("kind", "doc_id", "start", "end", "d1", "d2").join(near, ["d1", "d2"])
    key = ["kind", "d1", "d2"]
    grouped = similar.select(F.lit(2).alias("kind"), F.col("group").alias("d1"),
                             F.lit(0).cast("long").alias("d2"), "doc_id", "start", "end")
    members = saved(equal.select(*key, "doc_id", "start", "end").unionByName(grouped), "members")
    first = members.groupBy(*key).agg(
        F.min(F.struct("doc_id", "start")).alias("first"), F.max("doc_id").alias("last"),
    ).where("first.doc_id < last").drop("last")
    spans = members.join(first, key).select(
        "doc_id", "start", "end", F.col("first.doc_id").alias("first_doc_id"),
        ((F.col("doc_id") == F.col("first.doc_id")) & (F.col("start") == F.col("first.start")))
        .alias("kept")).distinct()
    before = (Window.partitionBy("doc_id", "kept").orderBy("start", "end")
              .rowsBetween(Window.unboundedPreceding, -1))
    upto = (Window.partitionBy("doc_id", "kept").orderBy("start", "end")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    opens = F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int")
    return (spans.withColumn("opens", opens).withColumn("number", F.sum("opens").over(upto))
            .groupBy("doc_id", "kept", "number")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                 F.min("first_doc_id").alias("first_doc_id"))
            .select("doc_id", "start", "end", "first_doc_id", "kept"))


def without_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the removals cut out of ``text``."""
    cuts = (spans.where("NOT kept").groupBy(F.col("doc_id").alias("_doc"))
            .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_cuts")))

    @F.arrow_udf("string")
    def rest(texts: pa.Array, cut: pa.Array) -> pa.Array:
        out = []
        for text, some in zip(texts.to_pylist(), cut.to_pylist()):
            at, parts = 0, []
            for c in some or ():
                parts.append(text[at:max(at, c["start"])])
                at = max(at, c["end"])
            out.append(text if not some else "".join(parts) + text[at:])
        return pa.array(out, pa.string())

    joined = docs.join(cuts, F.col("doc_id") == F.col("_doc"), "left")
    return joined.withColumn("text", rest(F.col("text"), F.col("_cuts"))).select(*docs.columns)
