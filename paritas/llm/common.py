"""Helpers the corpus operators share: tables in the shared folder, text batches, words."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task's Python code turns into numpy arrays at once.
SLICE_BYTES = 2 << 20

#: The six ASCII white-space bytes that part words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Maps A-Z to a-z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="corpus-"))
        base = context.getCheckpointDir()
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage,
    survives lost executors, and later steps do not compute it again."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def documents(docs: DataFrame) -> DataFrame:
    """The two columns the operators read; a missing text is an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def slices(batch: pa.RecordBatch, column: str = "text",
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows holding about ``most`` bytes of ``column`` (one row at least)."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    total = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + most, side="right")))
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()  # the worker stays for later stages


def byte_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts end to end, and where each begins (one more than texts)."""
    lengths = np.asarray(pc.binary_length(texts), dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    data = texts.cast(pa.large_binary())
    buf = np.frombuffer(data.buffers()[2], np.uint8) if offsets[-1] else np.zeros(0, np.uint8)
    first = int(np.frombuffer(data.buffers()[1], np.int64)[data.offset]) if len(data) else 0
    return buf[first:first + offsets[-1]], offsets


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' code points end to end, and where each text begins (one more than texts)."""
    buf, offsets = byte_buffer(texts)
    lead = (buf & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(lead)])
    points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, before[offsets]


@dataclass
class Words:
    """Words of a run of texts: byte ranges in ``buf`` and the text each belongs to."""

    buf: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Index of each text's first word (one more entry than texts)."""
        return np.searchsorted(self.doc, np.arange(len(self.offsets)))


def words(texts: pa.Array) -> Words:
    buf, offsets = byte_buffer(texts)
    if not len(buf):
        none = np.zeros(0, np.int64)
        return Words(buf, offsets, none, none, none)
    space = SPACE[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[offsets] = True
    after = cut.copy()
    after[1:] |= space
    before = cut
    before[:-1] |= space
    start = np.flatnonzero(~space & after[:-1])
    end = np.flatnonzero(~space & before[1:]) + 1
    return Words(buf, offsets, start, end, np.searchsorted(offsets, start, side="right") - 1)


_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers; not kept, as they would take 16 bytes for each byte of a slice."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        np.multiply.accumulate(out, out=out)
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (each input bit reaches each output bit)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(w: Words, lower: bool = False) -> np.ndarray:
    """A 64-bit number for each word, equal for equal words."""
    if not len(w.start):
        return np.zeros(0, np.uint64)
    n = len(w.buf)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[LOWER[w.buf] if lower else w.buf] * _powers(_BASE, n), out=total[1:])
    return mixed((total[w.end] - total[w.start]) * _powers(_UNBASE, n)[w.start])


def shingle_hashes(w: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words and the text of each; a text of fewer
    words, but at least one, gives its whole sequence as one run."""
    first = w.first
    count = np.diff(first)
    n = len(h)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out[:n - j] = out[:n - j] * np.uint64(0xD6E8FEB86659FD93) + h[j:] if j else h
    # runs that begin in a text's last k - 1 words would reach into the next text
    keep = np.ones(n, bool)
    for j in range(1, k):
        last = first[1:] - j
        keep[last[(last >= first[:-1]) & (count >= 1)]] = False
    short = np.flatnonzero((count > 0) & (count < k))
    for d in short:
        v = 0
        for j in range(first[d], first[d + 1]):
            v = (v * 0xD6E8FEB86659FD93 + int(h[j])) & (2**64 - 1) if j > first[d] else int(h[j])
        out[first[d]] = (v + int(count[d]) * 0xA0761D6478BD642F) & (2**64 - 1)
        keep[first[d]] = True
    return mixed(out[keep]), w.doc[keep]
