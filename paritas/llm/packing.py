"""Packing documents into token sequences by fitted length patterns.

Documents are tokenized, an end id follows each, and those longer than a
sequence are cut into whole sequences and a rest. Everything that decides the
packing is the histogram of piece lengths, which has at most one bin for each
length: patterns of up to four binned lengths that fill a sequence are
enumerated, non-negative least squares fits how often each is used to the
histogram, the fit is rounded down, and the last place of a used pattern goes
to the longest piece that still fits. The residual is packed best fit, longest
first, into what is left open and into new sequences. All of this works on
(length, count) runs, so its cost does not grow with the corpus.

Pieces of equal length are interchangeable: Spark ranks them, spread over
parts so that a length which a third of all pieces share is ranked by many
tasks, and each piece looks up its rank's place in the plan.

Edge cases: a null or empty text is its end id alone. Null or repeated
``doc_id`` values are kept, each row packed on its own. An empty table gives
an empty result. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paritas.llm.common import documents, saved, slices
from paritas.llm.tokens import TOKEN_SLICE, word_tokens

SIZE = 4096
#: Bins of piece lengths in patterns, and the pieces a pattern has at most.
BINS, MOST_PARTS = 64, 4
#: Parts that pieces of one length are ranked in.
RANK_PARTS = 64


@dataclass
class Plan:
    """Run i holds the pieces of ``length[i]`` with ranks from ``rank[i]`` on, up
    to the next run of that length: the first goes to ``sequence[i]`` at
    ``offset[i]``, the next to the sequence after it, and so on."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        most = int(max(self.rank.max(initial=0), rank.max(initial=0))) + 1
        run = np.searchsorted(self.length * most + self.rank, length * most + rank, "right") - 1
        return self.sequence[run] + rank - self.rank[run], self.offset[run]


def patterns(bins: int = BINS, parts: int = MOST_PARTS) -> np.ndarray:
    """All ways to fill ``bins`` with up to ``parts`` bin sizes, a column each."""
    out = []
    for n in range(1, parts + 1):
        for some in combinations_with_replacement(range(1, bins), n - 1):
            rest = bins - sum(some)
            if rest >= (some[-1] if some else 1):
                out.append((*some, rest))
    matrix = np.zeros((bins + 1, len(out)))
    for j, some in enumerate(out):
        for s in some:
            matrix[s, j] += 1
    return matrix


def fitted(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 with the least squared error of a @ x - b (active sets, after
    Lawson and Hanson)."""
    x = np.zeros(a.shape[1])
    used: list[int] = []
    scale = max(1.0, np.abs(b).max())
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[used] = -np.inf
        j = int(slope.argmax())
        if slope[j] <= 1e-9 * scale:
            break
        used.append(j)
        while used:
            z = np.linalg.lstsq(a[:, used], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[used] = z
                break
            now = x[used]
            low = z <= 0
            step = (now[low] / np.maximum(now[low] - z[low], 1e-300)).min()
            now = now + step * (z - now)
            gone = low & (now <= 1e-9 * scale)
            if not gone.any():
                gone = low & (now <= now[low].min())
            x[:] = 0
            x[used] = np.maximum(now, 0)
            x[[u for u, g in zip(used, gone) if g]] = 0
            used = [u for u, g in zip(used, gone) if not g]
    return x


class _Packer:
    """Lays (length, count) runs out; sequences are numbered as they are opened."""

    def __init__(self, counts: np.ndarray, size: int) -> None:
        self.left = counts.copy()
        self.rank = np.zeros_like(counts)
        self.size = size
        self.sequences = 0
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # room -> (first, n)
        self.runs: list[tuple[int, int, int, int]] = []

    def put(self, length: int, n: int, first: int, room: int) -> None:
        """The next n pieces of that length into n sequences, each with that room."""
        self.runs.append((length, int(self.rank[length]), first, self.size - room))
        self.rank[length] += n
        self.left[length] -= n

    def new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def longest(self, most: int) -> int:
        """The longest length up to ``most`` of which pieces are left, or 0."""
        some = np.flatnonzero(self.left[1:most + 1])
        return int(some[-1]) + 1 if len(some) else 0

    def follow(self, pattern: list[int], times: int, unit: int) -> None:
        """Uses a pattern (bins, largest first) as often as pieces of all its bins last."""
        while times > 0:
            lengths: list[int] = []
            for b in pattern[:-1]:
                low, high = (b - 1) * unit + 1, b * unit
                some = np.flatnonzero(
                    self.left[low:high + 1] > [lengths.count(x) for x in range(low, high + 1)])
                if not len(some):
                    return
                lengths.append(low + int(some[-1]))
            room = self.size - sum(lengths)
            spare = self.left.copy()
            for x in lengths:
                spare[x] -= 1
            some = np.flatnonzero(spare[1:room + 1])
            if not len(some) or some[-1] + 1 <= (pattern[-1] - 1) * unit:
                return  # its last bin is used up
            lengths.append(int(some[-1]) + 1)
            kinds = {x: lengths.count(x) for x in lengths}
            n = min(times, *(int(self.left[x]) // c for x, c in kinds.items()))
            first, room = self.new(n), self.size
            for x in lengths:
                self.put(x, n, first, room)
                room -= x
            self.open[room].append((first, n))
            times -= n

    def best_fit(self) -> None:
        """Packs all that is left, longest first, where the least room remains."""
        rooms = np.array([bool(x) for x in self.open])
        for length in range(self.size, 0, -1):
            while self.left[length]:
                n = int(self.left[length])
                fits = np.flatnonzero(rooms[length:])
                if len(fits):
                    room = length + int(fits[0])
                    first, have = self.open[room].pop()
                    if have > n:
                        self.open[room].append((first + n, have - n))
                    rooms[room] = bool(self.open[room])
                    n = min(n, have)
                    self.put(length, n, first, room)
                    self.open[room - length].append((first, n))
                    rooms[room - length] = True
                else:
                    each = self.size // length
                    full, rest = divmod(n, each)
                    for many, count in ((each, full), (rest, 1)):
                        if many and count:
                            first, room = self.new(count), self.size
                            for _ in range(many):
                                self.put(length, count, first, room)
                                room -= length
                            self.open[room].append((first, count))
                            rooms[room] = True


def planned(counts: np.ndarray, size: int = SIZE, bins: int = BINS) -> Plan:
    """counts[n]: pieces of length n, for n up to ``size``."""
    p = _Packer(counts.astype(np.int64), size)
    if p.left[size]:
        n = int(p.left[size])
        p.put(size, n, p.new(n), size)
    unit = max(1, -(-size // bins))
    top = -(-size // unit)
    binned = np.bincount(-(-np.arange(size + 1) // unit), weights=p.left, minlength=top + 1)
    if binned.sum() > 0:
        a = patterns(top)
        x = np.floor(fitted(a, binned))
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 1:
                break
            parts = np.repeat(np.arange(top + 1), a[:, j].astype(int))[::-1]
            if len(parts) > 1:
                p.follow(parts.tolist(), int(x[j]), unit)
    p.best_fit()
    runs = np.array(sorted(p.runs), np.int64).reshape(-1, 4)
    return Plan(*runs.T, p.sequences)


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int = SIZE) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32."""
    kind = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                      ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokens(tokenizer)
        for batch in batches:
            for b in slices(batch, most=TOKEN_SLICE):
                ids, at = encoder.encode(b.column("text"), end_id)
                data = memoryview(ids.astype("<u4").tobytes())
                n = -(-np.diff(at) // size)
                row = np.repeat(np.arange(b.num_rows), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * size
                length = np.minimum(np.diff(at)[row] - start, size)
                begin = 4 * (at[row] + start)
                crc = [zlib.crc32(data[s:e]) for s, e in zip(
                    begin.tolist(), (begin + 4 * length).tolist())]
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)),
                    pa.array(start), pa.array(length), pa.array(crc, pa.int64())], schema=kind)

    return documents(docs).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str, end_id: int, size: int = SIZE) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset`` (place in the sequence, gapless from 0)."""
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(RANK_PARTS)).cast("int")
    cut = saved(pieces(docs, tokenizer, end_id, size).withColumn("part", part), "pieces")
    counts = cut.groupBy("length", "part").count()
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = saved(counts.withColumn("ahead", F.coalesce(F.sum("count").over(ahead), F.lit(0)))
                   .withColumnsRenamed({"length": "_length", "part": "_part"}), "piece-counts")
    histogram = np.zeros(size + 1, np.int64)
    for r in counts.groupBy("_length").agg(F.sum("count").alias("n")).collect():  # size rows at most
        histogram[r["_length"]] = r["n"]
    plan = planned(histogram, size)
    kind = pa.schema([("sequence_id", pa.int64()), ("offset", pa.int64())])

    @F.arrow_udf("sequence_id long, offset long")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        sequence, offset = plan.places(np.asarray(length), np.asarray(rank))
        return pa.RecordBatch.from_arrays([pa.array(sequence), pa.array(offset)],
                                          schema=kind).to_struct_array()

    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    # counts has at most size x RANK_PARTS rows, whatever the corpus holds
    ranked = (cut.withColumn("rank", F.row_number().over(within) - 1)
              .join(counts, (F.col("length") == F.col("_length")) & (F.col("part") == F.col("_part")))
              .withColumn("at", place(F.col("length"), F.col("rank") + F.col("ahead"))))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id",
                         "at.offset")
