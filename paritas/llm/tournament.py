"""First-fit decreasing packing with a tournament tree of bin capacities.

Documents are tokenized, an end id follows each, and lots deal them to groups
that are packed independently, each by one task. A document longer than a
sequence is cut into full sequences, which need no packing, and a rest; the
rest is cut into loose pieces, powers of two (its binary digits, one of them
halved down to 1). Of the other documents one
in ``LOOSE_EVERY``, by lot, is cut into loose pieces likewise; the others stay
whole.

A group places its whole documents, longest first, each into the first
sequence with room, and then its loose pieces, longest first. The rooms are
the leaves of a tournament tree in which each inner node holds the larger of
its two children, so the first sequence with room is found by walking down.
Loose pieces are powers of two and fill the rooms that whole documents leave;
what they leave of the last sequence is cut at the binary digits of its total,
as sequences of a power of two are not padded.

Lots are drawn as the pieces are written, so later tasks and retries read the
same ones. A group has ``GROUP`` documents on average, each with at most
sixteen pieces to place, whatever the corpus or a single text holds.

Edge cases: a null or empty text is its end id alone. Null or repeated
``doc_id`` values are kept, each row packed on its own; rows that repeat are
dealt to different groups. An empty table gives an empty result. Extra columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import documents, saved, slices
from paritas.llm.tokens import TOKEN_SLICE, byte_tokens

SIZE = 2048
#: Documents of a group on average.
GROUP = 8192
#: Of the documents that fit a sequence, one in so many is cut into loose pieces.
LOOSE_EVERY = 64
#: The smallest digit of a rest that is halved further.
FINE = 16
SEED = 20240607


class Rooms:
    """The rooms of ``most`` empty sequences in a tournament tree."""

    def __init__(self, most: int, size: int) -> None:
        self.leaves = 1
        while self.leaves < most:
            self.leaves *= 2
        self.size = size
        self.tree = [size] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """The first sequence with room for ``length``, and the place in it."""
        tree, i = self.tree, 1
        while i < self.leaves:
            i *= 2
            if tree[i] < length:  # no room on the left
                i += 1
        at, offset = i - self.leaves, self.size - tree[i]
        tree[i] -= length
        while i > 1:
            i //= 2
            larger = max(tree[2 * i], tree[2 * i + 1])
            if tree[i] == larger:
                break
            tree[i] = larger
        return at, offset


def digits(n: int) -> list[int]:
    """The powers of two that ``n`` is the sum of, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def loose_parts(rests: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, length) of the loose pieces of each rest: its digits, of which the
    smallest from ``FINE`` on is halved down to 1, so that all small sizes are common."""
    part = 1 << np.arange(size.bit_length() - 1, -1, -1)
    many = (rests[:, None] & part > 0).astype(np.int64)
    large = rests // FINE * FINE
    halved = large & -large
    many -= (part == halved[:, None])
    many += part < halved[:, None]
    many[:, -1] += halved > 0
    many = many.ravel()
    return (np.repeat(np.repeat(np.arange(len(rests)), len(part)), many),
            np.repeat(np.tile(part, len(rests)), many))


def packed(lengths: np.ndarray, loose: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the place in it of each piece of a group."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms = Rooms(max(1, len(lengths)), size)
    order = np.lexsort((-lengths, loose))  # whole ones first, each longest first
    last: dict[int, list[int]] = {}  # loose pieces alone in their sequence
    for i in order.tolist():
        sequence[i], offset[i] = rooms.place(int(lengths[i]))
        if loose[i]:
            if not offset[i]:
                last[int(sequence[i])] = []
            if int(sequence[i]) in last:
                last[int(sequence[i])].append(i)
    new = int(sequence.max(initial=-1)) + 1
    for members in last.values():
        total = int(lengths[members].sum())
        if total == size:
            continue
        # descending powers of two reach each binary digit of their total exactly
        at, parts = 0, digits(total)
        for n, part in enumerate(parts):
            filled = 0
            while filled < part:
                i = members[at]
                sequence[i], offset[i] = new if n else sequence[i], filled
                filled += int(lengths[i])
                at += 1
            new += bool(n)
    return sequence, offset


_PIECE = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
          ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
_PIECE_SQL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int = SIZE,
           loose_every: int = LOOSE_EVERY, seed: int = SEED) -> DataFrame:
    """A row for each piece, with its document's ``lot`` and whether it is ``loose``;
    full sequences have a negative ``sequence_id`` of their own."""
    kind = pa.schema([*_PIECE, ("lot", pa.int64()), ("loose", pa.bool_()),
                      ("sequence_id", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_tokens(tokenizer)
        task = TaskContext.get().partitionId()
        lots, full = np.random.default_rng([seed, task]), 0
        for batch in batches:
            for b in slices(batch, most=TOKEN_SLICE):
                ids, at = encoder.encode(b.column("text"), end_id)
                data = memoryview(ids.astype("<u4").tobytes())
                n = np.diff(at)
                lot = lots.integers(0, 1 << 62, len(n))
                loose = (n > size) | ((n < size) & (lot % loose_every == 0))
                # full sequences, then the rest: its loose pieces, or the rest itself
                rest, whole = n % size, n // size
                alone = np.flatnonzero(~loose & (rest > 0))
                at_, part = loose_parts(np.where(loose, rest, 0), size)
                row = np.concatenate([np.repeat(np.arange(len(n)), whole), alone, at_])
                length = np.concatenate([np.full(whole.sum(), size), rest[alone], part])
                order = np.argsort(row, kind="stable")
                row, length = row[order], length[order]
                before = np.cumsum(length) - length
                start = before - (np.cumsum(n) - n)[row]
                begin = 4 * before
                crc = [zlib.crc32(data[s:e]) for s, e in zip(
                    begin.tolist(), (begin + 4 * length).tolist())]
                alone = length == size
                own = -1 - ((task << 40) + full + np.cumsum(alone) - 1)
                full += int(alone.sum())
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length),
                    pa.array(crc, pa.int64()), pa.array(n[row]), pa.array(lot[row] // loose_every),
                    pa.array(loose[row]), pa.array(own, mask=~alone)], schema=kind)

    return documents(docs).mapInArrow(
        cut, _PIECE_SQL + ", lot long, loose boolean, sequence_id long")


def pack(docs: DataFrame, tokenizer: str, end_id: int, size: int = SIZE, group: int = GROUP,
         loose_every: int = LOOSE_EVERY, seed: int = SEED) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset`` (place in the sequence, gapless from 0).
    ``size`` is a power of two."""
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")
    cut = saved(pieces(docs, tokenizer, end_id, size, loose_every, seed), "packing-pieces")
    groups = 1 + cut.where("start = 0").count() // group
    kind = pa.schema([*_PIECE, ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def packs(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32")])
        sequence, offset = packed(np.asarray(rows.column("length")),
                                  np.asarray(rows.column("loose")), size)
        first = key[0].as_py() << 32
        return pa.Table.from_arrays([*[rows.column(name) for name, _ in _PIECE],
                                     pa.array(sequence + first), pa.array(offset)], schema=kind)

    placed = (cut.where("sequence_id IS NULL").drop("sequence_id")
              .withColumn("lot", F.col("lot") % groups)
              .groupBy("lot").applyInArrow(packs, _PIECE_SQL + ", sequence_id long, offset long"))
    names = [name for name, _ in _PIECE]
    alone = cut.where("sequence_id IS NOT NULL").select(
        *names, "sequence_id", F.lit(0).cast("long").alias("offset"))
    return placed.union(alone)
