"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are lower-cased and runs of white space become one
space. An item of n characters may occur with up to k = n / 10 edits. By the
q-gram lemma such an occurrence shares at least n + 1 - q (k + 1) q-grams with
the item, and they lie on diagonals (place in the text less place in the item)
at most k apart. So the text's q-grams that any item has are counted by item
and band of diagonals; bands are 2 (k + 1) wide and begin every k + 1, so that
one of them holds the whole occurrence. Bands that reach the bound are
verified by an alignment kept to their diagonals, with free ends in the text.

Items of fewer than 24 characters after normalisation are searched without
edits. Those of fewer than 8 have no q-gram and are looked up whole, between
word borders: where two letters or digits meet is none.

Items are a stated set. Equal texts are one item here, to whose ids matches are
joined on Spark, so an item that is repeated adds nothing to an index. The
distinct texts are read in blocks of a bounded number of characters (or one
longer item); each block's matches are written before the next block is read,
so the driver and the tasks hold one index at a time, and every text is scanned
whole against every block. Texts longer than a slice are normalised in pieces
and scanned in windows that overlap by more than an occurrence can span; an
occurrence counts in the window it begins in.

Edge cases: null or empty texts match nothing; null items and items without a
character other than white space are not searched. Items repeated in the
benchmark each match. Repeated rows each get their matches; extra columns stay
as they are. An empty benchmark leaves every text without matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import code_points, free_name, saved, slices

Q = 8
#: Edits allowed for each character of an item; none for items of fewer characters.
EDIT_RATE = 0.1
LEAST_CHARS = 24
#: Characters of benchmark items searched in one pass over the texts, and bytes (or
#: characters of a long text) searched at once: a common q-gram has entries in
#: proportion to both.
BLOCK_CHARS, TEXT_BYTES = 1_000_000, 1 << 20
#: Keys are packed into 63 bits where they fit.
_PACKED = 1 << 62

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MARK_BITS = 22
_FAR = np.int32(1 << 20)


@lru_cache(maxsize=1)
def _plain() -> np.ndarray:
    """For each code point its lower case, with a space for all white space."""
    out = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isspace():
            out[i] = 32
        elif c.isupper() and len(low := c.lower()) == 1:
            out[i] = ord(low)
    return out


@lru_cache(maxsize=1)
def _in_words() -> np.ndarray:
    """Whether each code point is a letter or digit."""
    return np.array([chr(i).isalnum() for i in range(0x110000)])


def normalised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all texts, the text and the original place of each, and
    where each text begins (one more than texts)."""
    points, begin = code_points(texts)
    chars = _plain()[points]
    text = np.repeat(np.arange(len(texts)), np.diff(begin))
    keep = np.ones(len(chars), bool)
    keep[1:] = (chars[1:] != 32) | (chars[:-1] != 32) | (text[1:] != text[:-1])
    first = np.concatenate([[0], np.cumsum(keep)])[begin]
    place = np.arange(len(chars)) - begin[:-1][text] if len(chars) else np.zeros(0, np.int64)
    return chars[keep], text[keep], place[keep], first


def _normalised_long(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Characters and their places of one long text, normalised in pieces."""
    buf = text.cast(pa.large_binary())[0].as_buffer()
    data = np.frombuffer(buf, np.uint8)
    chars, places, before, last, at = [], [], 0, 0, 0
    while at < len(data):
        to = min(at + TEXT_BYTES, len(data))
        while to < len(data) and data[to] & 0xC0 == 0x80:  # not within a character
            to += 1
        points = np.frombuffer(data[at:to].tobytes().decode().encode("utf-32-le"), np.uint32)
        plain = _plain()[points]
        keep = plain != 32
        keep[1:] |= plain[:-1] != 32
        keep[0] |= last != 32
        kept = np.flatnonzero(keep)
        chars.append(plain[kept])
        places.append((kept + before).astype(np.int32 if before < 2**30 else np.int64))
        before, last, at = before + len(points), int(plain[-1]), to
    return np.concatenate(chars), np.concatenate(places)


def _grams(chars: np.ndarray, text: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of the q-gram at each place, and whether it stays within one text."""
    n = max(0, len(chars) - q + 1)
    out = np.zeros(n, np.uint64)
    for j in range(q):
        out = out * _BASE + chars[j:n + j]
    return out, text[:n] == text[q - 1:]


@dataclass
class Index:
    """The q-grams of a block of items."""

    ids: list[int | None]
    items: list[np.ndarray]
    budget: np.ndarray
    bound: np.ndarray
    grams: np.ndarray  # distinct, ascending
    first: np.ndarray  # of each gram's entries (one more than grams)
    item: np.ndarray
    at: np.ndarray
    mark: np.ndarray
    short: dict[int, tuple[np.ndarray, dict[bytes, list[int]]]]  # by length, without q-grams

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]], q: int = Q, rate: float = EDIT_RATE) -> Index:
        ids, items, hashes, item, at = [], [], [], [], []
        short: dict[int, dict[bytes, list[int]]] = {}
        for ident, text in rows:
            chars = normalised(pa.array([text]))[0]
            chars = chars[(chars != 32).argmax():]  # at most one space at each end
            chars = chars[:-1] if len(chars) and chars[-1] == 32 else chars
            if not len(chars):
                continue
            if len(chars) < q:
                short.setdefault(len(chars), {}).setdefault(chars.tobytes(), []).append(len(items))
            h, _ = _grams(chars, np.zeros(len(chars), np.int64), q)
            hashes.append(h)
            item.append(np.full(len(h), len(items)))
            at.append(np.arange(len(h)))
            ids.append(ident)
            items.append(chars)
        n = np.array([len(x) for x in items], np.int64)
        # fewer edits for short items, so that one q-gram at least is left
        budget = np.minimum((n * rate).astype(np.int64), np.maximum(0, n // q - 1))
        budget[n < LEAST_CHARS] = 0
        h = np.concatenate(hashes) if items else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        grams, first = np.unique(h[order], return_index=True)
        mark = np.zeros(1 << _MARK_BITS, bool)
        mark[_mark(grams)] = True
        cat = lambda x: np.concatenate(x)[order] if items else np.zeros(0, np.int64)
        return cls(ids, items, budget, n + 1 - q * (budget + 1), grams, np.append(first, len(h)),
                   cat(item), cat(at), mark, {m: (_hashes_of(x, m), x) for m, x in short.items()})

    def bands(self, chars: np.ndarray, text: np.ndarray, first: np.ndarray,
              q: int = Q) -> np.ndarray:
        """Rows (text, item, band) that reach the bound."""
        h, within = _grams(chars, text, q)
        place = np.flatnonzero(self.mark[_mark(h)] & within)
        if not len(place) or not len(self.grams):
            return np.zeros((0, 3), np.int64)
        g = np.minimum(np.searchsorted(self.grams, h[place]), len(self.grams) - 1)
        real = self.grams[g] == h[place]
        place, g = place[real], g[real]
        if not len(place):  # the marks alone agreed
            return np.zeros((0, 3), np.int64)
        many = self.first[g + 1] - self.first[g]
        entry = np.arange(many.sum()) + np.repeat(self.first[g] - (np.cumsum(many) - many), many)
        place, item = np.repeat(place, many), self.item[entry]
        own = text[place]
        diagonal = place - first[own] - self.at[entry]
        band = diagonal // (self.budget[item] + 1)
        most = max(len(x) for x in self.items)
        low = -(int(self.budget.max()) + 2) - most
        span = int(band.max(initial=0)) - low + 2
        # pairs of text and item are numbered densely, so that no key passes 63 bits:
        # there are fewer pairs than entries
        pairs, pair = np.unique(own * len(self.items) + item, return_inverse=True)
        if len(pairs) * span >= _PACKED:
            raise OverflowError("too many q-grams at once: lower TEXT_BYTES")
        # a place of the item counts once a band, however often the text repeats its q-gram
        key, count = _counted(_distinct(pair * span + (band - low), self.at[entry],
                                        len(pairs) * span, most))
        # band b also holds the diagonals counted for b + 1
        both, _ = _counted(np.concatenate([key, key - 1]))
        total = _looked_up(key, count, both) + _looked_up(key, count, both + 1)
        which = pairs[both // span] % len(self.items)
        enough = total >= self.bound[which]
        some, which = both[enough], which[enough]
        return np.stack([pairs[some // span] // len(self.items), which, some % span + low], 1)


def _distinct(key: np.ndarray, at: np.ndarray, keys: int, most: int) -> np.ndarray:
    """``key`` once for each different ``at`` that it has."""
    if keys * most < _PACKED:
        return _counted(key * most + at)[0] // most
    order = np.lexsort((at, key))
    key, at = key[order], at[order]
    return key[np.append(True, (key[1:] != key[:-1]) | (at[1:] != at[:-1]))]


def _hashes_of(items: dict[bytes, list[int]], n: int) -> np.ndarray:
    chars = np.frombuffer(b"".join(items), np.uint32)
    return np.unique(_grams(chars, np.zeros(len(chars), np.int64), n)[0][::n])


def _whole(index: Index, chars: np.ndarray, text: np.ndarray, first: np.ndarray,
           ) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, begin, end, edits) of the items too short for q-grams."""
    if not index.short or not len(chars):
        return
    word = _in_words()[chars]
    border = np.ones(len(chars) + 1, bool)
    border[1:-1] = ~(word[1:] & word[:-1]) | (text[1:] != text[:-1])
    for n, (hashes, items) in index.short.items():
        h, within = _grams(chars, text, n)
        at = np.flatnonzero(border[:len(h)] & border[n:] & within)
        for i in at[np.isin(h[at], hashes)].tolist():
            t = int(text[i])
            for item in items.get(chars[i:i + n].tobytes(), ()):
                yield t, item, i - int(first[t]), i - int(first[t]) + n, 0


def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.sort(key)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.diff(np.append(first, len(key)))


def _mark(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - _MARK_BITS)


def _looked_up(key: np.ndarray, count: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    i = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
    return np.where(key[i] == wanted, count[i], 0)


def aligned(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int,
            ) -> tuple[int, int] | None:
    """The least number of edits, up to ``most``, between the item and any part
    of the text on diagonals low to high, and where that part ends."""
    width = high - low + 1
    j = np.arange(low, high + 1)  # place in the text before which the cell of row 0 stands
    ramp = np.arange(width, dtype=np.int32)
    row = np.where((j >= 0) & (j <= len(text)), 0, _FAR).astype(np.int32)
    for i, c in enumerate(item):
        # the cell at (i + 1, x) has its diagonal neighbour at the same index one row up
        x = j + i
        same = np.zeros(width, bool)
        inside = (x >= 0) & (x < len(text))
        same[inside] = text[x[inside]] == c
        new = row + ~same
        new[~inside] = _FAR
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        new[(x + 1 < 0) | (x + 1 > len(text))] = _FAR
        row = np.minimum.accumulate(new - ramp) + ramp  # characters of the text left over
        if row.min() > most:
            return None
    best = int(row.argmin())
    return int(row[best]), int(j[best]) + len(item)


def _places(text: np.ndarray, item: np.ndarray) -> list[int]:
    """Where the item stands in the text without an edit."""
    data, want, out = text.tobytes(), item.tobytes(), []
    at = data.find(want)
    while at >= 0:
        if at % 4 == 0:  # at a character
            out.append(at // 4)
        at = data.find(want, at + 1)
    return out


def _verified(index: Index, found: np.ndarray, chars: np.ndarray, first: np.ndarray,
              ) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, begin, end, edits) for bands that hold an occurrence; bands of
    one text and item that lie side by side are aligned together."""
    i = 0
    while i < len(found):
        text, item, band = found[i].tolist()
        last = i
        while last + 1 < len(found) and (found[last + 1, :2] == (text, item)).all() and (
                found[last + 1, 2] - found[last, 2] <= 2) and found[last + 1, 2] - band <= 8:
            last += 1
        k, want = int(index.budget[item]), index.items[item]
        low, high = band * (k + 1) - k, (int(found[last, 2]) + 2) * (k + 1) - 1 + k
        begin, end = int(first[text]), int(first[text + 1])
        a = max(begin, begin + low)
        part = chars[a:min(end, begin + high + len(want) + 1)]
        at, exact = a - begin, _places(part, want)
        for start in exact:
            yield text, item, at + start, at + start + len(want), 0
        if not exact and (got := aligned(want, part, low - at, high - at, k)):
            edits, stop = got
            back = aligned(want[::-1], part[:stop][::-1], -k, k, k)
            start = stop - back[1] if back and back[0] == edits else max(0, stop - len(want))
            yield text, item, at + start, at + stop, edits
        i = last + 1


#: (text, item, begin, end, edits), places in the original text.
Match = tuple[int, int, int, int, int]


def _found(index: Index, texts: pa.Array) -> list[Match]:
    """All matches in a slice of texts, sorted."""
    if len(texts) == 1 and pc.binary_length(texts)[0].as_py() > TEXT_BYTES:
        return _found_in_long(index, texts)
    chars, text, place, first = normalised(texts)
    found = index.bands(chars, text, first)
    # neighbouring runs of bands may find one occurrence twice
    out = {*_verified(index, found, chars, first), *_whole(index, chars, text, first)}
    return sorted((t, i, int(place[first[t] + s]), int(place[first[t] + e - 1]) + 1, edits)
                  for t, i, s, e, edits in out)


def _found_in_long(index: Index, texts: pa.Array) -> list[Match]:
    if not index.items:
        return []
    chars, place = _normalised_long(texts)
    # no occurrence spans more; alignments look a budget further on both sides
    reach = max(len(x) for x in index.items) + 4 * int(index.budget.max()) + 16
    step = max(TEXT_BYTES, reach)
    out = set()
    for at in range(0, len(chars), step):
        low, high = max(0, at - reach), min(len(chars), at + step + reach)
        part = chars[low:high]
        text, first = np.zeros(len(part), np.int64), np.array([0, len(part)])
        matches = {*_verified(index, index.bands(part, text, first), part, first),
                   *_whole(index, part, text, first)}
        out |= {(0, i, low + s, low + e, edits) for _, i, s, e, edits in matches
                if at <= low + s < at + step}
    return sorted((0, i, int(place[s]), int(place[e - 1]) + 1, edits) for _, i, s, e, edits in out)


_LEAKS = "array<struct<item_id: bigint, start: bigint, end: bigint, edits: bigint>>"


@dataclass
class Benchmark:
    """Distinct item texts (number, text, block, item_id: the smallest of equal texts)
    and all ids (number, item_id)."""

    texts: DataFrame
    ids: DataFrame
    blocks: int

    @classmethod
    def of(cls, benchmark: DataFrame, block_chars: int) -> Benchmark:
        items = benchmark.where(F.col("text").isNotNull()).select(
            F.col("item_id").cast("long").alias("item_id"), "text")
        texts = items.groupBy("text").agg(F.min("item_id").alias("item_id"))
        texts = saved(texts.withColumn("number", F.monotonically_increasing_id()), "items")
        chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
        blocks = 1 + chars // block_chars
        texts = texts.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks)))
        ids = items.join(texts.select("text", "number").hint("merge"), "text").select(
            "number", "item_id")
        return cls(texts, ids, blocks)

    def block(self, i: int, q: int, rate: float, ident: str = "number") -> Index:
        """The index of a block; its rows are bounded by the block's characters."""
        rows = self.texts.where(F.col("block") == i).orderBy("item_id", "text")
        return Index.of([(r[ident], r["text"]) for r in rows.collect()], q, rate)


def _hits(index: Index, keep: str, kind: pa.Schema):
    """Rows of the column ``keep`` with a match: item, start, end, edits."""
    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, most=TEXT_BYTES):
                got = _found(index, b.column("text"))
                row = pa.array([m[0] for m in got], pa.int64())
                columns = [[index.ids[m[1]] for m in got], *([m[k] for m in got] for k in (2, 3, 4))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(keep).take(row), *[pa.array(c, pa.int64()) for c in columns]],
                    schema=kind)

    return hits


def _matched(docs: DataFrame, bench: Benchmark, key: str, ident: str, q: int,
             rate: float) -> DataFrame:
    """(key, ident, start, end, edits) over all blocks; with more than one block each
    block's matches are written before the next block is read."""
    rows = docs.select(F.col(key).cast("long").alias(key), "text").where(F.col("text").isNotNull())
    names = [ident, "start", "end", "edits"]
    kind = pa.schema([(c, pa.int64()) for c in (key, *names)])
    sql = ", ".join(f"`{c}` long" for c in (key, *names))
    out = None
    for i in range(bench.blocks):
        found = rows.mapInArrow(_hits(bench.block(i, q, rate, ident), key, kind), sql)
        if bench.blocks > 1:
            found = saved(found, f"matches-{i}")
        out = found if out is None else out.union(found)
    return out


def matches(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, start, end, edits): a row for each place where a document holds
    an item, and for each item with that text; places are code points of the text."""
    bench = Benchmark.of(benchmark, block_chars)
    found = _matched(docs, bench, "doc_id", "number", q, rate)
    return found.join(bench.ids, "number").select("doc_id", "item_id", "start", "end", "edits")


def scan(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE,
         into: str = "leaks", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with an array column ``into`` of (item_id, start, end, edits), once for
    equal items (the smallest id); places are code points of the original text."""
    bench = Benchmark.of(benchmark, block_chars)
    if bench.blocks == 1:
        return docs.withColumn(into, _matcher(bench.block(0, q, rate, "item_id"))(F.col("text")))
    row = free_name(docs, "row_number")
    docs = saved(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    found = _matched(docs, bench, row, "item_id", q, rate)
    match = F.struct("item_id", "start", "end", "edits")
    # as many as the text holds
    lists = found.groupBy(row).agg(F.sort_array(F.collect_list(match)).alias(into))
    return docs.join(lists.hint("merge"), row, "left").withColumn(
        into, F.coalesce(into, F.array().cast(_LEAKS))).drop(row)


def _matcher(index: Index):
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("item_id", "start", "end", "edits")]))

    @F.arrow_udf(_LEAKS)
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            out = []
            rows_ = pa.RecordBatch.from_arrays([column.fill_null("")], ["text"])
            for b in slices(rows_, most=TEXT_BYTES):
                rows: list[list] = [[] for _ in range(b.num_rows)]
                for t, i, s, e, edits in _found(index, b.column(0)):
                    rows[t].append({"item_id": index.ids[i], "start": s, "end": e, "edits": edits})
                out += rows
            yield pa.array(out, kind)

    return found
