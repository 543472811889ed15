"""Token ids of texts by a public tokenizer file, many texts at a time."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

from paritas.llm.common import LOWER, byte_buffer

#: Bytes one worker keeps pieces and their ids in, about; beyond it the half that was
#: asked for in the fewest slices goes.
KNOWN_BYTES = 64 << 20
#: Bytes of a kept piece beside its characters and ids, about.
_PIECE_BYTES = 160
#: Bytes of text encoded at once (distinct pieces are looked up once each time).
TOKEN_SLICE = 4 << 20

#: The tokenizer drops these four, so no token reaches across one of them.
_DROPPED = np.zeros(256, bool)
_DROPPED[[0x20, 0x09, 0x0A, 0x0D]] = True
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_STOP = np.zeros(256, bool)
_STOP[[0x2C, 0x2E]] = True  # comma and full stop: never in one token with a letter


#: Lower-case Latin letters: one token of the pre-tokenizer, unchanged by the normalizer.
_PLAIN_WORD = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
_TOGETHER = 256


@lru_cache(maxsize=1)
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """One for each worker process and file, so that tasks find what earlier ones learned."""
    return WordTokens(path)


class WordTokens:
    """Ids by the tokenizers library for a vocabulary whose pre-tokenizer drops white space.

    Ids of a text are then those of its pieces end to end, cut at white space
    and between a letter and a comma or full stop (checked against whole-text
    encoding in the tests), so each distinct piece is encoded once per worker.
    The vocabulary is lower case: A-Z is lowered first, but for texts that may
    hold a special token's string."""

    #: Pieces that may be encoded together, and what stands between them then.
    plain, glue = _PLAIN_WORD, " "

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._start([], np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _ends(self, flat: np.ndarray) -> np.ndarray:
        """Where the ids of each piece end, of plain pieces encoded together."""
        return np.flatnonzero(self.ends_word[flat]) + 1

    def _start(self, pieces: list[str], ids: np.ndarray, bounds: np.ndarray) -> None:
        """Knows these pieces only; piece i of them has ids[bounds[i]:bounds[i + 1]]."""
        self.known: dict[str, int] = {"": 0} | dict(zip(pieces, range(1, len(pieces) + 1)))
        self.pieces = len(pieces) + 1
        self.ids, self.bounds, self.asked = (
            np.zeros(1 << max(16, (n - 1).bit_length()), t) for n, t in (
                (len(ids) + 1, np.uint32), (self.pieces + 1, np.int64), (self.pieces, np.int32)))
        self.ids[:len(ids)] = ids
        self.bounds[1:self.pieces + 1] = bounds
        self.used = _PIECE_BYTES * len(pieces) + sum(map(len, pieces)) + 4 * len(ids)

    def _thin(self) -> None:
        """Gives up the pieces that the fewest slices asked for, until half the bytes are left."""
        names = list(self.known)
        order = 1 + np.argsort(-self.asked[1:self.pieces], kind="stable")
        length = np.fromiter(map(len, names), np.int64, len(names)) + 4 * np.diff(
            self.bounds[:self.pieces + 1])
        kept = order[np.cumsum(length[order] + _PIECE_BYTES) <= KNOWN_BYTES // 2]
        size = (self.bounds[kept + 1] - self.bounds[kept]).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.arange(bounds[-1]) + np.repeat(self.bounds[kept] - bounds[:-1], size)]
        self._start([names[i] for i in kept.tolist()], ids, bounds)

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        if self.used > KNOWN_BYTES:
            self._thin()
        new = [p for p in pieces if p not in self.known]
        if new:
            plain = [p for p in new if self.plain.fullmatch(p)]
            other = [p for p in new if not self.plain.fullmatch(p)]
            (first, size), (more, sizes) = self._of_words(plain), self._one_by_one(other)
            new, flat = plain + other, np.concatenate([first, more])
            sizes = np.concatenate([size, sizes])
            at, n = self.bounds[self.pieces], len(new)
            while at + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            while self.pieces + n + 1 > len(self.bounds):
                self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
            while self.pieces + n > len(self.asked):
                self.asked = np.concatenate([self.asked, np.zeros_like(self.asked)])
            self.ids[at:at + len(flat)] = flat
            self.bounds[self.pieces + 1:self.pieces + n + 1] = at + np.cumsum(sizes)
            self.known.update(zip(new, range(self.pieces, self.pieces + n)))
            self.pieces += n
            self.used += _PIECE_BYTES * n + sum(map(len, new)) + 4 * len(flat)
        numbers = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        self.asked[numbers] += 1
        return numbers

    def _one_by_one(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((i for x in lists for i in x), np.uint32, int(sizes.sum())), sizes

    def _of_words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Plain pieces together in one text; their tokens tell where each ends."""
        joined = [self.glue.join(pieces[i:i + _TOGETHER]) for i in range(0, len(pieces), _TOGETHER)]
        flat, _ = self._one_by_one(joined)
        ends = self._ends(flat)
        if len(ends) != len(pieces):
            return self._one_by_one(pieces)
        return flat, np.diff(ends, prepend=0)

    def _pieces(self, buf: np.ndarray, offsets: np.ndarray,
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all pieces end to end, where each piece begins there and in ``buf``."""
        if b"<|" not in buf.tobytes():
            buf = LOWER[buf]
        dropped = _DROPPED[buf]
        cut = np.zeros(len(buf) + 1, bool)
        cut[offsets] = True
        cut[1:] |= dropped
        cut[1:-1] |= _LETTER[buf[:-1]] & _STOP[buf[1:]]
        own = np.flatnonzero(~dropped)
        begin = np.flatnonzero(cut[own])
        return buf[own], begin, own[begin]

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end (uint32) and where each text's begin (one more than texts)."""
        buf, offsets = byte_buffer(texts)
        data, begin, place = self._pieces(buf, offsets)
        pieces = pa.LargeStringArray.from_buffers(
            len(begin), pa.py_buffer(np.append(begin, len(data))), pa.py_buffer(data))
        coded = pieces.dictionary_encode()
        number = self._numbers(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
        size = self.bounds[number + 1] - self.bounds[number]
        ends = np.concatenate([[0], np.cumsum(size)])
        flat = self.ids[np.arange(ends[-1]) + np.repeat(self.bounds[number] - ends[:-1], size)]
        at = ends[np.searchsorted(place, offsets)]
        if end_id is None:
            return flat, at
        own = np.arange(len(texts) + 1)
        out = np.full(len(flat) + len(texts), end_id, np.uint32)
        place = np.arange(len(flat)) + np.repeat(own[:-1], np.diff(at))
        out[place] = flat
        return out, at + own


#: A space or line end, then characters up to a visible ASCII one or a Latin letter,
#: none of them white or the beginning of a special token.
_SPACED = re.compile("[ \n][^\\s<]*[!-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]")
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_GRAPHIC = np.zeros(256, bool)
_GRAPHIC[0x21:0x7F] = True
_ANY_LETTER = np.zeros(256, bool)
_ANY_LETTER[65:91] = _ANY_LETTER[97:123] = True


class ByteTokens(WordTokens):
    """Ids for a byte-level vocabulary, whose pre-tokenizer keeps white space.

    None of its tokens holds white space after another character, nor a letter
    and then a comma or full stop, so texts are cut before white space that
    follows a visible ASCII or Latin character, and there (checked against
    whole-text encoding in the tests)."""

    plain, glue = _SPACED, ""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.begins_piece = np.zeros(self.tokenizer.get_vocab_size(), bool)
        # the signs that stand for a space and a line end
        self.begins_piece[[i for t, i in vocabulary.items() if t[0] in "\u0120\u010a"]] = True

    def _ends(self, flat: np.ndarray) -> np.ndarray:
        return np.append(np.flatnonzero(self.begins_piece[flat])[1:], len(flat))

    def _pieces(self, buf: np.ndarray, offsets: np.ndarray,
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # U+00C0 to U+00FF, two bytes, are visible and, but for two signs, letters
        latin = np.zeros(len(buf), bool)
        latin[1:] = buf[:-1] == 0xC3
        letter = _ANY_LETTER[buf] | (latin & (buf != 0x97) & (buf != 0xB7))
        cut = np.zeros(len(buf) + 1, bool)
        cut[offsets] = True
        cut[1:-1] |= ((_GRAPHIC[buf] | latin)[:-1] & _SPACE[buf[1:]]) | (letter[:-1] & _STOP[buf[1:]])
        begin = np.flatnonzero(cut[:-1])
        return buf, begin, begin
