"""Tournament-tree packing: whole ids, little padding, first fit as defined."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tests.llm.conftest import TEXTS
from tokenizers import Tokenizer

from paritas.llm import queries, tournament
from paritas.llm.tokens import ByteTokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def byte_file():
    return queries.tokenizer_path(queries.BYTE_TOKENIZER)


def test_pieces_give_whole_text_ids(spark, byte_file):
    whole, ours = Tokenizer.from_file(byte_file), ByteTokens(byte_file)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    random.seed(5)
    alphabet = list("abcXYZ012 .,'!?-\n\t\r") + [
        "é", "ß", "文", "🙂", "́", "　", " ", " ", "\u0085", "\x1c", "'s", "'LL", "  ",
        "<|endoftext|>", "<|", "\x0b", "\x0c", "İ", "ſ", " the", "ſs", "×", "÷", "È", "\u00bf"]
    some = [r.text for r in docs.collect()] + [t or "" for _, t in TEXTS] + [
        "".join(random.choices(alphabet, k=random.randint(0, 40))) for _ in range(3000)]
    for low in range(0, len(some), 300):
        part = some[low:low + 300]
        ids, at = ours.encode(pa.array(part), 1)
        for i, e in enumerate(whole.encode_batch(part, add_special_tokens=False)):
            assert ids[at[i]:at[i + 1]].tolist() == [*e.ids, 1], part[i]


def test_memory_of_pieces_is_bounded(byte_file, monkeypatch):
    from paritas.llm import tokens

    monkeypatch.setattr(tokens, "KNOWN_BYTES", 2000)
    whole, ours = Tokenizer.from_file(byte_file), ByteTokens(byte_file)
    for i in range(20):
        text = " ".join(f"word{i} and{j * i}" for j in range(30))
        ids, _ = ours.encode(pa.array([text]))
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids
    assert ours.used < 20_000 and ours.pieces < 100


def all_ids(docs, byte_file):
    whole = Tokenizer.from_file(byte_file)
    return [(r.doc_id, whole.encode(r.text or "", add_special_tokens=False).ids + [1])
            for r in docs.select("doc_id", "text").collect()]


def check_packed(rows, ids, size):
    """Every id of every document in one piece; sequences gapless. Returns their totals."""
    def key(d):
        return (d is None, d or 0)

    want, got = {}, {}
    for d, x in ids:
        want.setdefault((key(d), len(x)), []).append(x)
    for r in rows:
        got.setdefault((key(r.doc_id), r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
    assert want.keys() == got.keys()
    for k, texts in want.items():
        # rows of one id and length are checked as a multiset of pieces
        have = sorted(got[k])
        starts = sorted({(s, n) for s, n, _ in have})
        allowed = {(s, n, zlib.crc32(np.asarray(x[s:s + n], "<u4").tobytes()))
                   for x in texts for s, n in starts}
        assert set(have) <= allowed
        assert sum(n for _, n, _ in have) == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for s, n, _ in have:
                assert s == at
                at += n
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    totals = []
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= size
        totals.append(at)
    return totals


def padding(totals, size):
    return sum(size - t for t in totals if t & (t - 1))


def test_query(spark, byte_file):
    ids = all_ids(spark.read.parquet(f"{SF}/documents.parquet"), byte_file)
    totals = check_packed(queries.op12_tournament_packing(spark, SF).collect(), ids, 2048)
    n = sum(len(x) for _, x in ids)
    assert padding(totals, 2048) == 0 and len(totals) <= n // 2048 + 12


def test_edges(odd, empty, byte_file):
    totals = check_packed(tournament.pack(odd, byte_file, 1, 512, group=4).collect(),
                          all_ids(odd, byte_file), 512)
    assert max(totals) == 512
    assert tournament.pack(empty, byte_file, 1).count() == 0
    with pytest.raises(ValueError):
        tournament.pack(empty, byte_file, 1, size=1000)


def test_groups_and_retries(spark, byte_file):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(6, "doc_id")
    out = tournament.pack(docs, byte_file, 1, group=20)
    rows = out.collect()
    totals = check_packed(rows, all_ids(docs, byte_file), 2048)
    assert len({r.sequence_id >> 32 for r in rows if r.sequence_id >= 0}) > 5
    assert padding(totals, 2048) < 0.05 * sum(totals)  # groups of a few documents
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, rows))


@pytest.mark.parametrize("seed", range(4))
def test_first_fit_decreasing(seed):
    """Whole pieces lie where a scan over all sequences would put them."""
    rng = np.random.default_rng(seed)
    size = 256
    lengths = rng.integers(1, size + 1, 400)
    loose = np.zeros(400, bool)
    sequence, offset = tournament.packed(lengths, loose, size)
    room = []
    for i in np.argsort(-lengths, kind="stable"):
        at = next((j for j, r in enumerate(room) if r >= lengths[i]), len(room))
        if at == len(room):
            room.append(size)
        assert (sequence[i], offset[i]) == (at, size - room[at])
        room[at] -= lengths[i]


def test_loose_parts_sum_up():
    rests = np.arange(2048)
    row, length = tournament.loose_parts(rests, 2048)
    assert (np.bincount(row, weights=length, minlength=2048) == rests).all()
    assert not (length & (length - 1)).any() and np.bincount(row).max() <= 16
    assert length[row == 1040].tolist() == [1024, 8, 4, 2, 1, 1]
    assert len(tournament.loose_parts(np.zeros(3, np.int64), 2048)[0]) == 0


def test_loose_pieces_leave_no_padding():
    rng = np.random.default_rng(1)
    whole = rng.integers(1, 2048, 200)
    _, parts = tournament.loose_parts(rng.integers(1, 2048, 60), 2048)
    lengths = np.concatenate([whole, parts])
    loose = np.arange(len(lengths)) >= 200
    sequence, _ = tournament.packed(lengths, loose, 2048)
    totals = np.bincount(sequence, weights=lengths).astype(int).tolist()
    assert sum(totals) == lengths.sum() and min(totals) > 0 and padding(totals, 2048) == 0
    only = np.array(tournament.digits(1365))
    sequence, offset = tournament.packed(only, np.ones(len(only), bool), 2048)
    assert len(set(sequence.tolist())) == len(only) and not offset.any()
