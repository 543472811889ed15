"""Tokens, packing, token files and archives: exact round trips."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import TEXTS
from tokenizers import Tokenizer

from paritas.llm import packing, queries, rans, warc
from paritas.llm.tokens import WordTokens

SF = "/root/testdata/sf0.001"


def test_pieces_give_whole_text_ids(spark, tokenizer):
    whole, ours = Tokenizer.from_file(tokenizer), WordTokens(tokenizer)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    random.seed(2)
    alphabet = list("abcXYZ012 .,'!?-\n\t\r") + ["é", "ß", "文", "🙂", "́", "　", "'s",
                                                  "<|endoftext|>", "\x0b", "İ", "ſ", "'LL"]
    some = [r.text for r in docs.collect()] + [t or "" for _, t in TEXTS] + [
        "".join(random.choices(alphabet, k=random.randint(0, 40))) for _ in range(2000)]
    for low in range(0, len(some), 300):
        part = some[low:low + 300]
        ids, at = ours.encode(pa.array(part), 1)
        for i, e in enumerate(whole.encode_batch(part, add_special_tokens=False)):
            assert ids[at[i]:at[i + 1]].tolist() == [*e.ids, 1], part[i]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def all_ids(docs, tokenizer):
    whole = Tokenizer.from_file(tokenizer)
    return [(r.doc_id, whole.encode(r.text or "", add_special_tokens=False).ids + [1])
            for r in docs.select("doc_id", "text").collect()]


# --- packing ----------------------------------------------------------------
def check_packed(rows, ids, size):
    want = sorted(((d is None, d or 0), p, s * 1, len(x[s:s + size]), crc(x[s:s + size]))
                  for d, x in ids for p, s in enumerate(range(0, len(x), size)))
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.piece, r.start, r.length, r.ids_crc32)
                  for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_packing_query(spark, tokenizer):
    ids = all_ids(spark.read.parquet(f"{SF}/documents.parquet"), tokenizer)
    n = check_packed(queries.op6_pattern_packing(spark, SF).collect(), ids, 4096)
    assert n <= 1 + -(-sum(len(x) for _, x in ids) // 4096)


def test_packing_edges(odd, empty, tokenizer):
    check_packed(packing.pack(odd, tokenizer, 1, 512).collect(), all_ids(odd, tokenizer), 512)
    assert packing.pack(empty, tokenizer, 1).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_whole_and_tight(seed):
    rng = np.random.default_rng(seed)
    size = [64, 100, 1000, 4096, 4096, 7][seed]
    lengths = np.clip(rng.lognormal(np.log(size / 6), 1, 20_000).astype(int), 1, size)
    counts = np.bincount(lengths, minlength=size + 1)
    plan = packing.planned(counts, size)
    length = np.repeat(np.arange(size + 1), counts)
    rank = np.concatenate([np.arange(n) for n in counts])
    sequence, offset = plan.places(length, rank)
    order = np.lexsort((offset, sequence))
    s, o, e = sequence[order], offset[order], (offset + length)[order]
    new = np.append(True, s[1:] != s[:-1])
    assert (o[new] == 0).all() and (o[1:][~new[1:]] == e[:-1][~new[1:]]).all() and e.max() <= size
    assert len(np.unique(s)) == plan.sequences <= 1.01 * lengths.sum() / size + 2


def test_least_squares():
    rng = np.random.default_rng(3)
    a = rng.random((12, 30))
    x = np.maximum(0, rng.normal(size=30))
    got = packing.fitted(a, a @ x)
    assert (got >= 0).all() and np.abs(a @ got - a @ x).max() < 1e-6
    got = packing.fitted(a, rng.normal(size=12))
    assert (got >= 0).all()


# --- token files ------------------------------------------------------------
@pytest.mark.parametrize("n,kinds", [(1, 5), (5000, 50), (300_001, 49408), (1024, 1)])
def test_blocks_round_trip(n, kinds):
    ids = np.minimum(np.random.default_rng(n).zipf(1.2, n) - 1, kinds - 1).astype(np.uint32)
    table = rans.Table.read(rans.Table.of(ids).stored())
    assert int(table.scaled.sum()) == 1 << table.bits and table.scaled.min() > 0
    data = rans.encode(ids, table)
    assert (rans.decode(memoryview(data), n, table) == ids).all()
    if n == 300_001:
        assert len(data) < 2 * n * 0.8


def test_token_files_query(spark, tokenizer):
    ids = dict(all_ids(spark.read.parquet(f"{SF}/documents.parquet"), tokenizer))
    got = queries.op8_rans_tokens(spark, SF).orderBy("doc_id").collect()
    start = 0
    for r, d in zip(got, sorted(ids), strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, start, len(ids[d]), crc(ids[d]))
        start += len(ids[d])


def test_token_files_edges(odd, empty, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK_TOKENS", 64)
    segments = rans.write(odd, f"file://{tmp_path}/t", tokenizer, 1)
    rows = rans.read(segments, with_ids=True).orderBy("start").collect()
    want = sorted(all_ids(odd, tokenizer), key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r.doc_id for r in rows] == [d for d, _ in want]
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
    assert {(r.doc_id, tuple(r.ids), r.ids_crc32) for r in rows} == {
        (d, tuple(x), crc(x)) for d, x in want}
    assert rans.round_trip(empty, tokenizer, 1).count() == 0
    # a changed byte is noticed
    path = segments.first().path.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        rans.read(segments).collect()


# --- archives ---------------------------------------------------------------
def pages(spark):
    long = "ä" * 600
    return spark.createDataFrame(
        [(1, "http://a", long), (2, None, long), (7, "http://c\r\nX: y", long), (3, "u", "short"),
         (4, "u", "short"), (5, "u", None), (6, "u", ""), (None, "u", long), (8, "u", "z" * 999),
         (9, "u", "z" * 999), (10, "u", "z" * 1000), (11, "u", "z" * 1000), (11, "u", "z" * 1000),
         (12, "u", "\x1f\u008b\x08 WARC/1.1" * 500)],
        "page_id long, url string, html string").withColumn("payload", F.lit("clash"))


def test_archive_records(spark, tmp_path):
    files = warc.write(pages(spark).coalesce(1), f"file://{tmp_path}/w")
    want = {(r.page_id, (r.html or "").encode()) for r in pages(spark).collect()}
    for size in (1, 50, 1 << 20):  # ranges of any size give the same records
        rows = warc.read(files, range_bytes=size).collect()
        assert len(rows) == 14
        kind = {r.page_id: (r.record_type, r.refers_to) for r in rows}
        assert [kind[i] for i in (1, 2, 7, None)] == [("revisit", 7), ("revisit", 7),
                                                      ("response", None), ("revisit", 7)]
        assert [kind[i] for i in (10, 11, 9)] == [("revisit", 11), ("response", None),
                                                  ("response", None)]
        held = {(r.page_id, bytes(r.payload)) for r in rows if r.record_type == "response"}
        assert held <= want and all(r.payload is None for r in rows if r.record_type == "revisit")


def test_archives_are_gzip(spark, tmp_path):
    import gzip

    files = warc.write(pages(spark), f"file://{tmp_path}/g").collect()
    text = b"".join(gzip.open(f.path.removeprefix("file://")).read() for f in files)
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == 14


def test_false_magic_is_no_member():
    one = warc.record(1, "u", b"payload", warc.hashlib.sha1(b"payload").hexdigest(), None)
    data = b"junk\x1f\x8b\x08junk" + one + zlib.compress(b"x") + one

    class Held(io.BytesIO):
        def read_at(self, n, at):
            self.seek(at)
            return self.read(n)

    got = [warc.parsed(m)["payload"] for m in warc.members(Held(data), len(data), 0, len(data))]
    assert got == [b"payload", b"payload"]


def test_archives_empty(spark):
    assert warc.round_trip(pages(spark).limit(0)).count() == 0
