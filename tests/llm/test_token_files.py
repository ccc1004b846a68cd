import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from playlog.llm import elias_fano, token_files
from playlog.llm.queries import QUERIES
from playlog.session import scratch_path
from tests.llm import helpers as H
from tests.llm.test_bpe import TRICKY

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return t


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-2 ** 62, 2 ** 62), max_size=600), st.booleans())
def test_elias_fano_round_trip(values, dense):
    v = sorted(x % 1000 if dense else x for x in values)
    data = b"xx" + elias_fano.encode(np.asarray(v, np.int64)) + b"yy"
    r = elias_fano.Reader(data, 2)
    assert r.all().tolist() == v and [r[i] for i in range(len(r))] == v
    assert r.end == len(data) - 2
    with pytest.raises(IndexError):
        r[len(v)]


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 2000, 20_000))
    assert len(elias_fano.encode(ends)) * 8 / len(ends) < 14  # 64 as plain integers


def test_pieces_as_whole_texts(plain):
    enc = token_files.PieceEncoder(FILE, public_tokenizers.PATTERN, most=50)
    texts = [t or "" for _, t in H.odd_texts()] + TRICKY
    for _ in range(2):  # the second time from the cache
        assert [np.frombuffer(b, "<u2").tolist() for b in enc.encode(texts)] == [
            plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_letters_of_any_unicode_version(plain):
    enc = token_files.PieceEncoder(FILE, public_tokenizers.PATTERN)
    points = [*range(0x20, 0x3000, 7), 0x558, 0x88F, 0xA7CE, 0x10EC5, 0x1DF20, 0x323B0, 0x1F600]
    texts = [f"a{chr(p)}1 {chr(p)}b! {chr(p)}{chr(p)}2 end" for p in points]
    assert [np.frombuffer(b, "<u2").tolist() for b in enc.encode(texts)] == [
        plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_write_and_read(spark, plain):
    rows = H.odd_texts()
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write(H.docs(spark, rows, clash=True), FILE, public_tokenizers.PATTERN, 2, folder, most_bytes=300)
    assert manifest.count() > 2
    found = token_files.located(token_files.read(spark, manifest, folder), manifest).orderBy("start").collect()
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(plain.encode(t or "", add_special_tokens=False).ids + [2])
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))  # nulls first
    at = 0
    for r in found:
        mine = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert r["start"] == at and r["n_tokens"] == len(mine)
        want[r["doc_id"]].remove(mine)
        at += len(mine)
    assert not any(want.values())


def test_added_tokens_as_the_library_gives_them(spark):
    lib = Tokenizer.from_file(FILE)
    texts = ["one<|endoftext|>two", "<|endoftext|>", "a <|endoftext|> b  c", "one <|endoftext two"]
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in want[0]
    enc = token_files.PieceEncoder(FILE, public_tokenizers.PATTERN, special_as_text=False)
    assert [np.frombuffer(b, "<u2").tolist() for b in enc.encode(texts)] == want
    folder = scratch_path(spark, "tokens")
    docs = H.docs(spark, list(enumerate(texts)))
    manifest = token_files.write(docs, FILE, public_tokenizers.PATTERN, 2, folder)
    found = token_files.located(token_files.read(spark, manifest, folder), manifest).orderBy("start").collect()
    assert [np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in found] == [x + [2] for x in want]


def test_shard_reads_in_place(plain):
    kind = np.dtype("<u2")
    bodies = [np.asarray(x, kind).tobytes() for x in ([1, 2, 3], [], [7])]
    s = token_files.Shard(token_files.shard_bytes([None, 4, 9], bodies, kind))
    assert [s.doc_id(i) for i in range(3)] == [None, 4, 9]
    assert [s.document(i).tolist() for i in range(3)] == [[1, 2, 3], [], [7]]


def test_empty_table(spark):
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write(H.empty(spark), FILE, public_tokenizers.PATTERN, 2, folder)
    assert token_files.located(token_files.read(spark, manifest, folder), manifest).count() == 0


def test_query(spark, sf_small, plain):
    got = QUERIES["op7_token_files"](spark, sf_small).orderBy("doc_id").collect()
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect())
    at = 0
    for r, (i, t) in zip(got, docs, strict=True):
        ids = plain.encode(t, add_special_tokens=False).ids + [2]
        assert tuple(r) == (i, at, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()))
        at += len(ids)
