import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from playlog.llm import bpe
from playlog.llm import common as C
from playlog.llm.queries import QUERIES
from tests.llm import helpers as H

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def plain():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TRICKY = ["a  b", "a   b", " a", "a ", "a \n b", "\n \n", "a\n  b", "it's we'll 'S", "<|endoftext|> x", "tab\t tab",
          " nbsp  em", "x" * 5000, "1234567 89", "日本 語🙂 é", "\r\n \r\n", "a 　 b", "\x1c \x1f x"]


def test_encodes_as_the_library_and_round_trips(spark, plain):
    rows = H.odd_texts() + [(100 + i, t) for i, t in enumerate(TRICKY)]
    encoded = bpe.encode(H.docs(spark, rows, clash=True), RANKS, public_tokenizers.PATTERN, block_bytes=4000, buckets=7)
    got = bpe.decode(encoded, RANKS).collect()
    assert len(got) == len(rows)
    want = sorted((i is None, i or 0, tuple(plain.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    have = sorted((r["id"] is None, r["id"] or 0, tuple(np.frombuffer(bytes(r["ids"]), "<u4").tolist()),
                   bytes(r["decoded"])) for r in got)
    assert have == want
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in got)


def test_blocks_of_equal_words(spark, plain):
    # many blocks that hold exactly the same words
    rows = [(i, "same words again and again") for i in range(60)]
    df = H.docs(spark, rows).repartition(6).checkpoint()
    got = bpe.encode(df, RANKS, public_tokenizers.PATTERN, block_bytes=50).collect()
    ids = np.asarray(plain.encode_ordinary(rows[0][1]), "<u4").tobytes()
    assert len(got) == 60 and all(bytes(r["ids"]) == ids for r in got)


def test_code_points_as_the_library(spark, plain):
    """Before ``'s``, a letter and a digit: all code points on which splitters differ, and every 29th."""
    space, other = bpe.unlike(public_tokenizers.PATTERN)
    assert not set(space) & set(other) and "a" not in space + other
    points = sorted({*space, *other, *map(chr, (0x558, 0x58B, 0x58C, 0x88F, 0x323B0)), *C.every_character()[1::29]})
    texts = ["\n".join(f"{c}'s {c}b1{c}2" for c in points[i:i + 500]) for i in range(0, len(points), 500)]
    got = {r["id"]: bytes(r["ids"]) for r in bpe.encode(
        H.docs(spark, list(enumerate(texts))), RANKS, public_tokenizers.PATTERN).collect()}
    assert all(got[i] == np.asarray(plain.encode_ordinary(t), "<u4").tobytes() for i, t in enumerate(texts))


def test_classes_of_a_pattern():
    assert C.character_classes(public_tokenizers.PATTERN) == [r"\p{L}", r"\p{N}", r"\s"]
    assert C.character_classes(r"[^\P{Lu}\d]|\W") == [r"\d", r"\p{Lu}", r"\w"]


def test_random_texts_as_the_library(spark, plain):
    r = random.Random(4)
    space, other = bpe.unlike(public_tokenizers.PATTERN)
    pool = (list("abcXYZ019 '  \n\t.,!\u00a0\u2003\u3000\x1c\x85é日本🙂ſK") + ["'s", "'ll", " the", "\u0301"]
            + r.sample(other, min(60, len(other))) + list(space) + [chr(p) for p in (0x558, 0x58B, 0x88F, 0x323B0)])
    rows = [(i, "".join(r.choices(pool, k=r.randint(1, 40)))) for i in range(6000)]
    got = {x["id"]: bytes(x["ids"]) for x in bpe.encode(H.docs(spark, rows), RANKS, public_tokenizers.PATTERN).collect()}
    wrong = [t for i, t in rows if got[i] != np.asarray(plain.encode_ordinary(t), "<u4").tobytes()]
    assert wrong == []


def test_a_splitter_that_differs(plain):
    """A class of characters that only one splitter has: pieces with them stay whole."""
    words = bpe._Words(regex.compile(public_tokenizers.PATTERN).findall, spaces="\u2003", apart="q日")
    words.text("one two's 日's q end")
    assert list(words.number) == ["one", " two", "'s", " 日's", " q", " end"]
    words.text("a\u2003 b'c")
    assert "a\u2003 b'c" in words.number


def test_empty_and_undecodable(spark):
    assert bpe.encode(H.empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0
    df = spark.createDataFrame([(bytearray(np.array([1, 60000], "<u4").tobytes()),), (None,)], "ids binary")
    assert [r["decoded"] for r in bpe.decode(df, RANKS).collect()] == [None, None]


def test_query(spark, sf_small, plain):
    got = {r["doc_id"]: r for r in QUERIES["op3_bpe"](spark, sf_small).collect()}
    for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect():
        ids = plain.encode_ordinary(r["text"])
        g = got[r["doc_id"]]
        assert (g["n_tokens"], g["ids_sha256"], g["decoded_sha256"]) == (
            len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(r["text"].encode()).hexdigest())


def test_plain_words_are_not_looked_for():
    """A blank and ASCII letters are one match of the pattern; the numbers are those of the pattern on the whole text."""
    import public_tokenizers
    import regex

    from playlog.llm.bpe import _Words, plain_letters

    p = public_tokenizers.PATTERN
    assert plain_letters(p) and plain_letters(r" ?\p{L}+|\s+")
    assert not any(map(plain_letters, (r" a+| ?\p{L}+", r"\p{L}+", r"'(?:a| ?\p{L}+|b)", "", r" ?\p{L}+\d")))
    find, asked = regex.compile(p).findall, []
    for t in ("a plain text of words", "it's  two blanks", "don't, été über 12ab a1 x", " lead", "tail ", "a\n b\tc ", "ſ K 中文 words", "I'll've done"):
        words = _Words(lambda x: asked.append(x) or find(x), plain=True)
        codes = np.frombuffer(words.text(t), np.uint32).tolist()
        names = list(words.number)
        assert [names[c] for c in codes] == find(t)
    assert asked[0] == "a" and " plain" not in asked
