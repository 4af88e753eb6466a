"""Encoding against tiktoken, long words against the plain merge, and the round trip."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyhouse.llm import byte_bpe, queries

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


def digest(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def test_table_is_proper():
    ranks = byte_bpe.read_ranks(PATH)
    assert len(byte_bpe.ranked_merges(ranks)) == len(ranks) - 256
    single = {bytes([i]): i for i in range(256)}
    for odd in ({b"abc": 300}, {b"ab": 300, b"abc": 299}):
        with pytest.raises(ValueError):
            byte_bpe.ranked_merges(single | odd)
    with pytest.raises(ValueError):
        byte_bpe.ranked_merges({b"a": 0})


@pytest.mark.parametrize("head", [0, 20, byte_bpe.HEAD])
def test_against_the_library(spark, documents, edge_cases, library, head):
    more = [(20, "it's  we'll\t\n\n x"), (21, "   \x85 a"), (22, "\x00 nul \x01"), (23, "日本語のテキスト здравствуйте мир"), (24, "<|endoftext|> 12345678 ٣٤٥ ½"), (25, "👩‍👩‍👧 é ﬁ")]
    rows = [r for r in edge_cases if r[0] != 9] + more
    got = byte_bpe.decode(byte_bpe.encode(documents(rows), PATH, PATTERN, keep=("doc_id", "n_chars", "_text"), head=head), PATH).collect()
    found = sorted((str(r.doc_id), tuple(r.ids), bytes(r.decoded), bytes(r.ids_le)) for r in got)
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((str(i), tuple(ids), (t or "").encode(), struct.pack(f"<{len(ids)}I", *ids)))
    assert found == sorted(want)


def test_long_words(spark, library):
    r = random.Random(5)
    words = ["a" * 700, "ab" * 350, "abc" * 200, "-" * 401, " " * 700 + "x", "".join(r.choice("etaoinshr") for _ in range(900)), "".join(r.choice("ABCdefghXYZé") for _ in range(400)), "漢字" * 80, "x" * byte_bpe.WINDOW, "y" * (byte_bpe.WINDOW + 1), "0123456789" * 60]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id int, text string").repartition(8)
    got = {row.doc_id: list(row.ids) for row in byte_bpe.encode(docs, PATH, PATTERN, head=0).collect()}
    assert got == {i: library.encode_ordinary(w) for i, w in enumerate(words)}


def test_empty_table_and_nulls(spark, documents):
    assert byte_bpe.encode(documents([]), PATH, PATTERN).count() == 0
    frame = spark.createDataFrame([(None,), ([],), ([0, None, 1],)], "ids array<int>")
    ranks = {v: k for k, v in byte_bpe.read_ranks(PATH).items()}
    assert [r.decoded and bytes(r.decoded) for r in byte_bpe.decode(frame, PATH).collect()] == [None, b"", ranks[0] + ranks[1]]


def test_the_query(spark, sf_dir, library):
    docs = {r.doc_id: r.text or "" for r in queries.table(spark, sf_dir, "documents").collect()}
    got = queries.op13_byte_bpe(spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for r in got.collect():
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(struct.pack(f"<{len(ids)}I", *ids)), digest(docs[r.doc_id].encode()))
