"""Byte-level BPE against the tiktoken library, round trips, and edge cases."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as ent
from sessionlab.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def file():
    with open(PATH, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(file):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(file), special_tokens={})


def test_random_texts_equal_the_library(file, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 50)       # generations change all the time
    encoder, decoder = byte_bpe.Encoder(file, public_tokenizers.PATTERN), byte_bpe.Decoder(file)
    draw = random.Random(5)
    for _ in range(2000):
        letters = draw.choice(["ab", "abcdefgh ", "é漢字🙂 \n\t1'sSllreve", "    \n\r", " !?#.,", "\x00\x1c  　 x", "aaaaab"])
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(80)))
        ids = encoder.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert decoder.decode(ids) == text.encode()


def test_leftmost_of_equal_ranks():
    ranks = {bytes([c]): c for c in range(256)} | {b"aa": 256, b"ba": 257, b"aab": 258}
    for text in (b"aaaa", b"aaaaa", b"baaab", b"aabaab", b"abababa"):
        parts = [bytes([c]) for c in text]
        while pairs := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:
            _, i = min(pairs)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        assert byte_bpe.merge(text, ranks) == [ranks[p] for p in parts]


def test_short_pieces_merge_as_long_ones(file, monkeypatch):
    """Up to ``SHORT`` bytes the pairs are searched without a tree: the same tokens."""
    ranks, draw = byte_bpe.ranks_of(file), random.Random(7)
    assert byte_bpe._merge_short(b"", ranks) == [] and byte_bpe._merge_short(b"a", ranks) == [ranks[b"a"]]
    pieces = [bytes(draw.choice(draw.choice([b"ab", b"strengthening", bytes(range(256))])) for _ in range(draw.randrange(2, byte_bpe.SHORT + 1)))
              for _ in range(500)]
    short = [byte_bpe.merge(p, ranks) for p in pieces]
    monkeypatch.setattr(byte_bpe, "SHORT", 1)
    assert [byte_bpe.merge(p, ranks) for p in pieces] == short


def test_long_texts(file, library, monkeypatch):
    encoder, decoder = byte_bpe.Encoder(file, public_tokenizers.PATTERN), byte_bpe.Decoder(file)
    run = "z" * 200_000                                     # one piece
    assert decoder.decode(encoder.encode(run)) == run.encode()
    assert encoder.encode(run[:3000]).tolist() == library.encode_ordinary(run[:3000])
    text = "Il y a 12 mots, don't they?  \n\n  " * 300
    monkeypatch.setattr(byte_bpe, "LONG_CHARS", 100)
    monkeypatch.setattr(byte_bpe, "SLICE_PIECES", 7)
    assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = ent.queries()["op12_byte_bpe"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_edges(spark, library):
    rows = [(1, None, "x", 1), (None, "", None, 2), (3, "same", "y", 3), (3, "same", "y", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, _rest int")
    out = byte_bpe.encode(df, PATH, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "_rest", "ids"]
    got = byte_bpe.decode(out.withColumn("decoded", F.lit(1)), PATH).collect()
    assert sorted((r.doc_id or 0, r.ids, bytes(r.decoded), r._rest) for r in got) == [
        (0, [], b"", 2), (1, [], b"", 1), *[(3, library.encode_ordinary("same"), b"same", 3)] * 2]
    assert byte_bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).collect() == []
    wrong = spark.createDataFrame([([0, 60_000],)], "ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(wrong, PATH).collect()
    assert bytes(byte_bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), PATH).first().decoded) == b""
