import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from cohortloom.llm import byte_bpe, queries

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
BRUTE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(*byte_bpe.prepare(RANKS), public_tokenizers.PATTERN)


def test_every_code_point_is_encoded_and_decoded_as_by_ranks(codec):
    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for k in range(0, len(chars), 20000):
        for text in ("".join(chars[k : k + 20000]), "a ".join(chars[k : k + 20000])):
            ids = codec.encode([text])[0]
            assert ids.tolist() == BRUTE.encode_ordinary(text)
            assert codec.decode(ids) == text.encode()


def test_mixed_blanks_contractions_and_scripts(codec):
    rng = random.Random(3)
    letters = " \n\t\r'sabtdvéüß漢字12　\x1c\x85!?\U0001F600\x00"
    texts = ["".join(rng.choices(letters, k=rng.randrange(300))) for _ in range(400)]
    assert [i.tolist() for i in codec.encode(texts)] == BRUTE.encode_ordinary_batch(texts)


@pytest.mark.parametrize("text", ["a" * 100_000, " " * 100_000, "ab" * 50_000 + "\n\n", "漢" * 30_000])
def test_long_runs(codec, text):
    assert codec.encode([text])[0].tolist() == BRUTE.encode_ordinary(text)


def test_forgetting_does_not_change_ids(codec, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 50)
    texts = [f"word{i} and word{i % 7} again" for i in range(200)]
    for start in range(0, 200, 20):
        some = texts[start : start + 20]
        assert [i.tolist() for i in codec.encode(some)] == BRUTE.encode_ordinary_batch(some)


def test_a_token_that_merges_do_not_reach_is_taken_whole():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"ab": 257, b"abcd": 258}
    made = byte_bpe.prepare(ranks)
    assert list(made[2]) == ["abcd"]
    small = byte_bpe.Codec(*made, r"\p{L}+|\s+")
    brute = tiktoken.Encoding("small", pat_str=r"\p{L}+|\s+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcd", "abc", "xabcd abcd", "cdab bcd"):
        assert small.encode([text])[0].tolist() == brute.encode_ordinary(text)


def test_ranks_with_gaps_keep_their_ids():
    ranks = {bytes([b]): 2 * b for b in range(256)} | {b"th": 1000, b"the": 2000}
    small = byte_bpe.Codec(*byte_bpe.prepare(ranks), r"\S+")
    assert small.encode(["the"])[0].tolist() == [2000]
    assert small.decode(np.array([2000, 2 * 33])) == b"the!"


def test_a_byte_without_a_rank_is_refused():
    with pytest.raises(ValueError):
        byte_bpe.model_message({b"a": 0})


def test_odd_rows(spark, documents):
    df = documents([(1, None), (2, ""), (3, "it's  7\n"), (3, "it's  7\n"), (None, "x")])
    encoder = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    back = encoder.decode(encoder.encode(df)).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"]).decode()) for r in back) == [
        (0, "x"), (1, ""), (2, ""), (3, "it's  7\n"), (3, "it's  7\n"),
    ]
    assert encoder.decode(encoder.encode(df.limit(0))).collect() == []
    odd = spark.createDataFrame([(1, None), (2, [999_999]), (3, [])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in encoder.decode(odd).collect()} == {1: None, 2: None, 3: bytearray()}


def test_query_equals_the_plain_tokenizer(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op11_byte_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = BRUTE.encode_ordinary(texts[r["doc_id"]])
        plain = " ".join(map(str, ids)).encode()
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(plain).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_slices_cover_a_batch_in_order(codec, monkeypatch):
    monkeypatch.setattr(byte_bpe, "SLICE", 6)
    texts = ["abc", None, "", "a longer text than a slice", "x", "yz"]
    batch = pa.record_batch([pa.array(range(6)), pa.array(texts)], names=["doc_id", "text"])
    parts = list(byte_bpe.slices(batch))
    assert len(parts) > 2 and [t for p in parts for t in p.column(1).to_pylist()] == texts
    (ids,) = codec.encode_column(batch.column(1))
    encoded = pa.record_batch([pa.array(range(6)), ids], names=["doc_id", "ids"])
    back = [d for p in byte_bpe.slices(encoded) for d in codec.decode_column(p.column(1))[1].to_pylist()]
    assert back == [(t or "").encode() for t in texts]
