import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cohortloom.llm import token_files
from cohortloom.llm.queries import tokenizer_path

ODD = [
    "a  b", "a   b", "\n \n x", " x", "x ", "x  ", " ", "", "a\n b", "a \nb", "<|endoftext|> hi", "a <|endo ftext|>", "\0a b \0a",
    "x\t y", "it's 's", "a \n b", "日本 語 日本", "a\n\n b", "a\x85 \x85b", "\x1c \x1c", "   x", "A\nA A\nA", "  \n", "😀 😀",
]


def test_encoder_equals_the_tokenizer():
    plain = Tokenizer.from_file(tokenizer_path())
    encoder = token_files.Encoder(tokenizer_path(), cache=50)
    rng = random.Random(3)
    alphabet = ["a", "the", " ", " ", "\n", "\t", "é", "'s", "12", "!", " ", "<|", "\r"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(400)]
    for lo in range(0, len(texts), 7):
        part = texts[lo : lo + 7]
        for text, got in zip(part, encoder.encode(part)):
            assert got.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("n", [1, 2, 63, 5000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.unique(np.random.default_rng(n).integers(-(2**62), 2**62, n))
    levels, bits = token_files.build_hash(keys)
    assert sorted(token_files.Hash(levels, bits).slots(keys)) == list(range(len(keys)))
    assert len(bits) * 8 < 5 * len(keys) + 1000


def expected(data, plain):
    out, start = [], 0
    by_key = sorted(((-(1 << 63) if k is None else k), t or "") for k, t in data)
    for key, text in by_key:
        ids = plain.encode(text, add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        out.append((key, len(ids), crc))
        start += len(ids)
    return out, start


def test_round_trip(spark, documents, tmp_path):
    plain = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(0)
    data = [(i * 7 % 501, " ".join(rng.choice("one two # three\nfour".split(" ")) for _ in range(rng.randrange(60)))) for i in range(300)]
    data += [(None, "null id"), (600, None), (601, ""), (5, "again"), (5, "again"), (-3, "x" * 20_000)]
    path = str(tmp_path / "shards")
    token_files.write_shards(documents(data), path, tokenizer_path(), shard_tokens=500)
    got = token_files.read_documents(spark, path).collect()
    want, total = expected(data, plain)
    assert sorted((-(1 << 63) if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(want)
    # starts follow the ids without gap
    ordered = sorted(got, key=lambda r: r["start"])
    at = 0
    for r in ordered:
        assert r["start"] == at
        at += r["n_tokens"]
    assert at == total
    keys = [-(1 << 63) if r["doc_id"] is None else r["doc_id"] for r in ordered]
    assert keys == sorted(keys)
    # keyed access
    for key in (-3, 0, 5, 600):
        texts = [t or "" for k, t in data if k == key]
        found = token_files.fetch(spark, path, key)
        assert sorted(f.tolist() for f in found) == sorted(plain.encode(t, add_special_tokens=False).ids + [2] for t in texts)
    assert token_files.fetch(spark, path, 99_999) == []


def test_empty_table(spark, documents, tmp_path):
    token_files.write_shards(documents([]), str(tmp_path / "none"), tokenizer_path())
    assert token_files.read_documents(spark, str(tmp_path / "none")).count() == 0


def test_symbols_at_the_end_are_learnt_by_themselves():
    """A word is encoded once, whatever symbols come after it."""
    texts = ["walk, walk. walk!? (walk) walk's walk_\nwalk; walk2. é, é.", "'walk' walk'' wálk... ́walḱ, 中, x中.", "", " walk, "]
    encoder = token_files.Encoder(tokenizer_path())
    got = encoder.encode(texts)
    assert [g.tolist() for g in got] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert "walk" in encoder.known and {",", ".", "!?"} <= encoder.tails.keys()
