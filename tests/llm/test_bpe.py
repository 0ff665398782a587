"""Byte-level BPE by a serialised model against the tiktoken library, and back."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from meterbook.llm import bpe
from meterbook.llm.queries import op12_byte_bpe


@pytest.fixture(scope="module")
def tokens():
    return bpe.vocabulary()


@pytest.fixture(scope="module")
def reference(tokens):
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


@pytest.fixture(scope="module")
def codec(tokens):
    return bpe.Codec(bpe.serialise(tokens), public_tokenizers.PATTERN)


def ids(reference, text):
    return np.array(reference.encode_ordinary(text or ""), "<u4").tobytes()


def test_fixed_values():
    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_query_equals_the_library(spark, small, reference):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    want = {i: (len(ids(reference, t)) // 4, hashlib.sha256(ids(reference, t)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in texts.items()}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op12_byte_bpe(spark, small).collect()} == want


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(" \t\n\r\x00\x1c\x85 'sdltv1!_▁Ġé中"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(codec, reference, text):
    coded = codec.encode([text])[0]
    assert coded == ids(reference, text)
    assert codec.decode(coded) == text.encode()


@pytest.mark.parametrize("text", [
    "a" * 100_000, " " * 50_000 + "x", "\n" * 5_000, "ab " * 50_000, "<|endoftext|> <unk> </s>", "don't  DON'T\t x\x00 y", " lead", "trail ", "a \x1c b\x1c c"])
def test_long_and_odd_texts(codec, reference, text):
    assert codec.encode([text])[0] == ids(reference, text)


def test_every_token_is_reached_or_known(codec, tokens, reference):
    whole = {t: [i] for i, t in enumerate(tokens)}
    assert all(codec.bytes[i] == t for t, (i,) in whole.items())
    assert all(reference.encode_single_token(tokens[i]) == i for (i,) in codec.whole.values())


def test_tokens_that_merges_do_not_lead_to():
    base = [bytes([b]) for b in range(256)]
    tokens = [*base, b"abc", b"bc"]  # "abc" comes first as a whole, but a + bc joins it, and "xyz" below is never joined
    tokens += [b"xyz"]
    codec = bpe.Codec(bpe.serialise(tokens), public_tokenizers.PATTERN)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    for text in ("abc", "xyz", "xyzxyz", "aabcbc", " xyz"):
        assert codec.encode([text])[0] == np.array(own.encode_ordinary(text), "<u4").tobytes()
    assert codec.whole


def test_memory_of_parts_is_bounded(codec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 50)
    random.seed(1)
    texts = [" ".join(random.choice("abcdef") * random.randrange(1, 90) for _ in range(40)) for _ in range(20)]
    for text in texts:
        assert codec.encode([text, None, ""]) == [ids(reference, text), b"", b""]
        assert len(codec.known) < 200 and all(len(t) <= bpe.KEPT_LENGTH for t in codec.known)


def test_nulls_repeats_clashes_and_empty_tables(spark, reference):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None), (2, "")], "doc_id long, text string")
    docs = docs.withColumns({n: F.lit(0) for n in ("id", "ids", "n_tokens", "bytes")})
    coded = bpe.encode_documents(docs)
    assert sorted(((r.doc_id or 0, r.n_tokens, bytes(r.ids)) for r in coded.collect())) == sorted(
        [(1, 2, ids(reference, "a b"))] * 2 + [(0, 0, b""), (2, 0, b"")])
    back = bpe.decode_documents(coded.union(spark.createDataFrame([(3, None, None)], coded.schema)))
    assert sorted((r.doc_id or 0, bytes(r["bytes"])) for r in back.collect()) == [(0, b""), (1, b"a b"), (1, b"a b"), (2, b""), (3, b"")]
    assert bpe.decode_documents(bpe.encode_documents(docs.limit(0))).collect() == []


def test_ranks_must_be_gapless(tmp_path, monkeypatch):
    path = tmp_path / "gap.tiktoken"
    path.write_text("YQ== 0\nYg== 2\n")
    monkeypatch.setattr(public_tokenizers, "path", lambda name: str(path))
    with pytest.raises(ValueError):
        bpe.vocabulary("gap.tiktoken")
