"""Packing: nothing is lost, rows are full, the tree finds the best fit."""

import random
from collections import defaultdict

import numpy as np

from meterbook.llm import packing
from meterbook.llm.queries import op2_token_packing


def texts_of(rows, length):
    pieces = defaultdict(dict)
    for r in rows:
        ids, position = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(position) == length and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= length
        for doc, piece, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            assert position[a:b].tolist() == list(range(b - a)) and piece not in pieces[doc]
            pieces[doc][piece] = ids[a:b].tolist()
        assert not position[r.n_tokens:].any()
    coder, end = packing.encoder(packing.TOKENIZER)
    out = {}
    for doc, parts in pieces.items():
        ids = [x for k in range(len(parts)) for x in parts[k]]
        assert ids[-1] == end and end not in ids[:-1]
        out[doc] = coder.decode(ids[:-1])
    return out


def test_query_round_trip(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op2_token_packing(spark, small).collect()
    assert texts_of(rows, packing.LENGTH) == texts and len({r.pack_id for r in rows}) == len(rows)


def test_blocks_odd_texts_and_extra_columns(spark):
    texts = [(1, "<|endoftext|> plain"), (2, "é𝒳\x00日本" * 400), (3, "a" * 30_000), (4, " \n "), (5, "word " * 2000)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, n_tokens int")
    for block in (200, 4_000_000):
        assert texts_of(packing.pack_documents(docs, length=128, block_tokens=block).collect(), 128) == dict(texts)
    nulls = packing.pack_documents(spark.createDataFrame([(None, None), (7, "")], "doc_id long, text string").coalesce(1)).collect()
    assert [sorted(r.doc_ids, key=str) for r in nulls] == [[7, None]] and packing.pack_documents(docs.limit(0)).count() == 0


def test_best_fit_decreasing_equals_a_plain_search():
    random.seed(2)
    for _ in range(40):
        length = random.choice([7, 16, 100])
        sizes = [random.randint(1, length) for _ in range(random.randint(0, 120))]
        free, rows = [], []
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            fits = [(f, k) for k, f in enumerate(free) if f >= sizes[i]]
            if fits:
                least = min(f for f, _ in fits)
                free[next(k for f, k in fits if f == least)] -= sizes[i]
            else:
                free.append(length - sizes[i])
        rows = packing.pack(sizes, length)
        assert sorted(i for r in rows for i in r) == list(range(len(sizes))) and all(sum(sizes[i] for i in r) <= length for r in rows)
        assert len(rows) == len(free)
