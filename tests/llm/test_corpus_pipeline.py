"""The corpus pipeline stage by stage against plain versions, and its run as a whole."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterbook.llm import line_crf, mixing, packing
from meterbook.llm.shared import stored, table


#: Names that operators give columns of their own, as extra columns of the documents.
INNER = ["of", "below", "chars", "draws", "rate", "copy", "copies", "order_key", "_rate", "_draws", "_u", "_count", "_mix_of", "fp", "root", "a", "b",
         "text_key", "id", "first", "_first", "_key", "_near_id", "_crf_text", "_own_score", "score", "label", "size", "key", "shard", "item_id", "found"]


@pytest.fixture(scope="module")
def steps(spark, small):
    docs, out = table(spark, small, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, small))
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_quality(spark, small, steps):
    docs = table(spark, small, "documents")
    scores = {r.doc_id: r.score for r in line_crf.judge(docs, table(spark, small, "labels")).collect()}
    assert set(rows(steps[0])) == {i for i, s in scores.items() if s >= line_crf.THRESHOLD} and 0 < steps[0].count() < docs.count()
    assert steps[0].columns == docs.columns


def test_near_dedup(steps):
    before = rows(steps[0])
    fps = {i: brute.fingerprint(r.text) for i, r in before.items()}
    ids = sorted(fps)
    parts = brute.components(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (fps[a] ^ fps[b]).bit_count() <= 4])
    assert rows(steps[1]) == {i: before[i] for i in set(parts.values())} and len(set(parts.values())) < len(before)


def test_decontamination(spark, small, steps):
    words = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    items = [words(r.text).split() for r in table(spark, small, "benchmark").collect()]
    kept, before = rows(steps[2]), rows(steps[1])
    for i, r in before.items():
        doc = words(r.text)
        share = max(sum(" " + " ".join(t[k:k + 8]) + " " in doc for k in range(len(t) - 7)) / max(1, len(t) - 7) for t in items)
        assert (i in kept) == (share < 0.5) or 0.3 < share < 0.7
    assert 0 < len(kept) < len(before)


def test_mixing(steps):
    docs, got = rows(steps[2]), Counter(r.doc_id for r in steps[3].collect())
    chars = Counter()
    for r in docs.values():
        chars[r.source] += len(r.text)
    weight, total = sum(math.sqrt(c) for c in chars.values()), sum(chars.values())
    for i, r in docs.items():
        rate = math.sqrt(chars[r.source]) / weight * total / chars[r.source]
        assert rate <= mixing.MOST_RATE  # one draw; larger rates are tested with the operator
        u = int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:13], 16) / (1 << 52)
        n, below, term = 0, math.exp(-rate), math.exp(-rate)
        while below <= u:
            n += 1
            term *= rate / n
            below += term
        assert got[i] == n
    order = [hashlib.md5(f"{mixing.SEED}-order:{r.doc_id}".encode()).hexdigest() for r in steps[3].limit(30).collect()]
    assert order != sorted(order) and steps[3].columns == steps[2].columns


def test_packing_and_run(spark, small, steps):
    texts, wanted = {i: r.text for i, r in rows(steps[3]).items()}, Counter(r.doc_id for r in steps[3].collect())
    coder, end = packing.encoder(packing.TOKENIZER)
    pieces, got = Counter(), defaultdict(dict)
    for r in corpus_pipeline.run(spark, small).collect():
        ids = np.frombuffer(r.input_ids, "<u2")
        for doc, piece, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            pieces[doc, piece] += 1
            got[doc][piece] = ids[a:b].tolist()
    for doc, parts in got.items():
        assert coder.decode([x for k in range(len(parts)) for x in parts[k]][:-1]) == texts[doc]
        assert {pieces[doc, k] for k in parts} == {wanted[doc]}
    assert set(got) == set(wanted)


def test_every_stage_takes_an_empty_table_nulls_and_repeats(spark, small):
    docs = table(spark, small, "documents")
    odd = docs.limit(3).unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(None,) * 5, (9_000_001, "", None, None, None)], docs.schema))
    odd = odd.withColumns({c: F.lit("own") for c in INNER})
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), small).count() == 0, name
        out = stage(spark, odd, small)
        rows = out.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == odd.columns and all(r[c] == "own" for r in rows for c in INNER), name
