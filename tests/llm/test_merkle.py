"""The Merkle manifest against trees built in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from meterbook.llm import merkle
from meterbook.llm.queries import op11_merkle_manifest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, at):
    out = []
    for level in tree[:-1]:
        other = at ^ 1
        out.append((level[other] if other < len(level) else None, at & 1))
        at >>= 1
    return out


def expected(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of every row."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[lang] = levels([leaf(r) for r in groups[lang]])
    top = levels([trees[g][-1][0] for g in langs])
    out = []
    for k, lang in enumerate(langs):
        for at, r in enumerate(groups[lang]):
            way = siblings(trees[lang], at) + siblings(top, k)
            changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node = leaf({**r, "n_chars": r["n_chars"] + 1} if changed and r["n_chars"] is not None else r)
            for other, right in way:
                node = sha(node) if other is None else sha(other + node if right else node + other)
            proof = sha("".join(s for s, _ in way if s))
            out.append((r["doc_id"], leaf(r), trees[lang][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def found(spark, folder):
    return sorted((tuple(r) for r in op11_merkle_manifest(spark, folder).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def write(spark, tmp_path, rows, schema=SCHEMA):
    spark.createDataFrame([tuple(r.values()) for r in rows], schema).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def row(id, lang, text="x", n=3, source="s"):
    return {"doc_id": id, "source": source, "lang": lang, "n_chars": n, "text": text}


def test_query_equals_plain_trees(spark, small):
    rows = [r.asDict() for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = found(spark, small)
    assert got == expected(rows)
    assert {r[-1] for r in got} == {True, False}


def test_more_than_one_round_of_slots(spark, tmp_path):
    random.seed(3)
    ids = [random.randrange(-(1 << 62), 1 << 62) for _ in range(700)] + list(range(1800))
    rows = [row(i, "a", f"t{i}") for i in ids] + [row(i, "b", "é" * (i % 5)) for i in range(1025)] + [row(7, "c")]
    assert found(spark, write(spark, tmp_path, rows)) == expected(rows)


def test_nulls_ties_and_repeated_rows(spark, tmp_path):
    random.seed(4)
    rows = [row(None, None, "a"), row(None, None, "b"), row(None, None, "b"), row(3, None, None, None, None), row(3, "", "", 0, ""), row(None, "", "z"),
            row(-5, "é"), row(-5, "é", "other"), row(-5, "é"), row(63, "é"), row(64, "é"), row((1 << 63) - 1, "é"), row(-(1 << 63), "é")]
    rows += [row(random.choice([None, 1, 2, 2, 2, 65, 4097, 70]), random.choice(["x", "x", "y"]), random.choice("abc")) for _ in range(400)]
    assert found(spark, write(spark, tmp_path, rows)) == expected(rows)


def test_copies_in_several_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 7)
    rows = [row(1, "x") for _ in range(50)] + [row(1, "x", "y") for _ in range(20)] + [row(2, "x")]
    assert found(spark, write(spark, tmp_path, rows)) == expected(rows)


def test_single_leaf_and_long_text(spark, tmp_path):
    rows = [row(9, "x", "word " * 400_000)]
    assert found(spark, write(spark, tmp_path, rows)) == expected(rows)


def test_empty_table(spark, tmp_path):
    assert found(spark, write(spark, tmp_path, [])) == []


def test_directory_of_sparse_ids(spark):
    ids = [-(1 << 63), -1, 0, 5, 1 << 20, 1 << 40, (1 << 40) + 1, (1 << 63) - 1]
    rows = spark.createDataFrame([("=x", i, f"{i}", "") for i in ids], "tree string, id long, leaf string, start string")
    assert [(r["id"], r["at"]) for r in merkle.coordinates(rows).orderBy("id").collect()] == list(zip(ids, range(len(ids)), strict=True))


def test_clashing_columns_and_text_ids(spark):
    names = ["tree", "id", "leaf", "start", "at", "node", "path", "top", "word", "page", "entries", "before", "block", "root"]
    docs = spark.createDataFrame([row(i, "x") for i in range(3)], SCHEMA).withColumns({n: F.lit(1) for n in names})
    plain = docs.select(*FIELDS)
    assert sorted(map(str, merkle.prove(docs).collect())) == sorted(map(str, merkle.prove(plain).collect()))
    with pytest.raises(TypeError):
        merkle.prove(docs.withColumn("doc_id", F.lit("a")))
