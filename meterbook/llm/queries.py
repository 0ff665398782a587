"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, hosts, licenses, line_crf, merkle, mixing, packing, phrases, private, shards, simhash, templates, toxicity
from .samples import HELD_OUT, fold
from .shared import table


def op1_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the fixed forms, and what their contexts discover."""
    found = private.extract_private(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.array(*[F.lit(k) for k in private.KINDS])
    text = lambda array: F.array_join(F.transform(array, lambda s: F.concat_ws(
        ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        rank = private.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in private.KINDS], F.sha2(text(F.col("base")), 256).alias("base_sha256"),
        text(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op2_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of token ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and host verdicts of every document."""
    return hosts.judge_hosts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_rate")


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the line model, trained on the labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return line_crf.judge(docs, labels).select(
        "doc_id", (fold() == HELD_OUT).alias("held_out"), "score", F.when(F.col("score") >= line_crf.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op5_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of every document in the mixture, with its place in the global order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    copies = mixing.replicate(docs).select("doc_id", "source", F.col("copy").cast("long").alias("copy"), F.round("rate", 6).alias("rate"), "order_key")
    return mixing.in_order(copies)


def op6_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.component_ids(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards of nearly equal bytes."""
    placed = shards.shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, trained on the labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score_toxicity(docs, toxicity.train(docs, labels)).select(
        "doc_id", (fold() == HELD_OUT).alias("held_out"), "score", F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op9_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and benchmark items whose templates and values agree."""
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "found", "windows", F.round("coverage", 6).alias("coverage"), F.round("agreement", 6).alias("agreement"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(docs).select("doc_id", "license.*")
    at = F.flatten(F.transform("base", lambda b: b["at"]))
    base = F.transform("base", lambda b: b["label"])
    labels = F.array_union(base, F.transform("detections", lambda d: d["label"]))
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return found.select(
        "doc_id", "n_words", F.size(at).cast("long").alias("n_base"), F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"), joined(base).alias("base_labels"), joined(labels).alias("labels"), "score")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and way to the root, and whether a row that was tampered with, or not, still leads there."""
    docs = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    tampered = [F.col(c) + F.when(changed, 1).otherwise(0) if c == "n_chars" else F.col(c) for c in merkle.COLUMNS]
    proved = merkle.prove(docs, other=merkle.leaf(tampered))
    folded = merkle.fold(merkle.fold(F.col("start"), F.col("at"), F.col("path")), F.col("group_at"), F.col("group_path"))
    proved = proved.withColumn("folded_root", folded)
    return proved.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(F.concat("path", "group_path"), ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by the public byte-level vocabulary, and what they decode to."""
    coded = bpe.encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    decoded = bpe.decode_documents(coded)
    return decoded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of each language over all documents."""
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_private_data": op1_private_data,
        "op2_token_packing": op2_token_packing,
        "op3_host_rules": op3_host_rules,
        "op4_line_quality": op4_line_quality,
        "op5_poisson_mixing": op5_poisson_mixing,
        "op6_simhash_anchors": op6_simhash_anchors,
        "op7_histogram_shards": op7_histogram_shards,
        "op8_toxicity": op8_toxicity,
        "op9_template_decontamination": op9_template_decontamination,
        "op10_license_scan": op10_license_scan,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_byte_bpe": op12_byte_bpe,
        "op13_phrase_mining": op13_phrase_mining,
        "pipeline": pipeline,
    }


#: Mixing in plain SQL: the same rates, hashes and distribution, by a join with the terms of each source's distribution.
MIXING_SQL = f"""
WITH sums AS (SELECT source AS of, sum(length(coalesce(text, ''))) AS chars FROM documents GROUP BY source),
rated AS (SELECT of, chars, CASE WHEN chars = 0 THEN 1 ELSE sqrt(chars) / (SELECT sum(sqrt(chars)) FROM sums) * (SELECT sum(chars) FROM sums) / chars END AS rate FROM sums),
split AS (SELECT *, greatest(1, ceil(rate / {mixing.MOST_RATE}))::BIGINT AS draws FROM rated),
terms AS (SELECT of, sum(exp(-rate / draws + k * ln(rate / draws) - lgamma(k + 1))) OVER (PARTITION BY of ORDER BY k) AS below
          FROM split, range(0, {mixing.TERMS + 1}) t(k)),
drawn AS (SELECT doc_id, source, chars, rate, ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null') || CASE WHEN draw > 0 THEN ':' || draw ELSE '' END), 1, 13))::BIGINT / {1 << 52}::DOUBLE AS u
          FROM (SELECT *, unnest(range(0, draws)) AS draw FROM documents JOIN split ON of IS NOT DISTINCT FROM source)),
counted AS (SELECT doc_id, source, rate, CASE WHEN chars = 0 THEN 1 ELSE count(*) FILTER (WHERE below <= u) END AS n FROM drawn JOIN terms ON of IS NOT DISTINCT FROM source
            GROUP BY doc_id, source, rate, chars)
SELECT doc_id, source, copy, round(rate, 6) AS rate, md5('{mixing.SEED}-order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy) AS order_key
FROM (SELECT *, unnest(range(1, n + 1)) AS copy FROM counted)
"""

#: Phrase mining in plain SQL: phrases of up to three words by neighbours in a window, and their two or one cuts side by side.
PHRASES_SQL = r"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS body FROM texts),
numbered AS (SELECT lang, row_number() OVER () AS piece, string_split_regex(body, '[ \t]+') AS words FROM pieces),
placed AS (SELECT lang, piece, unnest(words) AS w, generate_subscripts(words, 1) AS place FROM numbered),
seen AS (SELECT lang, w, lead(w) OVER here AS w2, lead(w, 2) OVER here AS w3 FROM placed WHERE w <> '' WINDOW here AS (PARTITION BY piece ORDER BY place)),
one AS (SELECT lang, w, count(*) AS f FROM seen GROUP BY ALL),
two AS (SELECT lang, w, w2, count(*) AS f FROM seen WHERE w2 IS NOT NULL GROUP BY ALL),
three AS (SELECT lang, w, w2, w3, count(*) AS f FROM seen WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
around AS (SELECT lang, w, w2, max(f) AS f FROM (SELECT lang, w, w2, f FROM three UNION ALL SELECT lang, w2, w3, f FROM three) GROUP BY ALL),
pairs AS (SELECT two.lang, two.w || ' ' || two.w2 AS phrase, two.f AS a, x.f AS l, y.f AS r, 1000000::HUGEINT * two.f * two.f // (x.f::HUGEINT * y.f) AS score
          FROM two JOIN one x ON x.lang = two.lang AND x.w = two.w JOIN one y ON y.lang = two.lang AND y.w = two.w2
          LEFT JOIN around ON around.lang = two.lang AND around.w = two.w AND around.w2 = two.w2
          WHERE two.f >= 10 AND (around.f IS NULL OR 100 * around.f < 50 * two.f)),
cuts AS (SELECT t.lang, t.w || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, a1.f AS l1, b1.f AS r1, a2.f AS l2, b2.f AS r2,
                1000000::HUGEINT * t.f * t.f // (a1.f::HUGEINT * b1.f) AS s1, 1000000::HUGEINT * t.f * t.f // (a2.f::HUGEINT * b2.f) AS s2
         FROM three t JOIN one a1 ON a1.lang = t.lang AND a1.w = t.w JOIN two b1 ON b1.lang = t.lang AND b1.w = t.w2 AND b1.w2 = t.w3
         JOIN two a2 ON a2.lang = t.lang AND a2.w = t.w AND a2.w2 = t.w2 JOIN one b2 ON b2.lang = t.lang AND b2.w = t.w3),
scored AS (SELECT lang, phrase, a, l, r, score FROM pairs
           UNION ALL SELECT lang, phrase, a, if(s1 <= s2, l1, l2), if(s1 <= s2, r1, r2), least(s1, s2) FROM cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM scored),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_poisson_mixing": MIXING_SQL, "op13_phrase_mining": PHRASES_SQL}
