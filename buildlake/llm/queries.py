"""Thin queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buildlake.llm import importance, licenses, media, merkle, near_dedup, packing, pieces, private_spans, quality_classifier, quality_rules, sharding, substrings, token_counts

BPE_JSON, BPE_RANKS, PIECE_MODEL = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), k=4).drop("links")


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(_table(spark, sf_dir, "documents")).drop("tile")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(_table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(_table(spark, sf_dir, "documents"), 8)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``spark.buildlake.tokenCache``: a folder whose counts are kept from run to run; else each run has a new one."""
    path = public_tokenizers.path
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), path(BPE_JSON), path(BPE_RANKS), spark.conf.get("spark.buildlake.tokenCache", None))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return packing.pack_documents(_table(spark, sf_dir, "documents"), path(BPE_JSON), path(BPE_RANKS))


def op11_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_spans.span_report(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row whose id's CRC-32 is a multiple of 7 is shown with one more in n_chars."""
    shown = merkle.one_more("n_chars", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)
    return merkle.merkle_manifest(_table(spark, sf_dir, "documents"), claimed=shown)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_near_dedup, op2_media_columns, op3_license_scan, op4_quality_classifier, op5_quality_rules, op6_sentencepiece, op7_substring_dedup, op8_sharding, op9_token_counts, op10_packing, op11_private_spans, op12_merkle_manifest, op13_importance_resampling)
}

# CRC-32 in SQL: its table from the polynomial, then a fold over the bytes of a word
_CRC_TABLE = """
    SELECT list(c ORDER BY i) AS crcs
    FROM (SELECT i, list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)) AS c FROM range(256) r(i))"""
_CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, octet_length(encode({word})) + 1),
            lambda k: ('0x' || substr(hex(encode({word})), 2 * k - 1, 2))::UBIGINT)), lambda a, b: xor(a >> 8, crcs[(xor(a, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT)"""
_LEAF = f"sha256(concat({', '.join(f"coalesce(octet_length(encode({v}))::VARCHAR || ':' || {v}, '-')" for v in ('doc_id::VARCHAR', 'source', 'lang', '{n_chars}::VARCHAR', 'text'))}))"

ORACLE_SQL: dict[str, str] = {
    # all pairs that share a shingle, then what each document reaches
    "op1_near_dedup": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
    FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), numbered AS (SELECT doc_id, md5_number(s) AS s FROM shingles
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM numbered a JOIN numbered b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
), least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
""",
    # levels of the trees of each lang and of the tree over them; every document's path and what it folds to
    "op12_merkle_manifest": rf"""
WITH RECURSIVE crc_table AS ({_CRC_TABLE}
), leaves AS (
    SELECT doc_id, lang, {_LEAF.format(n_chars="n_chars")} AS leaf,
        CASE WHEN {_CRC.format(word="doc_id::VARCHAR")} % 7 = 0 THEN {_LEAF.format(n_chars="(n_chars + 1)")} END AS shown
    FROM documents, crc_table
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), nodes AS (
    SELECT lang, 0 AS level, i, n, leaf AS h FROM numbered
    UNION ALL
    SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY lang, level, i // 2, n
), subroots AS (
    SELECT lang, level AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER () AS m FROM nodes WHERE n = 1
), over AS (
    SELECT 0 AS level, g AS i, m AS n, subroot AS h FROM subroots
    UNION ALL
    SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM over WHERE n > 1 GROUP BY level, i // 2, n
), places AS (
    SELECT doc_id, l.lang, leaf, coalesce(shown, leaf) AS shown, i, n, height, subroot, g, m, row_number() OVER () AS id
    FROM numbered l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
), siblings AS (
    SELECT id, s.level, s.h, (p.i >> s.level) & 1 AS on_right FROM places p JOIN nodes s ON p.lang IS NOT DISTINCT FROM s.lang AND s.i = xor(p.i >> s.level, 1)
    UNION ALL
    SELECT id, p.height + s.level, s.h, (p.g >> s.level) & 1 FROM places p JOIN over s ON s.i = xor(p.g >> s.level, 1)
), proofs AS (SELECT id, sha256(string_agg(h, '' ORDER BY level)) AS proof FROM siblings GROUP BY id
), folded AS (
    SELECT id, 0 AS level, shown AS h FROM places
    UNION ALL
    SELECT f.id, f.level + 1, sha256(CASE WHEN s.h IS NULL THEN f.h WHEN on_right = 1 THEN s.h || f.h ELSE f.h || s.h END)
    FROM folded f JOIN places p ON p.id = f.id LEFT JOIN siblings s ON s.id = f.id AND s.level = f.level
    WHERE f.level < p.height + (SELECT max(level) FROM over)
), ends AS (SELECT id, arg_max(h, level) AS folded_root FROM folded GROUP BY id)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM places JOIN ends USING (id) LEFT JOIN proofs USING (id), (SELECT h AS root FROM over WHERE n = 1)
""",
    # words of all texts, gains by bucket, then the draw
    "op13_importance_resampling": rf"""
WITH crc_table AS ({_CRC_TABLE}
), words AS (
    SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), wanted AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
), source AS (SELECT w, count(*) AS s FROM (SELECT unnest(w) AS w FROM words) GROUP BY w
), target AS (SELECT w, count(*) AS t FROM wanted GROUP BY w
), counted AS (
    SELECT w, coalesce(s, 0) AS s, coalesce(t, 0) AS t, {_CRC.format(word="w")} % 10000 AS bucket FROM (source FULL JOIN target USING (w)), crc_table
), totals AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM counted GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM totals
), weighed AS (
    SELECT id, count(*) AS n, sum(gain) AS total FROM (SELECT id, unnest(w) AS w FROM words) JOIN counted USING (w) JOIN gains USING (bucket) GROUP BY id
), scored AS (
    SELECT id, doc_id, coalesce(n, 0) AS n_features, CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END::BIGINT AS weight,
        floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296)))::BIGINT AS noise
    FROM words LEFT JOIN weighed USING (id)
), able AS (
    SELECT id, row_number() OVER (ORDER BY weight + noise DESC, doc_id NULLS FIRST) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, weight + noise AS score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN able USING (id)
""",
}
