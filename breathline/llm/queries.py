"""One query per operator, over its whole table."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from breathline.llm import (
    ann, bpe, exact, fill_middle, jaccard, language, licenses, packing, repeats, resample, secret_scan, shards, toxicity,
)
from breathline.llm.base import shipped, table

QUERIES = {}
ORACLE = {}

SHARDS = 16


def query(function):
    @wraps(function)
    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(shipped(spark), sf_dir)

    QUERIES[function.__name__] = run_query
    return run_query


@query
def op1_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


ORACLE["op4_chunk_recipes"] = r"""
WITH shaped AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), ranked AS (
  SELECT doc_id, norm, row_number() OVER (PARTITION BY norm, doc_id) AS again,
         min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
  FROM shaped
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AND again = 1 AS kept, sha256(norm) AS text_sha256 FROM ranked
"""


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = shards.document_points(table(spark, sf_dir, "documents"))
    return shards.kd_shards(points, ["lang", "source", "length"], SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op7_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan_secrets(docs, secret_scan.labelled_findings(docs)).withColumn(
        "found_sha256", F.sha2("found", 256)
    ).drop("found")


@query
def op8_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), width=3, shared=90, of=100)


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op10_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN))


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.importance_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The checksum of a word is folded over its bytes with the polynomial's table, which is made by its rule.
ORACLE["op11_importance_resampling"] = r"""
WITH crc_table AS MATERIALIZED (
  SELECT list(value ORDER BY byte) AS crcs FROM (
    SELECT byte, list_reduce(list_concat([byte], range(8)),
                             lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS value
    FROM (SELECT unnest(range(256)) AS byte)
  )
), texts AS MATERIALIZED (
  SELECT 'd' AS side, doc_id, row_number() OVER () AS row, text FROM documents
  UNION ALL SELECT 't', NULL, -row_number() OVER (), text FROM benchmark
), found AS MATERIALIZED (
  SELECT side, row, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM texts
), hashed AS MATERIALIZED (
  SELECT word, xor(list_reduce(
           list_concat([4294967295], list_transform(range(1, length(hex(word)), 2), lambda i: ('0x' || substr(hex(word), i, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, crcs[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM found), crc_table
), counted AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t
  FROM found JOIN hashed USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counted) + 10000)::DOUBLE
                        / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counted) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM counted
), weights AS (
  SELECT row, count(*) AS n_features, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
  FROM found JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((
           ('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE
         ) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM texts LEFT JOIN weights USING (row) WHERE side = 'd'
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
         count(*) FILTER (n_features >= 20) OVER () AS able
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank
FROM ranked
"""


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    back = fill_middle.restored(F.col("form"), F.col("output"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


ORACLE["op12_fill_in_middle"] = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n, ('0x' || substr(digest, 1, 8))::BIGINT % (len(units) + 1) AS one,
         ('0x' || substr(digest, 9, 8))::BIGINT % (len(units) + 1) AS two,
         ('0x' || substr(digest, 17, 8))::BIGINT % 100 AS third, ('0x' || substr(digest, 25, 8))::BIGINT % 100 AS fourth
  FROM cut
), pieces AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR third >= 100
                 THEN 'plain' WHEN fourth < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[:least(one, two)], '') AS prefix,
         array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
         array_to_string(units[greatest(one, two) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces
"""


@query
def op13_language_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_language(table(spark, sf_dir, "documents"))
