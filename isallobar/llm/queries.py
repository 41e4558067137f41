"""The registered query of each operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isallobar.llm import ann, bpe, licences, packing, pii, quality, simhash, token_output, warc, webp
from isallobar.llm.common import table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the public vocabulary file lies on this machine and every executor."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_lossless_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webp.read_media(webp.media_table(table(spark, sf_dir, "documents")))


def op2_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def op3_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op5_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op6_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_bundles(warc.write_bundles(table(spark, sf_dir, "pages")))


def op7_batched_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op8_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op10_packed_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.packed_matrices(table(spark, sf_dir, "documents"), vocabulary_path())


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_lossless_webp, op2_bin_completion, op3_fourier_quality, op4_boosted_pii, op5_rotated_codes, op6_seekable_warc, op7_batched_bpe, op8_simhash_blocks, op9_licence_digests, op10_packed_matrices, pipeline)
    return {f.__name__: f for f in own}


BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: A SHA-1 is eight groups of five hexadecimal digits, each of them four base32 digits.
DIGEST_SQL = " || ".join(f"'{BASE32}'[1 + ((('0x' || h[{5 * g + 1}:{5 * g + 5}])::INT >> {15 - 5 * k}) & 31)]" for g in range(8) for k in range(4))

WARC_SQL = f"""
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS body, row_number() OVER w AS place, first_value(page_id) OVER w AS kept
  FROM pages WINDOW w AS (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST)
), named AS (SELECT *, sha1(body) AS h, place > 1 AND kept IS NOT NULL AS again FROM sized)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, {DIGEST_SQL} AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN kept END AS refers_to
FROM named
"""

NEAREST_SQL = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), measured AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_reduce(list_transform(list_zip(c.v, q.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
  FROM sound q JOIN sound c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM measured
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express; the tests hold the others against brute force."""
    return {"op5_rotated_codes": NEAREST_SQL, "op6_seekable_warc": WARC_SQL, "op9_licence_digests": licences.oracle()}
