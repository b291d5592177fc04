"""The queries of this folder, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mosaique.llm import brown, html_text, langid, line_dedup, media, near_dups, packing, periodic, quality, token_counts, toxicity, unigram, whitening
from mosaique.llm.common import documents, remainder, shared_path
from mosaique.llm.tokens import public_path


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language(documents(spark, sf_dir), remainder(4) == 2)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(documents(spark, sf_dir))


def op5_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(documents(spark, sf_dir))


def op6_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.class_scores(documents(spark, sf_dir), remainder(10) == 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(documents(spark, sf_dir), labels, remainder(3) == 1)


def op8_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.encoded(documents(spark, sf_dir), public_path("piece_bpe_32k.model"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), public_path("word_bpe_49k.json"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), shared_path(spark, "token-cache"), public_path("piece_bpe_32k.model"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(line_dedup.dedup_lines(documents(spark, sf_dir)))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.summary(periodic.periodic_runs(periodic.planted(documents(spark, sf_dir))))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_language_id,
        op3_html_text,
        op4_media_columns,
        op5_near_dups,
        op6_class_scores,
        op7_toxicity,
        op8_unigram,
        op9_packing,
        op10_token_counts,
        op11_whitening,
        op12_line_dedup,
        op13_periodic_runs,
    )
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Near-duplicates as SQL says them: shingles as texts, pairs that share one, exact similarity, and what is reached by links.
NEAR_DUPS = rf"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM words WHERE len(w) > 0) z),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n"""

#: Lines that three documents or more share: positions, keys, exact counts, and what is left joined again.
LINE_DEDUP = rf"""WITH lines AS (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents) t),
keyed AS (SELECT doc_id, line, i, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS k FROM lines),
shared AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT keyed.*, coalesce(keyed.doc_id <> shared.keeper, false) AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM marked GROUP BY doc_id"""

#: Models, tokenizers, sound, eigenvectors and suffix arrays have no SQL; brute-force tests stand for it.
SQL: dict[str, str] = {"op5_near_dups": NEAR_DUPS, "op12_line_dedup": LINE_DEDUP}
