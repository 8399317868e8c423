"""The registered queries of this subpackage, and their DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeflux.llm import alignment, conversation_repair, decontaminate, embedding_dedup, langid, license, linededup, lm_scoring, ngram_join, packing, projection_search, substring_dedup, suffix_dedup
from lakeflux.queries.common import load

#: A tokenizer file; the folder of public tokenizers is described by its own README.
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _id_mod(n: int, k: int):
    """crc32 of the id as text leaves remainder k; null ids never do."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n == k, F.lit(False))


def fit_langid(docs: DataFrame) -> langid.Filters:
    return langid.fit(docs.where(~_id_mod(4, 2)))


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(load(spark, sf_dir, "documents"), 100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    out = langid.identify(docs.select("doc_id", "text"), fit_langid(docs))
    return out.select("doc_id", _id_mod(4, 2).alias("held_out"), "lang_pred", "score")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.deleted_spans(load(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license.scan_licenses(load(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.try_element_at("base_places", F.lit(1)).alias("first_word"),
        F.try_element_at("base_places", F.lit(-1)).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        F.to_json("expressions").alias("expressions"),
        "score",
    )


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(load(spark, sf_dir, "embeddings"), 0.93)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(load(spark, sf_dir, "documents"), ~_id_mod(7, 2))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(load(spark, sf_dir, "documents"), 3, 90)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), tokenizer_path(), 1024, 2)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removed_units(load(spark, sf_dir, "documents"), "line", 20, substring_dedup.PIECE_WORDS)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damage(rows), rows)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = tokenizer_path(), tokenizer_path(PIECES)
    return alignment.align(load(spark, sf_dir, "documents"), lambda: alignment.ByteLevel(first), lambda: alignment.Pieces(second))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_search.nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py at the repository top, over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_language_id": op3_language_id,
    "op4_line_dedup": op4_line_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_nearest_neighbours": op13_nearest_neighbours,
    "pipeline": pipeline,
}

# Lines, and pieces between cuts, that start at an earlier place of the corpus, too; offsets count UTF-8 bytes.
_OP10 = r"""
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), line_units AS (
  SELECT doc_id, unnest(range(len(parts))) AS unit, unnest(parts) AS line, len(parts) AS n FROM lines
), line_lengths AS (
  SELECT doc_id, unit, line, octet_length(encode(line)) + CASE WHEN unit + 1 < n THEN 1 ELSE 0 END AS length,
         lower(trim(regexp_replace(line, '[ \t\n\v\f\r]+', ' ', 'g'), ' ')) AS plain
  FROM line_units
), line_places AS (
  SELECT 'line' AS kind, doc_id, unit, sum(length) OVER (PARTITION BY doc_id ORDER BY unit) - length AS start, length, plain FROM line_lengths
), split AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS size, regexp_extract_all(coalesce(text, ''), '[^ \t\n\v\f\r]+') AS w,
         regexp_extract_all(coalesce(text, ''), '[ \t\n\v\f\r]+') AS g, regexp_matches(coalesce(text, ''), '^[ \t\n\v\f\r]') AS blank_first
  FROM documents
), words AS (
  SELECT doc_id, size, i, lower(w[i + 1]) AS word, octet_length(encode(w[i + 1])) AS length,
         octet_length(encode(coalesce(CASE WHEN blank_first THEN g[i + 1] WHEN i > 0 THEN g[i] END, ''))) AS gap
  FROM (SELECT *, unnest(range(len(w))) AS i FROM split)
), hashed AS (
  SELECT *, sum(gap + length) OVER d - length AS start, substr(md5(word || ' ' || lead(word) OVER d), 1, 16) AS p FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), marked AS (
  SELECT *, CASE WHEN i > 0 AND p IS NOT NULL AND coalesce(p < min(p) OVER before, true) AND coalesce(p <= min(p) OVER behind, true) THEN 1 ELSE 0 END AS cut
  FROM hashed WINDOW before AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), behind AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 8 FOLLOWING)
), numbered AS (
  SELECT *, sum(cut) OVER (PARTITION BY doc_id ORDER BY i) AS unit FROM marked
), pieces AS (
  SELECT doc_id, unit, min(start) AS start, any_value(size) AS size, string_agg(word, ' ' ORDER BY i) AS plain, count(*) AS n FROM numbered GROUP BY doc_id, unit
), piece_places AS (
  SELECT 'piece' AS kind, doc_id, unit, start, coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY unit), size) - start AS length, plain, n FROM pieces
), units AS (
  SELECT * FROM line_places WHERE plain <> '' AND length(plain) - length(replace(plain, ' ', '')) + 1 >= 20
  UNION ALL SELECT kind, doc_id, unit, start, length, plain FROM piece_places WHERE n >= 12
), ranked AS (
  SELECT *, first_value(doc_id) OVER w AS first_doc_id, first_value(unit) OVER w AS first_unit, row_number() OVER w AS r
  FROM units WINDOW w AS (PARTITION BY kind, sha256(plain) ORDER BY doc_id, unit)
)
SELECT doc_id, kind, CAST(unit AS INTEGER) AS unit, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, first_doc_id, CAST(first_unit AS INTEGER) AS first_unit
FROM ranked WHERE r > 1
"""

SQL: dict[str, str] = {"op10_substring_dedup": _OP10}
