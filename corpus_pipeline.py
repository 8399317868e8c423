"""A training corpus from the documents table: five stages, each one operator of lakeflux.llm.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All but the
last return the columns of documents.

1. language ID: documents without any letter go, and those whose n-grams are enough to judge by but
   are of no learned language, unless they are labelled with a language that was not learned;
2. line dedup: later repeated runs of lines are deleted, and documents that lose all of their text;
3. n-gram Jaccard join (five words, 0.8 or more): of each group the smallest doc_id stays;
4. decontamination: documents that hold a benchmark item (0.8 or more of its words in runs of five or more) go;
5. packing: the pieces of the documents that are left, with their place in sequences of 1024 tokens.

Clean documents pass every filter. Null columns other than text are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeflux.llm import decontaminate, langid, linededup, ngram_join, packing
from lakeflux.llm.queries import fit_langid, tokenizer_path
from lakeflux.llm.work import materialise
from lakeflux.queries.common import load

#: A document is rejected where its best language holds less than this share of its n-grams,
MIN_LANGUAGE_SCORE = 0.05
#: of which there are at least so many: of fewer, one known n-gram would be the whole share.
MIN_LANGUAGE_GRAMS = 20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lang, score, grams = names = ("__llm_lang", "__llm_score", "__llm_grams")
    filters = fit_langid(docs)
    out = langid.identify(docs, filters, names)
    judged = (F.col(grams) >= MIN_LANGUAGE_GRAMS) & (F.col("lang").isNull() | F.col("lang").cast("string").isin(filters.langs))
    return out.where((F.col(lang) != "und") & ~(judged & (F.col(score) < MIN_LANGUAGE_SCORE))).drop(*names)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(docs, drop_emptied=True)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_first_of_component(docs, 5, 80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path(), 1024, 2)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]
#: No SQL form: the stages learn filters, hash, tile and tokenise.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the documents table of sf_dir."""
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, "stage")
    return docs
