"""A training corpus in five stages, each one of the operators of ``stpanel.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. Its result is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``; further columns pass through.
NULL ids, repeated rows and empty tables are treated as the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stpanel.llm import bpe, jaccard, langid, mixing, pii
from stpanel.llm.queries import RANKS
from stpanel.operators.storage import materialize

#: Below this share of known n-grams a text is in none of the learned languages.
LEAST_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learned language; texts without letters and gibberish go.

    Without a labelled document nothing can be learned, and nothing is rejected.
    """
    labelled = docs.filter(~langid.held_out())
    filters = langid.learn(labelled)
    if not filters.langs:
        return docs
    return langid.select(docs, filters, LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of linked documents: the one with the smallest id.

    Of repeated rows one stays. Documents without words are linked with nothing
    and all stay.
    """
    return jaccard.representatives(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; ``n_chars`` follows the text."""
    clean = pii.redact(docs, pii.train(pii.labelled_table(spark)))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and cut documents so that each source has its target of words.

    A document is returned once per copy the mix takes; the copy at a source's
    budget is cut after its last word, and its ``n_chars`` follows.
    """
    return mixing.apply(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: ``doc_id, source, lang, n_tokens, ids``."""
    ranks = bpe.load_ranks(public_tokenizers.path(RANKS))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=("doc_id", "source", "lang"))
    tokens = F.floor(F.octet_length("ids") / 4).cast("long")
    return coded.select("doc_id", "source", "lang", tokens.alias("n_tokens"), "ids")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("encode", encode),
]

#: Hash filters, a trained field and BPE are beyond SQL; brute-force tests stand in.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
