"""The corpus pipeline: stages that each apply one operator to what its predecessor kept.

Stages take (spark, docs, sf_dir) and keep the columns of ``docs``, extra ones included; the
last one returns the encoded documents.  A NULL text counts as empty.  Rows with a NULL
doc_id pass the stages that compare documents unchanged.  Ids are taken to be unique: rows
that repeat an id share the decisions made for it.  An empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.language import UNDETERMINED, fit, learned_on, predicted
from windrow.llm.lines import line_dedup
from windrow.llm.minhash import near_duplicates
from windrow.llm.mixing import mixed_rows
from windrow.llm.pieces import encode_texts
from windrow.runtime import discard, staging

VOCABULARY = "piece_bpe_32k.model"

# No SQL says what a learned language filter keeps; tests hold the stages against brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told.

    Texts that are NULL or without a letter go, and those of which no language has an n-gram
    beyond chance (score 0).  Where nothing is labelled, all texts with a letter stay.
    """
    model = fit(docs.select("doc_id", "text", "lang").filter(learned_on(F.col("doc_id"))))
    if not model.languages:  # nothing is labelled, so nothing can be told apart
        return docs.filter(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    told = (F.col("_told.lang_pred") != UNDETERMINED) & (F.col("_told.score") > 0)
    return docs.withColumn("_told", predicted(model, F.col("text"))).filter(told).drop("_told")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the lines that occurred before, here or in another document."""
    return line_dedup(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies."""
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_kept_id"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept_id"]), "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a repeated one is a row each time."""
    return mixed_rows(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids): what training reads."""
    encoded = encode_texts(docs, public_tokenizers.path(VOCABULARY), ["doc_id", "source"])
    return encoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("identify_language", identify_language),
    ("dedup_lines", dedup_lines),
    ("drop_near_duplicates", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, apply in STAGES[:-1]:
        with staging(spark) as result:  # what a stage staged goes when its output is written
            docs = result(apply(spark, docs, sf_dir), name)
        if last is not None:
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
