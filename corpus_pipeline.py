"""A training corpus from raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``. A
stage works on all that the one before it kept.

Empty input gives empty output in every stage. Rows without doc_id, and repeated rows, are handled
as the operators say. Columns beyond doc_id, text, lang, source and n_chars pass through.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import langid, line_dedup, minhash, mixing, packing, shared

#: A document stays if its language has at least this posterior probability.
LANGUAGE_SCORE = 0.5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts that are null, have no letter, or are of no certain language.

    Rows that share a doc_id share their fate with the least certain of them.
    """
    pieces = public_tokenizers.path("piece_bpe_32k.model")
    found = langid.identify(docs, pieces)
    rejected = found.filter(
        (F.col("lang_pred") == langid.UNKNOWN) | (F.col("score") < LANGUAGE_SCORE)
    ).select(F.col("doc_id").alias("rejected"))
    rejected = shared.stored(rejected.distinct(), "rejected")
    rows = docs.select(shared.boxed(docs), F.col("doc_id").cast("long").alias("own"))
    same = F.col("own").eqNullSafe(F.col("rejected"))
    return rows.join(rejected, same, "left_anti").select(*shared.unboxed(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take lines that many documents share out of all but one of them."""
    return line_dedup.without_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their target weights."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can neither tell languages nor tokenize; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each but the last written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
