"""The corpus pipeline: language ID, near-duplicate removal, repeated passages, packing.

Each stage takes ``(spark, docs, sf_dir)``. All but the last return the columns
of ``documents``; what they return is written and read again as the next one's
``docs``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm import language, packing, repeats, simhash
from rillstone.session import stage

SURE = 0.2  # a text whose language the model doubts more than this is rejected

# The stages train a model and pack by a tokenizer's ids, which SQL cannot express.
ORACLE_SQL = None


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter and texts that look like none of the languages learned."""
    out = language.held_out("doc_id", 3, 1)
    model = language.fit(docs.filter(~out & F.col("doc_id").isNotNull()))
    judged = language.predict(docs.select(F.struct("*").alias("row"), "text"), model)
    kept = judged.filter((F.col("lang_pred") != language.UNKNOWN) & F.col("known") & (F.col("score") >= SURE))
    return kept.select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the one with the smallest id."""
    return simhash.without_near_duplicates(docs, width=4, distance=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out passages of 100 bytes or more that an earlier document, or the same one earlier, has too.

    A character of which only a part is left goes as well; ``n_chars`` is counted anew.
    """

    @F.arrow_udf("string")
    def readable(kept: pa.Array) -> pa.Array:
        return pa.array([b.as_buffer().to_pybytes().decode("utf-8", "ignore") for b in kept], pa.string())

    found = repeats.without_repeats(docs, length=100)
    found = found.withColumn("text", readable("kept"))
    new = {"doc_id": F.col("id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(*[new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 2048 tokens; one row per piece."""
    import public_tokenizers

    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end=1)


STAGES = [
    ("language", keep_known_languages),
    ("simhash", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result but the last written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for _, step in first:
        docs = stage(step(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)
