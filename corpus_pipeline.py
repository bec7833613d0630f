"""Training-data pipeline over ``documents``: junk goes, one document of each
near-duplicate group stays, documents with benchmark passages go, personal
data is pseudonymised, and texts are encoded to token ids (and decoded back,
as a check of the ids).

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet to the shared folder and read again for the next one, so a lost
executor repeats at most one stage. Stages keep the columns of their input,
whatever further ones there are; the last adds ids and n_tokens.

A null text counts as empty and leaves the last stage empty; null ids,
languages and sources are values like any other. Repeated rows are near
duplicates of each other, so one stays; of equal ids with different texts all
stay that are no near duplicates. Very long texts are handled whole by every
stage. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plover.llm import byte_bpe, decontaminate, pii, quality, simhash
from plover.llm.common import STAGED, drop_staged, fresh, stage, table
from plover.llm.queries import pii_key, tokenizer_files


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(docs, pii_key(spark), found_col=fresh(docs, "pii"))
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, with the decoded text, and the ids and their number (under
    longer names if the documents have such columns)."""
    path, pattern = tokenizer_files()
    others = {c: f"c{k}" for k, c in enumerate(docs.columns) if c != "text"}
    plain = docs.select("text", *[F.col(c).alias(a) for c, a in others.items()])
    out = byte_bpe.decode(byte_bpe.encode(plain, path, pattern, offsets=False, keep=tuple(others.values())), path)
    back = [F.decode("decoded", "UTF-8").alias(c) if c == "text" else F.col(others[c]).alias(c) for c in docs.columns]
    return out.select(*back, F.col("ids").alias(fresh(docs, "ids")),
                      F.size("ids").cast("long").alias(fresh(docs, "n_tokens")))


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", pii_stage),
    ("byte-level BPE encoding and decoding", encoding_stage),
]

#: SQL has no twin for most stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other. What a stage has read and staged on its way
    is removed when its result is written, so one table is left."""
    docs, first = table(spark, sf_dir, "documents"), len(STAGED)
    for k, (_, function) in enumerate(STAGES):
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{k}")
        drop_staged(spark, first)
    return docs
