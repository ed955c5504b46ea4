"""The corpus pipeline: toxicity, near-duplicates, repeated passages, packing.

Each stage reads all that its predecessor kept, written as Parquet. All but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maillage.llm import packing, simhash, substrings, toxicity
from maillage.llm.common import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It is trained on labelled documents
    of the whole table, and rejects what is over its language's threshold."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = toxicity.scored(docs.select(*COLUMNS), model)
    return found.where(~toxicity.flagged(found, model)).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by operator 5 with its contract's shingles of
    three words and at most three of 64 bits: the one with the smallest id. A row without an
    id stands for its text, after all ids; of rows with one id the least text stays."""
    own = F.coalesce("doc_id", F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 61)))
    docs = docs.select(*COLUMNS, own.alias("_id"))
    groups = simhash.grouped(simhash.fingerprints(docs, key="_id"), key="_id")
    kept = stored(groups.where("_id = component_id").groupBy("_id").agg(F.count("*").alias("_rows")))
    # By a shuffle at every size: the ids that stay grow with the documents.
    once = docs.join(kept.select("_id").hint("merge"), "_id", "left_semi")
    if kept.where("_rows > 1").limit(1).count():
        first = F.row_number().over(Window.partitionBy("_id").orderBy("text"))
        once = once.withColumn("_nth", first).where("_nth = 1")
    return once.select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand earlier: their words joined by one space
    where something went, their text as it is where nothing did."""
    return substrings.cleaned(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    return packing.packed(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", without_near_copies),
    ("substring dedup", without_repeats),
    ("best-fit packing", packed),
]

#: The classifier and the fingerprints can't be said in SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
