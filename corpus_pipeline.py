"""The corpus pipeline: quality filter, near-dedup, substring dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns a DataFrame
that is written as Parquet and read as the next one's docs. All but the last return the columns of
`documents`. Empty tables pass through; extra columns of docs are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm import mixing, packing, quality_classifier, simhash, substrings
from parcelspark.session import materialise

#: No source is read more than twice for one pass over the largest.
REPETITION_LIMIT = 2.0


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on labels outside the held-out fold, accepts."""
    trees = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality_classifier.score_quality(docs, trees)
    return scored.where(F.col("quality_score") >= quality_classifier.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each SimHash component, once if its row is repeated. Where an id has
    several texts, each is a document of its own; of those that share a component and its smallest id, the one of
    least hashes is kept. Rows without an id cannot be named by a component: they stay, repeated texts once.
    Texts are told apart by two hashes."""
    text = ["text_hash", "text_hash2"]
    found = simhash.near_duplicates(docs, with_text=True).withColumn("of", F.struct(*text))
    own = found.where(F.col("doc_id") == F.col("component_id"))
    several = own.groupBy("component").agg(F.min("of").alias("least"), F.max("of").alias("most")).where("least < most")
    others = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id", *text)
    others = others.unionByName(own.join(several, "component").where("of > least").select("doc_id", *text)).distinct()
    # the join and the distinct rows share their keys, and so one shuffle of the texts
    keys = ["doc_id", *text]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), *(h.alias(c) for h, c in zip(simhash.text_hashes(), text, strict=True)))
    kept = rows.join(others, keys, "left_anti").dropDuplicates(keys)
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that windows shared with other places cover; a document that loses
    every word goes. n_chars follows the text."""
    found = substrings.substring_duplicates(docs)
    cut = F.col("n_removed") > 0
    columns = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) if c != "n_chars" else F.when(cut, F.length("text").cast(docs.schema[c].dataType)).otherwise(F.col("row").getField(c)).alias(c) for c in docs.columns]
    return found.where(~cut | (F.col("n_removed") < F.col("n_words"))).select(*columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight says: each at least once."""
    return mixing.mix(docs, repetition_limit=REPETITION_LIMIT).select(*docs.columns)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's length bucket, batch and slot."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]
#: SQL can express neither the fitted trees nor components of fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
