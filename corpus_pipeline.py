"""Corpus cleaning: quality, exact copies, near copies, source weights, tokens.

Each stage takes the documents its predecessor kept and returns theirs; the last
returns token ids.
"""

import public_tokenizers
from guardlake.llm import bpe, exact_dedup, jaccard_join, mixing, quality
from guardlake.llm.queries import QUALITY_LIMIT, SOURCE_WEIGHTS
from guardlake.llm.tables import written
from guardlake.session import scratch_folder
from pyspark.sql import functions as F

#: SQL cannot express the classifier or the near copies; tests compare with brute force.
ORACLE_SQL = None


def good(spark, docs, sf_dir):
    """Documents that the classifier does not reject; labels come from ``labels`` of the ids at hand."""
    voter = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored, score = quality.score_documents(docs, voter)
    return scored.where(F.col(score) >= QUALITY_LIMIT).drop(score)


def distinct(spark, docs, sf_dir):
    """One row of each group of equal texts, the one with the smallest id."""
    return exact_dedup.drop_copies(docs)


def apart(spark, docs, sf_dir):
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return jaccard_join.drop_near_copies(docs, width=5, percent=80)


def mixed(spark, docs, sf_dir):
    """Copies of the documents by their sources' target weights, in shuffled order."""
    return mixing.mixed_documents(docs, SOURCE_WEIGHTS)


def encoded(spark, docs, sf_dir):
    """Token ids of every copy."""
    ids = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality classifier", good),
    ("exact dedup", distinct),
    ("n-gram Jaccard join", apart),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", encoded),
]


def run(spark, sf_dir):
    """All stages over ``documents``, each but the last written as Parquet and read again."""
    folder = scratch_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"{folder}/{k}")
    return docs
