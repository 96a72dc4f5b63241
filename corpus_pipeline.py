"""From raw documents to packed training sequences, a stage at a time.

Every stage works on all rows that the one before it left; all but the last return the columns of
``documents``. ``run`` writes each stage's result to the shared scratch folder and reads it again,
so that a lost executor costs no more than the stage at work.

Defined cases, which follow from the stages' operators: a null, empty or blank text fails the quality
rules; a null id is an id like any other, without a label, and of near duplicates an id comes before a
null one; of rows alike one stays; a text that is repeated passages alone is left empty, and costs the
mix nothing; a null source is a source of its own; a very long text goes through whole and is cut only by
packing; an empty table gives an empty table at every stage; further columns are kept up to packing,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import mixing, ngram_join, packing, quality, suffix_dedup
from lakeops.llm.queries import modest_batches, tokenizer
from lakeops.session import shuffles_freed, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    modest_batches(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, the document of smallest id stays."""
    modest_batches(spark)
    return ngram_join.keep_one(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document go; ``n_chars`` is that of the text that is left."""
    modest_batches(spark)
    return suffix_dedup.remove(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    modest_batches(spark)
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    modest_batches(spark)
    return packing.pack(docs, tokenizer())


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", one_of_each),
    ("repeated_passages", without_repeated_passages),
    ("mixing", mixed),
    ("packing", packed),
]

# The forest, the components and the token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with shuffles_freed(spark):
            docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
