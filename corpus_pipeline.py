"""From raw documents to packed token ids: five stages, each a written table.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  ``run`` applies all of them to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


from reviewlens.llm import contamination, mixing, overlap, packing, quality
from reviewlens.llm.store import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and the line rules."""
    return quality.keep_good(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id."""
    return overlap.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    return contamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document taken n times gives n rows, shards in shuffled order."""
    return mixing.mix(docs, mixing.plan(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the mix, as read from the shards: id, start, tokens and checksum."""
    import public_tokenizers

    return packing.read_shards(*packing.write_shards(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("mixing_sources", mixing_sources),
    ("token_ids", token_ids),
]

#: The last stage writes token ids, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
