"""From documents to packed training sequences: language, quality, near duplicates, packing.

Each stage is a function of (spark, docs, sf_dir) and works on all that its predecessor kept; what
it returns is written as Parquet and read again for the next one. All but the last return the
columns of documents. The session's shared folder holds the tables between the stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatt.llm import language, packing, quality, simhash
from tidewatt.llm.lasting import written
from tidewatt.llm.queries import TOKENIZER
from tidewatt.llm.shipping import ship


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what is not rejected: texts with letters whose language is clear."""
    ship(spark)
    content = language.learn_dictionaries(language.training_rows(docs))
    return docs.where(~language.identify(content, "text")["rejected"])


def quality_ranking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what scores at the threshold or above."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ranking = quality.learn(docs, labels.where(~quality.held_out()))
    return docs.where(quality.score(ranking, "text") >= quality.CUT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least doc_id of each component."""
    ship(spark)
    return simhash.kept(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    ship(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [("language_id", language_id), ("quality_ranking", quality_ranking), ("near_duplicates", near_duplicates), ("best_fit_packing", best_fit_packing)]

#: SQL expresses neither the compression nor the packing; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
