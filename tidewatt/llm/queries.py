"""The queries of the operators, as the catalogue registers them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.llm.shipping import ship

#: A parameter: where the vocabulary file lies.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatt.llm import language

    docs = _table(spark, sf_dir, "documents")
    content = language.learn_dictionaries(language.training_rows(docs))
    judged = docs.select("doc_id", language.held_out().alias("held_out"), language.identify(content, "text").alias("_j"))
    return judged.select("doc_id", "held_out", "_j.lang_pred", "_j.score", "_j.rejected")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatt.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), TOKENIZER)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatt.llm.simhash import near_duplicates

    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatt.llm.neighbours import nearest

    return nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


#: Rules of op5, a parameter.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatt.llm.urls import filter_urls, rule_labels

    pages = _table(spark, sf_dir, "pages")
    return filter_urls(pages, URL_RULES, rule_labels(pages, URL_RULES))


def op6_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatt.llm.spots import fingerprint_documents

    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files /source/lang/<id>; one whose last line has a cue word is its directory's
    licence file."""
    from tidewatt.llm import licences

    last = F.lower(F.substring_index("text", "\n", -1))
    name = F.when(last.rlike("licen[cs]e|rights"), "LICENSE").otherwise(F.concat(F.col("doc_id"), F.lit(".txt")))
    path = F.concat(F.lit("/"), F.coalesce("source", F.lit("none")), F.lit("/"), F.coalesce("lang", F.lit("none")), F.lit("/"), name)
    files = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), path.alias("path"), "text")
    return licences.scan(files).withColumnRenamed("id", "doc_id")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatt.llm.bpe import encode_documents

    return encode_documents(_table(spark, sf_dir, "documents"), TOKENIZER)


def op9_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatt.llm import quality

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    ranking = quality.learn(docs, labels.where(~quality.held_out()))
    scored = docs.select("doc_id", quality.held_out().alias("held_out"), quality.score(ranking, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.CUT).cast("int"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatt.llm.html import extract

    return extract(_table(spark, sf_dir, "pages"))


def op11_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatt.llm import secret_spans

    docs = _table(spark, sf_dir, "documents")
    field = secret_spans.train(docs)
    return docs.select("doc_id", secret_spans.scan(field, "text").alias("_s")).select("doc_id", "_s.*")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatt.llm.codes import compress

    return compress(_table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatt.llm.spelling import variants

    return variants(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language_id, op2_best_fit_packing, op3_simhash, op4_nearest_neighbours, op5_url_filter, op6_spot_signatures, op7_license_scan, op8_bpe, op9_quality_ranking, op10_html_extraction, op11_secret_spans, op12_vector_codes, op13_spelling_variants)}


def oracle_sql() -> dict[str, str]:
    """The others are not for SQL: models, tokenizers, a seeded hash, or searches too slow without an index."""
    from tidewatt.llm import codes, licences

    return {"op7_license_scan": licences.oracle(), "op12_vector_codes": codes.oracle()}
