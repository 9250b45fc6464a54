"""Registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact_dedup, html_render, language, line_runs, merkle, minhash, packing, quality_embed, quality_rules, ranked_search, toxicity, unit_dedup
from .common import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scored(docs: DataFrame, held: int, parts: int, score, at: float) -> DataFrame:
    out = docs.select("doc_id", (fold("doc_id", parts) == held).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= at).cast("int"))


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_embed.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return scored(docs, 0, 5, quality_embed.score(model, "text"), 0.3)


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = unit_dedup.removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *(F.col(c).cast("long").alias(c) for c in ("start", "end", "n_words", "n_units", "first_doc_id", "first_start")))


ORACLES["op2_substring_dedup"] = unit_dedup.ORACLE


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    out = quality_rules.apply_rules(docs.select("doc_id", "text"), model)
    return out.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "probability")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.report(line_runs.remove_copies(table(spark, sf_dir, "documents").select("doc_id", "text")))


ORACLES["op4_line_dedup"] = line_runs.ORACLE


@query
def line_dedup_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4 with single lines of 50 words or more, as the pipeline runs it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.report(line_runs.remove_copies(docs, line_runs.PASSAGES))


ORACLES["line_dedup_passages"] = line_runs.PASSAGE_ORACLE


@query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_render.render(table(spark, sf_dir, "pages"))
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n", -1)))
    return out.select("page_id", "text", F.char_length("text").cast("long").alias("n_chars"), lines.cast("long").alias("n_lines"))


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.report(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLES["op7_decontamination"] = decontaminate.ORACLE


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, fold("doc_id", 4) != 2)
    return docs.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), language.identify(model, "text").alias("_l")).select(
        "doc_id", "held_out", "_l.lang_pred", "_l.score")


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return scored(docs, 1, 3, toxicity.score(model, "text"), 0.7)


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op11_exact_dedup"] = exact_dedup.ORACLE


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_ranked_search"] = ranked_search.ORACLE


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(merkle.leaves(table(spark, sf_dir, "documents"))).audit().drop("tree")


ORACLES["op13_merkle_manifest"] = merkle.ORACLE
