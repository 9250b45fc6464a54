"""Cleaning and packing of ``documents`` for training: language ID, line dedup, near-dedup, decontamination, best-fit packing.

Each stage takes what its predecessor kept and works on all of it; ``run`` writes every stage's rows and reads them again. All
stages but the last return the columns of ``documents``. ``n_chars`` follows the text. Other columns pass through the first four
stages unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import decontaminate, language, line_runs, minhash, packing
from pageloom.llm.common import cut, fold, text_key

LEAST_LANGUAGE_SCORE = 0.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slim(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all else as one struct, so that no column of ``docs`` meets one that an operator adds."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest).alias("_rest") if rest else F.lit(None).alias("_rest"))


def full(slimmed: DataFrame, columns: list[str]) -> DataFrame:
    return slimmed.select(*(F.col(c) if c in ("doc_id", "text") else F.col("_rest").getField(c).alias(c) for c in columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages. Those that are ``und`` (null text, or no letter) or whose best language has not half
    of the score go. Languages are learned from ``docs`` itself (fold 2 of 4 aside); ``lang`` keeps its given value. If no row names a
    language there is nothing to tell apart, and all texts with a letter stay."""
    model = language.fit(docs, fold("doc_id", 4) != 2)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = slim(docs).withColumn("_l", language.identify(model, "text"))
    kept = found.filter((F.col("_l.lang_pred") != language.UNKNOWN) & (F.col("_l.score") >= LEAST_LANGUAGE_SCORE))
    return full(kept, docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated runs of lines and of single lines of 50 words or more. A document that had lines and lost them all goes."""
    found = line_runs.remove_copies(slim(docs), line_runs.PASSAGES)
    emptied = (F.size("runs") == 1) & (F.get("runs", F.lit(0))["last"] - F.get("runs", F.lit(0))["first"] + 1 == F.col("n_lines"))
    kept = full(found.filter(~emptied), docs.columns)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id. Of rows equal in doc_id and text one stays."""
    found = minhash.near_duplicates(docs.select("doc_id", "text"))
    grouped = found.filter(F.col("component").isNotNull())
    first = grouped.groupBy("component").agg(F.min(F.struct("doc_id", "key")).alias("f")).select("f.*")
    best = first.union(found.filter(F.col("component").isNull()).select("doc_id", "key")).distinct().toDF("_d", "_k")
    rows = slim(docs).withColumn("_key", text_key("text"))
    kept = rows.join(best, rows["doc_id"].eqNullSafe(best["_d"]) & (rows["_key"] == best["_k"]), "left_semi")
    return full(kept.dropDuplicates(["doc_id", "_key"]), docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = decontaminate.report(decontaminate.find(slim(docs), table(spark, sf_dir, "benchmark")))
    return full(found.filter(~F.col("contaminated")), docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens; columns as of ``op8_best_fit_packing``."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None  # a learned language model, a tokeniser and best-fit are beyond SQL; tests/llm compares the stages with plain loops


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
