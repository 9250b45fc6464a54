"""Results out: Markdown, content lists, middle JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sharded(df: DataFrame, shards: int) -> DataFrame:
    return df.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))


def write_markdown(docs: DataFrame, folder: str, shards: int = 64) -> None:
    """SC8: (doc_id, md) in shards by document."""
    _sharded(docs, shards).write.mode("overwrite").partitionBy("shard").parquet(folder)


def write_content_list(records: DataFrame, folder: str) -> None:
    """SC9 v1: one JSON object per block; fields that do not apply are left out."""
    records.select("doc_id", "block_id", "record.*").write.mode("overwrite").option("ignoreNullFields", "true").json(folder)


def write_page_lists(pages: DataFrame, folder: str, backend: str) -> None:
    """SC9 v2: one JSON object per page with its array; only vlm and hybrid backends have this form."""
    if not backend.startswith(("vlm", "hybrid")):
        raise ValueError(f"backend {backend} has no page lists")
    pages.write.mode("overwrite").json(folder)


def middle_documents(pages: DataFrame, backend: str, version: str) -> DataFrame:
    """SC7: pages (doc_id, page_idx, page STRUCT) as one middle document per doc."""
    ordered = F.array_sort(F.collect_list(F.struct("page_idx", "page")))["page"]
    return pages.groupBy("doc_id").agg(ordered.alias("pdf_info")).select(
        "doc_id", "pdf_info", F.lit(backend).alias("_backend"), F.lit(version).alias("_version_name"))


def write_middle(docs: DataFrame, folder: str) -> None:
    """SC7."""
    docs.write.mode("overwrite").option("ignoreNullFields", "true").json(folder)
