"""UF1: a user's model over pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def predict(pages: DataFrame, model: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str, buckets: list[str] = ()) -> DataFrame:
    """Rows of a model per page. ``model()`` runs once per task and returns the function for a batch.

    Pages of one bucket (language, padded size) are sorted together, so that batches are alike; the
    page hash in the partitioning splits a bucket of any size over tasks.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        infer = model()
        for batch in batches:
            yield infer(batch)

    if buckets:
        parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pages = pages.repartition(parts, *buckets, F.pmod(F.xxhash64("doc_id", "page_idx"), F.lit(parts))).sortWithinPartitions(*buckets)
    return pages.mapInPandas(run, schema)
