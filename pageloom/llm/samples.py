"""A bounded sample of labelled rows as sparse features, for models that are fitted on the driver."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, bounded_sample
from .ngrams import Hasher

FEATURES = "struct<ids:binary,n:binary>"


@dataclass(frozen=True)
class Example:
    label: int
    ids: np.ndarray  # int32 buckets, ascending
    n: np.ndarray  # how often each occurs in the text


def features(hasher: Hasher, text: str | Column) -> Column:
    """Buckets and counts of the whole text, as int32 bytes."""

    @F.arrow_udf(FEATURES)
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [hasher.counts(t) for block in blocks(batch) for t in block]
            yield pa.StructArray.from_arrays(
                [pa.array([x[k].astype(np.int32).tobytes() for x in found], pa.binary()) for k in (0, 1)], ["ids", "n"])

    return count(F.col(text) if isinstance(text, str) else text)


def unpack(value) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(value.ids, np.int32), np.frombuffer(value.n, np.int32).astype(np.float32)


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled rows of each label; ``learn`` says which label rows may be used.

    Labels other than 0 and 1, null ids and ids without a document are left out. Only the bounded list of ids is broadcast.
    """
    usable = labels.filter(learn & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    named = bounded_sample(usable, "label", F.xxhash64(F.lit(11), "doc_id"), most)
    return docs.select("doc_id", "text").join(F.broadcast(named), "doc_id")


def examples(rows: DataFrame, hasher: Hasher) -> list[Example]:
    """Features of a bounded sample on the driver, in an order that does not depend on how Spark dealt the rows."""
    got = rows.select("doc_id", "label", F.xxhash64("text").alias("h"), features(hasher, "text").alias("f")).collect()
    got.sort(key=lambda r: (r.doc_id, r.h))
    return [Example(r.label, *unpack(r.f)) for r in got]


def class_weights(found: list[Example]) -> dict[int, float]:
    """Both labels weigh the same together, whatever their share."""
    n = [sum(e.label == k for e in found) for k in (0, 1)]
    return {k: len(found) / (2 * n[k]) if n[k] else 0.0 for k in (0, 1)}
