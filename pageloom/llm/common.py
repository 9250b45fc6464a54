"""Helpers shared by the operators: durable intermediates, stable row order, folds, text batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

cut = materialize  # a table in spark.checkpoint.dir: survives lost executors, read back with its statistics


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id falls in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(0))


def text_key(text: str) -> Column:
    """Tells apart rows that share a doc_id but not a text; 0 for null."""
    return F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.xxhash64(F.lit(7), text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` does just that where all characters are ASCII, and is much faster there."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def blocks(texts: pa.Array, most: int = 1 << 20) -> Iterator[list[memoryview | None]]:
    """UTF-8 of the rows in blocks of about ``most`` bytes (a longer text is a block of its own); None for null.

    The views point into the Arrow buffer, so a text is not copied.
    """
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    view, valid = memoryview(data or b""), texts.is_valid().to_pylist()
    block: list[memoryview | None] = []
    held = 0
    for i, ok in enumerate(valid):
        n = int(at[i + 1] - at[i])
        if block and held + n > most:
            yield block
            block, held = [], 0
        block.append(view[at[i]:at[i + 1]] if ok else None)
        held += n
    yield block


def decoded(texts: pa.Array) -> Iterator[str | None]:
    """Rows as str, one at a time."""
    for i in range(len(texts)):
        yield texts[i].as_py()


def bounded_sample(rows: DataFrame, group: str, by: Column, most: int) -> DataFrame:
    """At most ``most`` rows of each ``group``, those with the smallest hashes ``by``; alike on every run.

    Groups are counted first, and only rows whose hash lies in the lowest part that is expected to hold twice as many go to the
    ranking. So what one group ranks stays bounded, however many rows it has.
    """
    parts = 1 << 30
    counted = rows.withColumn("_by", by).join(rows.groupBy(group).agg(F.count("*").alias("_n")), group)
    near = counted.filter(F.pmod("_by", F.lit(parts)) * F.col("_n") < F.lit(float(parts)) * (2 * most + 50))
    order = Window.partitionBy(group).orderBy(F.pmod("_by", F.lit(parts)), "_by")
    return near.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= most).drop("_r", "_n", "_by")
