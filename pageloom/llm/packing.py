"""Best-fit packing of tokenised documents into sequences with several capacities.

Pieces are described by a vector (tokens, documents, attention cost = tokens squared) and bins by their residual capacities.
Pieces of one length are interchangeable, and so are bins with equal residuals. So the corpus is reduced to a histogram of
lengths, whose size is bounded by the sequence length whatever the input, the vector best-fit runs over that histogram
(counts of pieces, counts of equal bins), and its result is a small table of bin patterns with multiplicities. Spark then deals
the pieces out: each piece gets its rank among the pieces of its length, which names its bin and its place in it. No piece
passes through the driver, and every length is dealt over as many tasks as it needs.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, decoded

PIECES = "array<struct<piece:int,start:long,length:long,ids_crc32:long>>"
SPECIAL = "<|endoftext|>"


def _encoder(name: str):
    """str -> token ids of the byte-level BPE ``name``.json, without special tokens added.

    The same vocabulary as ranks gives the same ids several times faster; the few texts that hold the special string go
    through ``tokenizers`` itself, which reads it as one token.
    """
    import base64

    import public_tokenizers as public
    import tiktoken
    from tokenizers import Tokenizer

    with open(public.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(public.path(f"{name}.json"))
    return lambda text: exact.encode(text, add_special_tokens=False).ids if SPECIAL in text else fast.encode_ordinary(text)


def token_pieces(docs: DataFrame, size: int, tokenizer: str = "byte_bpe_50k", end_id: int = 2, text: str = "text",
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per piece: ``keep`` columns, piece, start, length, ids_crc32.

    A text is its ids and then ``end_id``; a null text counts as empty, so each row gives one piece at least. Only texts of more
    than ``size`` ids are cut; the first piece takes the remainder, all others are full. Repeated rows stay repeated.
    """

    @F.arrow_udf(PIECES)
    def cut_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = _encoder(tokenizer)
        kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))
        for batch in batches:
            rows = []
            for value in decoded(batch):
                ids = array("I", encode(value or ""))
                ids.append(end_id)
                raw, n = memoryview(ids).cast("B"), len(ids)
                edges = [0, *range(n % size or size, n + 1, size)] if n > size else [0, n]
                rows.append([(k, a, b - a, zlib.crc32(raw[4 * a:4 * b])) for k, (a, b) in enumerate(zip(edges, edges[1:]))])
            yield pa.array(rows, kind)

    cols = [F.col(c) for c in keep]
    return docs.select(*cols, F.explode(cut_up(F.col(text))).alias("_p")).select(*cols, "_p.*")


@dataclass(frozen=True)
class Capacity:
    """Limits of a sequence; ``documents`` and ``attention`` default to limits that a sequence of ``tokens`` can just reach."""

    tokens: int = 1024
    documents: int | None = None
    attention: int | None = None
    rule: str = "residual"  # or "dot"

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], np.int64)


def best_fit(histogram: dict[int, int], capacity: Capacity) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bin patterns as (number of equal bins, [(length, pieces of it in a bin), ...]).

    Lengths go in falling order. A piece goes to the open bin that can take it under every limit and that scores best:
    "residual" takes the least weighted norm of what would stay free, "dot" the greatest weighted dot product of the piece and
    the free capacities. The weights are 1 / limit, so the scores have no unit. If no bin fits, a new one opens. Equal bins
    are one entry with a count, so the work follows the number of distinct lengths and residuals, not the number of pieces.
    """
    limits = capacity.limits()
    open_bins: dict[tuple[int, ...], list[list]] = {}  # residuals -> [count, content]

    def put(residual: np.ndarray, count: int, content: tuple) -> None:
        open_bins.setdefault(tuple(int(x) for x in residual), []).append([count, content])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        need = np.array([length, 1, length**2], np.int64)
        if (need > limits).any():
            raise ValueError(f"a piece of {length} tokens does not fit an empty sequence")
        while left:
            keys = np.array(list(open_bins), np.int64).reshape(-1, 3)
            fits = np.flatnonzero((keys >= need).all(axis=1))
            if not len(fits):
                each = int(min(limits // need))  # in a new bin the rest of this length follows at once
                whole, rest = divmod(left, each)
                for count, number in ((whole, each), (1, rest)):
                    if count and number:
                        put(limits - number * need, count, ((length, number),))
                break
            free = keys[fits]
            if capacity.rule == "dot":
                score = -((free / limits) @ (need / limits))
            else:
                score = (((free - need) / limits) ** 2).sum(axis=1)
            best = fits[np.lexsort((free[:, 1], free[:, 0], score))[0]]
            key = tuple(int(x) for x in keys[best])
            count, content = open_bins[key].pop()
            if not open_bins[key]:
                del open_bins[key]
            each = int(min(keys[best] // need)) if capacity.rule == "residual" else 1
            each = min(each, left)
            used = min(count, left // each)
            left -= used * each
            put(keys[best] - each * need, used, (*content, (length, each)))
            if count > used:
                put(keys[best], count - used, content)
    merged: dict[tuple, int] = {}
    for entries in open_bins.values():
        for count, content in entries:
            merged[content] = merged.get(content, 0) + count
    return [(count, list(content)) for content, count in sorted(merged.items())]


def pack(pieces: DataFrame, capacity: Capacity, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """``pieces`` (with a column length) plus sequence_id and offset; offsets in a sequence run from 0 without a gap.

    An empty table gives an empty table. Which of several pieces of one length goes where follows ``order``; equal rows are
    interchangeable.
    """
    spark = pieces.sparkSession
    ranked = _rank_by_length(pieces, order)
    histogram = {int(r.length): int(r.n) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, first = [], 0
    ahead: dict[int, int] = {}  # pieces of a length already given a bin
    for count, content in best_fit(histogram, capacity):
        offset = 0
        for length, each in content:
            begin = ahead.get(length, 0)
            slots.append((length, begin, begin + count * each, each, first, offset))
            ahead[length] = begin + count * each
            offset += length * each
        first += count
    table = spark.createDataFrame(slots, "length long, lo long, hi long, each long, first long, base long")
    # each length's slots as one array, sorted by lo: one row per length, so no piece meets a slot that is not its own
    table = table.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "each", "first", "base"))).alias("_slots"))
    slot = F.element_at(F.filter("_slots", lambda s: (s.lo <= F.col("_rank")) & (F.col("_rank") < s.hi)), 1)
    return (ranked.join(F.broadcast(table), "length")  # at most capacity.tokens rows
            .withColumn("_s", slot)
            .withColumn("sequence_id", F.expr("_s.first + (_rank - _s.lo) div _s.each"))
            .withColumn("offset", F.expr("_s.base + ((_rank - _s.lo) % _s.each) * length"))
            .drop("_s", "_slots", "_rank"))


def _rank_by_length(pieces: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """_rank: place of a piece among those of its length, from 0.

    A length can hold a third of all pieces, so no window spans a length: rows are sorted into ranges of (length, order), counted
    by range and length, and only those counts (ranges times lengths at most) are summed up.
    """
    ranges = cut(pieces.repartitionByRange("length", *order).withColumn("_range", F.spark_partition_id()), "pack-ranges")
    counts = ranges.groupBy("length", "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_range").orderBy(*order)
    return (ranges.withColumn("_row", F.row_number().over(inside) - 1).join(base, ["length", "_range"])
            .withColumn("_rank", F.col("_row") + F.col("_before")).drop("_row", "_before", "_range"))


def pack_documents(docs: DataFrame, capacity: Capacity = Capacity(), tokenizer: str = "byte_bpe_50k", end_id: int = 2) -> DataFrame:
    """Tokenise, cut and pack ``docs`` (doc_id, text); other columns are left out. Pieces are written once and read twice."""
    pieces = cut(token_pieces(docs, capacity.tokens, tokenizer, end_id), "pack-pieces")
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
