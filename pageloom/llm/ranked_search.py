"""Ranked lexical search by best-first document intervals over range-maximum tables.

1. One scan counts documents, terms and the length of each text; another stores the postings (document, term, frequency) of the terms
   that any item has. Postings with their impact, the term's share in a score before its weight, are dealt to shards by document.
2. In a shard documents are numbered by doc_id. Every term's posting list has a sparse table of range maxima over impacts, so that the
   largest impact in any interval of documents, and where it stands, takes two look-ups.
3. For each item an interval of documents is bounded by the sum over its terms of weight times the largest impact inside. The interval
   with the highest bound goes first: it is split at the document that has the largest share, which is scored exactly, and both
   halves get bounds of their own. An interval that cannot give one of the best documents any more is dropped.
4. Shards return their best documents; these are ranked with a limit that Spark applies before and after the shuffle.

A shard holds a bounded number of postings. Items come in blocks of bounded size, and every block meets every shard; nothing is
collected on the driver but three numbers. A very frequent term only has postings in every shard.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .decontaminate import words

SCALE = 1_000_000_000
LOW = 21  # bits of a document number in a packed entry; impacts stay below 2 ** 20


@dataclass(frozen=True)
class Params:
    best: int = 20  # documents an item
    shard: int = 250_000  # postings in a shard, about
    block: int = 20_000  # terms (with repeats) in a block of items, about
    broadcast_terms: int = 200_000  # lists of terms up to this size are broadcast; longer ones are joined by shuffle
    wave: int = 64  # intervals that are split at once


def items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, w): distinct (item_id, text) that have a term."""
    named = benchmark.select("item_id", words("text").alias("w")).filter(F.size("w") > 0).distinct()
    return cut(named.withColumn("item", F.monotonically_increasing_id()), "search-items")


def _small(df: DataFrame, p: Params) -> DataFrame:
    return F.broadcast(df) if df.count() <= p.broadcast_terms else df


def corpus(docs: DataFrame) -> tuple[int, int]:
    """N, the documents with a term, and L, their terms with repeats."""
    n = F.size(words("text")).cast("long")
    row = docs.select(n.alias("n")).filter(F.col("n") > 0).agg(F.count("*"), F.sum("n")).first()
    return row[0], row[1] or 0


def postings(docs: DataFrame, terms: DataFrame, p: Params) -> DataFrame:
    """(row, doc_id, n, term, tf): how often each of the ``terms`` stands in each document; n counts all terms of the document."""
    token = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words("text").alias("w"))
    token = token.select("row", "doc_id", F.size("w").cast("long").alias("n"), F.explode("w").alias("term"))
    return cut(token.join(_small(terms, p), "term").groupBy("row", "doc_id", "n", "term").agg(F.count("*").alias("tf")), "search-postings")


def weights(index: DataFrame, n_docs: int) -> DataFrame:
    """(term, weight) of all terms that some document has."""
    share = F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double")
    return index.groupBy("term").agg(F.count("*").alias("df")).select("term", F.floor(F.lit(1000.0) * F.ln(share)).cast("long").alias("weight"))


def impact(tf: Column, n: Column, n_docs: int, n_terms: int) -> Column:
    m = F.lit(75) + F.expr(f"(25 * n * {n_docs}) div {max(n_terms, 1)}")
    return F.call_function("div", F.lit(SCALE) * tf, 1000 * tf + 12 * m)


def search(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``p.best`` documents of each item with the highest scores above 0.

    Null texts, texts without a term, and items without one match nothing. Items equal in item_id and text count once; items that
    share an id only are ranked each for itself. Equal scores rank by doc_id, null last; rows that repeat a doc_id are ranked as they
    come. Other columns are not read.
    """
    asked = items(benchmark)
    n_docs, n_terms = corpus(docs)
    counted = asked.select("item", F.explode("w").alias("term")).groupBy("item", "term").agg(F.count("*").alias("times"))
    numbered = cut(counted.select("term").distinct().withColumn("number", F.monotonically_increasing_id()), "search-terms")
    index = postings(docs, numbered.select("term"), p)
    known = weights(index, n_docs).join(numbered, "term")
    weighted = cut(counted.join(known, "term").withColumn("weight", F.col("weight") * F.col("times")), "search-weights")

    # blocks of items: consecutive numbers dealt by hash, so many that a block stays small
    size = weighted.count()
    block = F.pmod(F.xxhash64("item"), F.lit(size // p.block + 1))
    asked_for = weighted.select(block.alias("block"), "item", "number", "weight")
    blocks = cut(asked_for.groupBy("block").agg(F.collect_list(F.struct("item", "number", "weight")).alias("asked")), "search-blocks")

    wanted = weighted.select("term", "number", block.alias("block")).distinct()
    dealt = index.join(_small(cut(wanted, "search-wanted"), p), "term").select(
        "block", "row", "doc_id", "number", impact(F.col("tf"), F.col("n"), n_docs, n_terms).alias("impact"))
    shards = size and max(1, index.count() // p.shard + 1)
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(max(shards, 1))).cast("int"))
    meet = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(max(shards, 1) - 1))))
    found = (dealt.groupBy("block", "shard").cogroup(meet.groupBy("block", "shard"))
             .applyInArrow(_search_shard(p), "shard int, item long, row long, doc_id long, score long"))
    return _ranked(cut(found, "search-found"), asked, p)


def _ranked(found: DataFrame, asked: DataFrame, p: Params) -> DataFrame:
    """The best of all shards: first of some shards together, then of those; each ranking keeps ``best`` rows before its shuffle."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row"]
    some = Window.partitionBy("item", F.pmod("shard", F.lit(64))).orderBy(*order)
    near = found.withColumn("r", F.row_number().over(some)).filter(F.col("r") <= p.best)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= p.best)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


class Shard:
    """Posting lists of a shard, ordered by term and document, with one sparse table over all of them."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, size: int):
        self.terms, number = np.unique(term, return_inverse=True)
        self.size = size
        order = np.lexsort((doc, number))
        self.keys = number[order] * size + doc[order]
        level = (impact[order].astype(np.int64) << LOW) | ((1 << LOW) - 1 - doc[order])  # of equal impacts the first document
        self.table = [level]
        longest = int(np.bincount(number, minlength=1).max()) if len(number) else 0
        for k in range(1, max(longest, 1).bit_length()):
            half = 1 << (k - 1)
            # entries whose window leaves the list hold whatever stands there; they are never asked for
            level = np.concatenate((np.maximum(level[:-half], level[half:]), level[-half:])) if len(level) > half else level
            self.table.append(level)
        self.table = np.stack(self.table)

    def best(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Largest packed entries of the postings first..last (last left out); 0 where there is none."""
        length = last - first
        k = np.maximum(np.frexp(np.maximum(length, 1).astype(np.float64))[1] - 1, 0)
        a = self.table[k, np.minimum(first, self.table.shape[1] - 1)]
        b = self.table[k, np.maximum(last - (1 << k), 0)]
        return np.where(length > 0, np.maximum(a, b), 0)

    def search(self, term: np.ndarray, weight: np.ndarray, best: int, wave: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the ``best`` documents above 0, the highest first, equal ones in order of their numbers."""
        at = np.searchsorted(self.terms, term)
        known = (at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == term) & (weight > 0)
        base, weight = at[known][:, None] * self.size, weight[known][:, None]
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(base):
            return docs, scores
        low, high = np.zeros(1, np.int64), np.full(1, self.size, np.int64)
        first, last = np.searchsorted(self.keys, base), np.searchsorted(self.keys, base + self.size)  # a row a term, a column an interval
        bound, at_most = self._bounds(first, last, weight)
        least, latest = 0, -1  # score and number of the last of the best documents so far
        while len(low):
            # an interval may hold one of the best: a higher score, or the same at a smaller number
            open_ = (bound > least) | ((bound == least) & (low < latest))
            if not open_.all():
                low, high, bound, at_most, first, last = low[open_], high[open_], bound[open_], at_most[open_], first[:, open_], last[:, open_]
                if not len(low):
                    break
            if len(low) > wave:
                order = np.lexsort((low, -bound))
                take, rest = order[:wave], order[wave:]
            else:
                take, rest = np.arange(len(low)), np.empty(0, np.int64)
            split, a, b = at_most[take], first[:, take], last[:, take]
            here = np.searchsorted(self.keys, base + split)
            held = (here < b) & (self.keys[np.minimum(here, len(self.keys) - 1)] == base + split)
            exact = (np.where(held, self.table[0][np.minimum(here, len(self.keys) - 1)] >> LOW, 0) * weight).sum(axis=0)
            docs, scores = np.concatenate((docs, split)), np.concatenate((scores, exact))
            keep = np.lexsort((docs, -scores))[:best]
            docs, scores = docs[keep], scores[keep]
            if len(docs) == best:
                least, latest = scores[-1], docs[-1]
            # both halves; those without a posting have bound 0 and go
            new_first, new_last = np.concatenate((a, here + held), axis=1), np.concatenate((here, b), axis=1)
            new_bound, new_at = self._bounds(new_first, new_last, weight)
            new_low, new_high = np.concatenate((low[take], split + 1)), np.concatenate((split, high[take]))
            some = new_bound > 0
            low, high = np.concatenate((low[rest], new_low[some])), np.concatenate((high[rest], new_high[some]))
            bound, at_most = np.concatenate((bound[rest], new_bound[some])), np.concatenate((at_most[rest], new_at[some]))
            first, last = np.concatenate((first[:, rest], new_first[:, some]), axis=1), np.concatenate((last[:, rest], new_last[:, some]), axis=1)
        return docs[scores > 0], scores[scores > 0]

    def _bounds(self, first: np.ndarray, last: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each interval the sum of the terms' largest shares, and the document with the largest single share."""
        entry = self.best(first, last)
        share = (entry >> LOW) * weight
        top = entry[share.argmax(axis=0), np.arange(entry.shape[1])]
        return share.sum(axis=0), (1 << LOW) - 1 - (top & ((1 << LOW) - 1))


def _search_shard(p: Params):
    kinds = pa.schema([("shard", pa.int32()), ("item", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(index: pa.Table, asked: pa.Table) -> pa.Table:
        if not index.num_rows or not asked.num_rows:
            return kinds.empty_table()
        row = index["row"].to_numpy()
        unnamed = index["doc_id"].is_null().to_numpy(zero_copy_only=False)
        named = index["doc_id"].fill_null(0).to_numpy()
        order = np.lexsort((row, named, unnamed))
        fresh = np.r_[True, row[order][1:] != row[order][:-1]]
        doc = np.empty(len(row), np.int64)
        doc[order] = np.cumsum(fresh) - 1
        heads = order[fresh]  # a posting of every document
        if len(heads) >= 1 << LOW:
            raise ValueError("more documents in a shard than numbers")
        shard = Shard(index["number"].to_numpy(), doc, index["impact"].to_numpy(), len(heads))

        all_asked = asked["asked"].combine_chunks().flatten()
        item, term, weight = (all_asked.field(k).to_numpy() for k in range(3))
        by_item = np.argsort(item, kind="stable")
        out = []
        for part in np.split(by_item, np.flatnonzero(np.diff(item[by_item])) + 1):
            docs, scores = shard.search(term[part], weight[part], p.best, p.wave)
            out.append((np.full(len(docs), item[part[0]]), heads[docs], scores))
        which, head, score = (np.concatenate(x) for x in zip(*out))
        ids = pa.array(named[head], pa.int64(), mask=unnamed[head])
        return pa.Table.from_arrays([pa.array(np.full(len(head), index["shard"][0].as_py(), np.int32)), pa.array(which, pa.int64()),
                                     pa.array(row[head], pa.int64()), ids, pa.array(score, pa.int64())], schema=kinds)

    return run


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
b AS (SELECT DISTINCT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(w) AS term FROM b) GROUP BY item_id, term),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY doc_id, n, term),
v AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
      FROM (SELECT term, count(*) AS df FROM p GROUP BY term), c),
s AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM q JOIN v USING (term) JOIN p USING (term), c GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""
