"""Benchmark decontamination with a positional inverted index of the training tokens.

1. Every term of the benchmark is counted over all documents.
2. Each window of an item is led by its two rarest terms; windows with a term that no document has cannot occur. Neighbouring
   windows share their leaders, so an item needs few of them.
3. The postings (document, position) of the leading terms are stored as a table: the index.
4. A posting less the leader's place in the item is an alignment of document and item. The alignments of both leaders are
   intersected, the rarest first; what is left is compared word by word with the whole text.

All of it is joins, aggregates and array expressions. A term that a third of all tokens share only makes its posting rows many;
no step gathers the postings of a term. Documents are never paired with each other, and an item that occurs in many documents
gives one row per occurrence, not one per window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut, text_key

GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # all ASCII but digits and small letters


@dataclass(frozen=True)
class Params:
    window: int = 10
    broadcast_terms: int = 200_000  # lists of terms up to this size are broadcast (some 10 MB); longer ones are joined by shuffle
    slop: int = 0  # proximity: leaders may be this many words nearer or farther than in the item


def words(text: str | Column) -> Column:
    """Words of the whole text with A-Z in lower case; none for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.filter(F.split(ascii_lower(text), GAPS), lambda w: w != ""), F.array().cast("array<string>"))


def _small(df: DataFrame, p: Params) -> DataFrame:
    """A written table, broadcast only if its counted rows stay below the bound."""
    return F.broadcast(df) if df.count() <= p.broadcast_terms else df


def items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, w): distinct items that have a word; a null item_id is the empty string."""
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words("text").alias("w"))
    return cut(named.filter(F.size("w") > 0).distinct().withColumn("item", F.monotonically_increasing_id()), "bench-items")


def term_counts(docs: DataFrame, found: DataFrame, p: Params) -> DataFrame:
    """(term, n): occurrences in all documents of each benchmark term; terms that never occur are not listed."""
    terms = cut(found.select(F.explode("w").alias("term")).distinct(), "bench-terms")
    tokens = docs.select(F.explode(words("text")).alias("term"))
    return cut(tokens.join(_small(terms, p), "term").groupBy("term").agg(F.count("*").alias("n")), "bench-term-counts")


def leaders(found: DataFrame, counts: DataFrame, p: Params) -> DataFrame:
    """(item, first, first_term, second, second_term): for each window the places in the item of its rarest two words."""
    size = F.least(F.lit(p.window), F.size("w"))
    placed = found.select("item", F.size("w").alias("size"), F.posexplode("w").alias("q", "term")).join(counts, "term")
    # a word at place q belongs to the windows that start at q - window + 1 .. q
    start = F.explode(F.sequence(F.greatest(F.col("q") - p.window + 1, F.lit(0)),
                                 F.least("q", F.greatest(F.col("size") - p.window, F.lit(0)))))
    window = placed.select("item", "size", "q", "term", "n", start.alias("s"))
    rare = window.groupBy("item", "size", "s").agg(F.array_sort(F.collect_list(F.struct("n", "q", "term"))).alias("r"))
    whole = rare.filter(F.size("r") == F.least(F.lit(p.window), F.col("size")))
    second = F.coalesce(F.get("r", F.lit(1)), F.get("r", F.lit(0)))
    return cut(whole.select("item", F.get("r", F.lit(0)).alias("a"), second.alias("b")).select(
        "item", F.col("a.q").alias("first"), F.col("a.term").alias("first_term"), F.col("b.q").alias("second"),
        F.col("b.term").alias("second_term")).distinct(), "bench-leaders")


def postings(docs: DataFrame, lead: DataFrame, p: Params) -> DataFrame:
    """The index: (term, doc_id, key, pos) for every occurrence of a leading term in every document."""
    terms = cut(lead.select(F.col("first_term").alias("term")).union(lead.select("second_term")).distinct(), "bench-lead-terms")
    tokens = docs.select("doc_id", text_key("text").alias("key"), F.posexplode(words("text")).alias("pos", "term"))
    return cut(tokens.join(_small(terms, p), "term").select("term", "doc_id", "key", "pos"), "token-postings")


def alignments(index: DataFrame, lead: DataFrame, p: Params) -> DataFrame:
    """(item, doc_id, key, shift) where both leaders occur as in the item: document place = item place + shift.

    With ``slop`` the shifts of the two leaders may differ by so much (proximity matches); then shift is the first leader's.
    """
    lead = lead.withColumn("pair", F.struct("first", "second"))
    lists = [index.join(_small(lead.select("item", "pair", F.col(f"{k}_term").alias("term"), F.col(k).alias("q")), p), "term")
             .select("item", "pair", "doc_id", "key", (F.col("pos") - F.col("q")).alias("shift")) for k in ("first", "second")]
    a, b = lists
    on = ["item", "pair", "doc_id", "key", "at"]
    if p.slop:
        cell = F.floor(F.col("shift") / (p.slop + 1))
        a = a.withColumn("at", cell)
        b = b.withColumn("at", F.explode(F.array(cell - 1, cell, cell + 1))).withColumnRenamed("shift", "other")
    else:
        a, b = a.withColumn("at", F.col("shift")), b.withColumnRenamed("shift", "at")
    same = [a[c].eqNullSafe(b[c]) if c == "doc_id" else a[c] == b[c] for c in on]
    if p.slop:
        same.append(F.abs(a["shift"] - b["other"]) <= p.slop)
    return a.join(b, same, "left_semi").select("item", "doc_id", "key", "shift").distinct()


def find(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` plus ``words`` and ``matches``: array of (item_id, starts), the places in the document, from 0, where windows of the
    item begin. With ``slop`` also ``near``: array of (item_id, place) of proximity matches, where the item's rarest words of a window
    stand nearly as far apart as in the item but no window is the same; place is that of the item's start. Rows that share a doc_id but differ in text are told apart; repeated rows get the same result each.

    A benchmark without words, or an empty one, matches nothing. Columns named words, matches, near (with slop), key or _c are replaced.
    """
    found = items(benchmark)
    lead = leaders(found, term_counts(docs, found, p), p)
    hit = alignments(postings(docs, lead, p), lead, p)
    per_doc = (hit.join(found, "item").groupBy("doc_id", "key")
               .agg(F.collect_list(F.struct("item_id", "w", "shift")).alias("_c"))
               .withColumnsRenamed({"doc_id": "_d", "key": "_k"}))
    text = docs.drop("words", "matches", "_c").withColumn("key", text_key("text"))
    joined = text.join(per_doc, text["doc_id"].eqNullSafe(per_doc["_d"]) & (text["key"] == per_doc["_k"]), "left").drop("_d", "_k", "key")
    joined = joined.withColumn("words", words("text"))

    def starts(c: Column) -> Column:
        size = F.least(F.lit(p.window), F.size(c.w))
        low, high = F.greatest(F.lit(0), -c["shift"]), F.least(F.size(c.w), F.size("words") - c["shift"]) - size
        places = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
        same = F.filter(places, lambda s: F.slice("words", s + c["shift"] + 1, size) == F.slice(c.w, s + 1, size))
        return F.struct(c.item_id.alias("item_id"), F.transform(same, lambda s: s + c["shift"]).alias("starts"), size.alias("size"))

    aligned = F.coalesce("_c", F.array().cast(per_doc.schema["_c"].dataType))
    matches = F.filter(F.transform(aligned, starts), lambda m: F.size(m.starts) > 0)
    out = joined.withColumn("matches", matches)
    if p.slop:
        apart = F.filter(aligned, lambda c: F.size(starts(c).starts) == 0)
        out = out.withColumn("near", F.array_distinct(F.transform(apart, lambda c: F.struct(
            c.item_id.alias("item_id"), F.greatest(F.lit(0), c["shift"]).alias("place")))))
    return out.drop("_c")


def report(found: DataFrame) -> DataFrame:
    """``find``'s rows plus n_words, n_hit (words inside a window), n_items, items_sha256, contaminated."""
    places = F.flatten(F.transform("matches", lambda m: F.flatten(
        F.transform(m.starts, lambda s: F.sequence(s, s + m["size"] - 1)))))
    ids = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m.item_id)))
    return (found.withColumn("n_words", F.size("words").cast("long"))
            .withColumn("n_hit", F.size(F.array_distinct(places)).cast("long"))
            .withColumn("_ids", ids).withColumn("n_items", F.size("_ids").cast("long"))
            .withColumn("items_sha256", F.sha2(F.array_join("_ids", ",").cast("binary"), 256)).drop("_ids")
            .withColumn("contaminated", F.col("n_hit") > 0))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS win
      FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS s FROM b WHERE len(w) > 0)),
k AS (SELECT DISTINCT n FROM v),
o AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
      FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, k WHERE len(w) >= n)),
m AS (SELECT doc_id, s, o.n, item_id FROM o JOIN v USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS sha
      FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""
