"""Repeated runs of lines: a suffix array over line ids by distributed prefix doubling, and deletion of later copies.

All lines of the corpus stand in one sequence: documents in order of doc_id, one empty place between two of them. A line that
occurs once can't be in a repeated run, so only the places of repeated lines have a rank. In round k all suffixes are ranked by
their first 2**k lines: the rank of 2**(k+1) lines is that of the pair (rank here, rank 2**k places on). A rank is named by the
first place that has it; suffixes alone in their rank leave, since nothing repeats that prefix. What stays in a round are
the LCP intervals of depth 2**k or more of the suffix array: a group of equal rank is one interval, its name is its
earliest suffix.

A place whose rank is named by an earlier place starts a later copy of 2**k lines. A maximal repeated run of L lines is covered
by the windows of ``2**floor(log2 L)`` lines that start in it, so the union of those windows over all rounds (of at least
``min_lines`` lines; that length is ranked by two overlapping windows) gives exactly the maximal runs, and only rounds up
to the longest repeat are needed. The earliest copy of every line stays.

With ``min_words`` a run of fewer than ``min_lines`` lines also counts if it has that many words, so a repeated paragraph on one
line goes too. Its windows are the rank groups of the lengths below ``min_lines``.

Only DataFrame operations are used. A hot line is many rows of equal rank; it is counted by partial aggregation and joined back.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_key


@dataclass(frozen=True)
class Params:
    min_lines: int = 2  # shorter repeats stay, unless they have min_words words
    min_words: int | None = None  # words (between ASCII blanks) from which a shorter repeat counts; None: only lines count
    rounds: int = 40  # a run can't have more than 2**40 lines


# A shorter run is a passage from 50 words on.
PASSAGES = Params(min_words=50)
BLANKS = r"[\x20\x09-\x0D]+"


def lines(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, key, line, h1, h2, and n_words if words count): each line of each distinct (doc_id, text), by 128 bits of its exact content. Null texts have none."""
    text = docs.filter(F.col("text").isNotNull()).select("doc_id", text_key("text").alias("key"), "text")
    split = text.select("doc_id", "key", F.posexplode(F.split("text", "\n", -1)).alias("line", "content"))
    counted = [F.size(F.filter(F.split("content", BLANKS), lambda w: w != "")).alias("n_words")] if p.min_words else []
    hashed = split.select("doc_id", "key", "line", F.xxhash64("content").alias("h1"), F.xxhash64(F.lit(5), "content").alias("h2"), *counted)
    return hashed.dropDuplicates(["doc_id", "key", "line"])  # of repeated rows


def places(rows: DataFrame) -> DataFrame:
    """(doc_id, key, base): place of the first line of each document. Sorted into ranges; only one sum per range is put in order."""
    sizes = rows.groupBy("doc_id", "key").agg((F.max("line") + 2).cast("long").alias("n"))  # with the empty place
    ranged = cut(sizes.repartitionByRange("doc_id", "key").withColumn("part", F.spark_partition_id()), "line-ranges")
    sums = ranged.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    base = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("doc_id", "key").rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(base, "part")
            .select("doc_id", "key", (F.col("before") + F.col("inside")).alias("base")))


def named(pairs: DataFrame, on: list[str], name: str) -> DataFrame:
    """(place, rank) of the places that share their ``on`` with another; rank: the first such place."""
    groups = cut(pairs.groupBy(*on).agg(F.min("place").alias("rank"), F.count("*").alias("n")).filter(F.col("n") > 1).drop("n"), f"{name}-groups")
    return cut(pairs.join(groups, on).select("place", "rank"), name)


def paired(first: DataFrame, second: DataFrame, ahead: int) -> DataFrame:
    """(place, r1, r2) with r2 the rank ``ahead`` places on; places without one are left out."""
    later = second.select((F.col("place") - ahead).alias("place"), F.col("rank").alias("r2"))
    return first.withColumnRenamed("rank", "r1").join(later, "place")


def later_copies(ranks: DataFrame, size: int) -> DataFrame:
    """(place, size): windows of ``size`` lines that occurred before."""
    return ranks.filter(F.col("rank") < F.col("place")).select("place", F.lit(size).alias("size"))


def wordy(windows: DataFrame, seq: DataFrame, p: Params) -> DataFrame:
    """Those of ``windows`` (place, size) whose lines have ``min_words`` words together."""
    inside = windows.select("place", "size", F.explode(F.sequence(F.col("place"), F.col("place") + F.col("size") - 1)).alias("at"))
    counted = inside.join(seq.select(F.col("place").alias("at"), "n_words").filter("n_words > 0"), "at").groupBy("place", "size").agg(F.sum("n_words").alias("n"))
    return counted.filter(F.col("n") >= p.min_words).select("place", "size")


def repeated_runs(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, key, runs): for each document the maximal runs of lines that are later copies, as sorted (first, last), inclusive."""
    rows = cut(lines(docs, p), "lines")
    at = places(rows).withColumnsRenamed({"doc_id": "_d", "key": "_k"})
    seq = cut(rows.join(at, rows.doc_id.eqNullSafe(at["_d"]) & (rows.key == at["_k"])).drop("_d", "_k")
              .withColumn("place", F.col("base") + F.col("line")).drop("base"), "line-places")
    ranks = named(seq.select("place", "h1", "h2"), ["h1", "h2"], "line-rank-0")
    size, found = 1, []
    for k in range(p.rounds):
        for least in range(size, min(2 * size, p.min_lines)) if p.min_words else ():
            exact = ranks if least == size else named(paired(ranks, ranks, least - size), ["r1", "r2"], f"line-rank-of-{least}")
            found.append(wordy(later_copies(exact, least), seq, p))
        if size >= p.min_lines:
            found.append(later_copies(ranks, size))
        elif p.min_lines < 2 * size:
            exact = named(paired(ranks, ranks, p.min_lines - size), ["r1", "r2"], "line-rank-least")
            found.append(later_copies(exact, p.min_lines))
        ranks = named(paired(ranks, ranks, size), ["r1", "r2"], f"line-rank-{k + 1}")
        size *= 2
        if ranks.isEmpty():
            break
    windows = reduce(DataFrame.union, found, seq.select("place", F.lit(0).alias("size")).limit(0))
    longest = windows.groupBy("place").agg(F.max("size").alias("size"))
    # lines of one document; no window reaches over its end, as the place behind its last line has no rank
    doc = Window.partitionBy("doc_id", "key").orderBy("line")
    begun = seq.select("doc_id", "key", "line", "place").join(longest, "place")
    reach = begun.withColumn("reach", F.max(F.col("line") + F.col("size") - 1).over(doc.rowsBetween(Window.unboundedPreceding, -1)))
    island = reach.withColumn("run", F.sum((F.col("reach").isNull() | (F.col("line") > F.col("reach") + 1)).cast("int")).over(doc))
    runs = island.groupBy("doc_id", "key", "run").agg(F.min("line").alias("first"), F.max(F.col("line") + F.col("size") - 1).alias("last"))
    return runs.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct(F.col("first").cast("int").alias("first"), F.col("last").cast("int").alias("last")))).alias("runs"))


def remove_copies(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` with ``text`` less the lines of later copies, plus ``runs`` (removed lines, as in ``repeated_runs``; empty if none)
    and ``n_lines`` (before). A null text stays null and has no lines; an empty text is one empty line. A text that loses all its
    lines becomes empty. Repeated rows (same doc_id and text) are one document to the search and are all treated alike; rows that
    share a doc_id but not a text are documents of their own. Columns of the names runs and n_lines are replaced.
    """
    found = repeated_runs(docs.select("doc_id", "text"), p).withColumnsRenamed({"doc_id": "_d", "key": "_k", "runs": "_runs"})
    text = docs.drop("runs", "n_lines").withColumn("_key", text_key("text"))
    joined = text.join(found, text["doc_id"].eqNullSafe(found["_d"]) & (text["_key"] == found["_k"]), "left").drop("_d", "_k", "_key")
    joined = joined.withColumn("_lines", F.split("text", "\n", -1))
    lasts = F.concat(F.array(F.lit(-1)), F.transform("_runs", lambda r: r["last"]))
    firsts = F.concat(F.transform("_runs", lambda r: r["first"]), F.array(F.size("_lines")))
    kept = F.flatten(F.zip_with(lasts, firsts, lambda a, b: F.slice("_lines", a + 2, b - a - 1)))
    return (joined.withColumn("n_lines", F.coalesce(F.size("_lines"), F.lit(0)))
            .withColumn("text", F.when(F.col("_runs").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
            .withColumn("runs", F.coalesce("_runs", F.array().cast(found.schema["_runs"].dataType))).drop("_lines", "_runs"))


def report(found: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, n_runs, longest_run, kept_sha256 (of the text that stays; null for a null text)."""
    length = F.transform("runs", lambda r: (r["last"] - r["first"] + 1).cast("long"))
    return found.select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"),
        F.aggregate(length, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"), F.size("runs").cast("long").alias("n_runs"),
        F.coalesce(F.array_max(length), F.lit(0).cast("long")).alias("longest_run"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


# Lines in a window of two that occurred before; %s names the table of documents.
REMOVED = """
l AS (SELECT doc_id, unnest(range(len(a))) AS line, unnest(a) AS content FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM %s WHERE text IS NOT NULL)),
w AS (SELECT a.doc_id, a.line, row_number() OVER (PARTITION BY a.content, b.content ORDER BY a.doc_id, a.line) > 1 AS later
      FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.line = a.line + 1),
gone AS (SELECT DISTINCT doc_id, line + k AS line FROM w, (VALUES (0), (1)) AS t(k) WHERE later)"""

REPORT = """,
isle AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, line - row_number() OVER (PARTITION BY doc_id ORDER BY line) AS g FROM gone) GROUP BY doc_id, g),
runs AS (SELECT doc_id, sum(n) AS n_removed, count(*) AS n_runs, max(n) AS longest_run FROM isle GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(content, chr(10) ORDER BY line) AS text FROM l ANTI JOIN gone USING (doc_id, line) GROUP BY doc_id)
SELECT d.doc_id, CAST(CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS BIGINT) AS n_lines,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs,
       CAST(coalesce(longest_run, 0) AS BIGINT) AS longest_run,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept.text, '')) END AS kept_sha256
FROM documents d LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
ORACLE = "WITH" + REMOVED % "documents" + REPORT

# The same, and single lines of 50 words or more that occurred before.
PASSAGE_ORACLE = "WITH" + REMOVED.replace("gone AS", "pairs AS") % "documents" + r""",
again AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, line) > 1 AS later FROM l),
gone AS (SELECT doc_id, line FROM pairs UNION
         SELECT doc_id, line FROM again WHERE later AND len(regexp_extract_all(content, '[^\x20\x09-\x0D]+')) >= 50)""" + REPORT
