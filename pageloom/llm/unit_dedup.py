"""Substring dedup by hashing lines and the sentences in them.

Units end at a line break and at ``.``, ``!`` and ``?``, so a passage that stands in the middle of another line is found too. A unit is
normalised (A-Z to lower case, one space between words) and hashed to 128 bits. Digests are grouped over the whole corpus and
the earliest unit of each, by (doc_id, unit), stays. All others are later copies; a run of neighbouring later copies is removed if it
has at least ``min_words`` words together, so stock phrases and short headings are left alone. Spans keep the offsets of
the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, decoded, text_key

UNIT = re.compile(r"[^.!?\n]+[.!?\n]*|[.!?\n]+")
_BLANK = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Params:
    min_words: int = 20


def units(text: str) -> Column:
    """array<struct<start,end,words,digest>> of the units that have a word; offsets in characters, end exclusive."""

    @F.arrow_udf("array<struct<start:int,end:int,words:int,digest:binary>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import xxhash

        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32()), ("digest", pa.binary())]))
        for batch in batches:
            out = []
            for value in decoded(batch):
                found = []
                for m in UNIT.finditer(value or ""):
                    words = _BLANK.findall(m[0])
                    if words:
                        norm = " ".join(words).translate(_LOWER).encode()
                        found.append((m.start(), m.end(), len(words), xxhash.xxh3_128_digest(norm)))
                out.append(found)
            yield pa.array(out, kind)

    return run(F.col(text))


def removed(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per removed span of ``docs`` (doc_id, text): doc_id, key, start, end, n_words, n_units, first_doc_id, first_start (where
    the first unit of the span stays) and first_doc_ids (all documents that keep a unit of it, sorted).

    Null and blank texts have no units. Rows equal in doc_id and text are one document; rows that share a doc_id only are told apart by
    ``key``. A null doc_id comes before all others.
    """
    rows = cut(docs.select("doc_id", text_key("text").alias("key"), F.posexplode(units("text")).alias("unit", "u"))
               .select("doc_id", "key", "unit", "u.*"), "units")
    groups = (rows.groupBy("digest").agg(F.min(F.struct("doc_id", "key", "unit", "start")).alias("first"), F.count("*").alias("n"))
              .filter(F.col("n") > 1).drop("n"))
    here = rows.join(cut(groups, "unit-groups"), "digest")
    own = F.struct("doc_id", "key", "unit")
    later = here.filter(~own.eqNullSafe(F.struct("first.doc_id", "first.key", "first.unit"))).drop("digest").distinct()
    doc = Window.partitionBy("doc_id", "key").orderBy("unit")  # the units of one document
    island = later.withColumn("run", F.col("unit") - F.row_number().over(doc))
    spans = island.groupBy("doc_id", "key", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("n_words"), F.count("*").alias("n_units"),
        F.min_by("first", "unit").alias("first"), F.array_sort(F.collect_set("first.doc_id")).alias("first_doc_ids"))
    return spans.filter(F.col("n_words") >= p.min_words).select(
        "doc_id", "key", "start", "end", "n_words", "n_units", F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.start").alias("first_start"), "first_doc_ids")


def remove(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` with the removed spans cut out of ``text``, and ``spans`` (sorted start, end, first_doc_id; offsets of the original).

    A null text stays null; a text that is removed whole becomes empty. A column named spans is replaced.
    """
    found = removed(docs.select("doc_id", "text"), p).groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "first_doc_id"))).alias("_spans")).withColumnsRenamed({"doc_id": "_d", "key": "_k"})
    text = docs.drop("spans").withColumn("_key", text_key("text"))
    joined = text.join(found, text["doc_id"].eqNullSafe(found["_d"]) & (text["_key"] == found["_k"]), "left").drop("_d", "_k", "_key")
    ends = F.concat(F.array(F.lit(0)), F.transform("_spans", lambda s: s["end"]))
    starts = F.concat(F.transform("_spans", lambda s: s["start"]), F.array(F.char_length("text")))
    left = F.array_join(F.zip_with(ends, starts, lambda a, b: F.substring(F.col("text"), a + 1, b - a)), "")
    return (joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(left))
            .withColumn("spans", F.coalesce("_spans", F.array().cast(found.schema["_spans"].dataType))).drop("_spans"))


ORACLE = r"""
WITH p AS (SELECT doc_id, regexp_extract_all(text, '[^.!?\n]+[.!?\n]*|[.!?\n]+') AS a FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS s FROM p),
o AS (SELECT doc_id, i, s, sum(length(s)) OVER (PARTITION BY doc_id ORDER BY i) AS stop,
      regexp_extract_all(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM u),
n AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS unit, stop - length(s) AS start, stop, len(w) AS words,
      array_to_string(w, ' ') AS norm FROM o WHERE len(w) > 0),
f AS (SELECT *, first_value(doc_id) OVER r AS first_doc_id, first_value(start) OVER r AS first_start, row_number() OVER r AS place
      FROM n WINDOW r AS (PARTITION BY norm ORDER BY doc_id, unit ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
l AS (SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS run FROM f WHERE place > 1)
SELECT doc_id, CAST(min(start) AS BIGINT) AS start, CAST(max(stop) AS BIGINT) AS "end", CAST(sum(words) AS BIGINT) AS n_words,
       count(*) AS n_units, arg_min(first_doc_id, unit) AS first_doc_id, CAST(arg_min(first_start, unit) AS BIGINT) AS first_start
FROM l GROUP BY doc_id, run HAVING sum(words) >= 20
"""
