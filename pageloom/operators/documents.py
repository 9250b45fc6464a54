"""Documents: text or scanned, language families, page ranges, names of outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

# Recogniser families and the language codes they serve.
LANGUAGE_FAMILIES = {
    "latin": [
        "af", "az", "bs", "cs", "cy", "da", "de", "es", "et", "fr", "ga", "hr", "hu", "id", "is", "it", "ku", "la", "lt",
        "lv", "mi", "ms", "mt", "nl", "no", "oc", "pi", "pl", "pt", "ro", "rs_latin", "sk", "sl", "sq", "sv", "sw", "tl",
        "tr", "uz", "vi", "french", "german", "fi", "eu", "gl", "lb", "rm", "ca", "qu",
    ],
    "arabic": ["ar", "fa", "ug", "ur", "ps", "ku", "sd", "bal"],
    "cyrillic": [
        "ru", "rs_cyrillic", "be", "bg", "uk", "mn", "abq", "ady", "kbd", "ava", "dar", "inh", "che", "lbe", "lez", "tab",
        "kk", "ky", "tg", "mk", "tt", "cv", "ba", "mhr", "mo", "udm", "kv", "os", "bua", "xal", "tyv", "sah", "kaa",
    ],
    "east_slavic": ["ru", "be", "uk"],
    "devanagari": ["hi", "mr", "ne", "bh", "mai", "ang", "bho", "mah", "sck", "new", "gom", "sa", "bgc"],
}
# Families are tried in this order; a code in two of them goes to the first.
FAMILY_ORDER = ["latin", "east_slavic", "arabic", "cyrillic", "devanagari"]


def classify_documents(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """AG1: (doc_id, kind) with kind ``txt`` or ``ocr``, judged on all pages.

    ``pages``: doc_id, page_idx, text, image_share. Scanned: no pages, fewer than 50 solid characters
    a page, over 5 % unmapped glyphs, at least 80 % of pages nearly covered by images, or
    ``extractable`` false.
    """
    flat = F.replace("text", F.lit("\n"), F.lit(""))
    glyphs = F.regexp_count(flat, F.lit(r"\(cid:\d+\)"))
    facts = pages.groupBy("doc_id").agg(
        F.avg(F.length(F.regexp_replace("text", tx.BLANK + "+", ""))).alias("solid"),
        F.sum(glyphs).alias("glyphs"), F.sum(F.length(flat)).alias("chars"),
        F.sum(F.length(flat) - F.length(F.regexp_replace(flat, r"\(cid:\d+\)", ""))).alias("glyph_chars"),
        F.avg((F.least("image_share", F.lit(1.0)) >= 0.8).cast("double")).alias("covered"))
    broken = F.coalesce(F.try_divide(F.col("glyphs").cast("double"), (F.col("glyphs") + F.col("chars") - F.col("glyph_chars")).cast("double")), F.lit(0.0)) > 0.05
    scanned = (
        F.col("solid").isNull() | (F.col("solid") < 50) | broken | (F.col("covered") >= 0.8) | ~F.coalesce("extractable", F.lit(True)))
    return docs.join(facts, "doc_id", "left").select("doc_id", F.when(scanned, "ocr").otherwise("txt").alias("kind"))


def recognition_on(method: Column, kind: Column) -> Column:
    """PF16: whether text is recognised: by class for ``auto``, always for ``ocr``, never for ``txt``."""
    return F.when(method == "auto", kind == "ocr").otherwise(method == "ocr")


def model_recognition_on(ocr_on: Column, lang: Column, formulas_on: Column, force: bool = False, force_boxes: bool = False) -> Column:
    """PF16: whether the language model reads the text itself."""
    if force:
        return F.lit(True)
    return ocr_on & lang.isin("ch", "en") & formulas_on & F.lit(not force_boxes)


def language_family(df: DataFrame, code: str = "lang") -> DataFrame:
    """Adds ``family`` by a small broadcast table; codes of no family stand for themselves."""
    seen, rows = set(), []
    for family in FAMILY_ORDER:
        for lang in LANGUAGE_FAMILIES[family]:
            if lang not in seen:
                seen.add(lang)
                rows.append((lang, family))
    table = df.sparkSession.createDataFrame(rows, f"{code} string, family string")
    return df.join(F.broadcast(table), code, "left").withColumn("family", F.coalesce("family", code))


def page_range(pages: DataFrame, start: int = 0, end: int | None = None) -> DataFrame:
    """SC11: pages from start to end, both included; an end that is missing, negative or too large
    means the last page, so a plain filter on ``page_idx`` does, and it reaches the scan."""
    kept = pages.where(F.col("page_idx") >= start)
    return kept.where(F.col("page_idx") <= end) if end is not None and end >= 0 else kept


def crop_name(kind: Column, page_md5: Column, page: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """SC12: file name of a cut-out, empty for a box without extent."""
    parts = F.concat(kind, F.lit("/"), page_md5, F.lit("_"), F.concat_ws("_", page, *(c.cast("bigint") for c in (x0, y0, x1, y1))))
    return F.when((x0 >= x1) | (y0 >= y1), F.lit("")).otherwise(F.concat(F.sha2(parts.cast("binary"), 256), F.lit(".jpg")))


def output_path(root: Column, name: Column, backend: Column, method: Column) -> Column:
    """SC13: {root}/{name}/{method}, ``vlm`` or ``hybrid_{method}``; null for unknown backends."""
    leaf = (
        F.when(backend.startswith("pipeline"), method).when(backend.startswith("vlm"), F.lit("vlm"))
        .when(backend.startswith("hybrid"), F.concat(F.lit("hybrid_"), method)))
    return F.when(leaf.isNotNull(), F.concat_ws("/", root, name, leaf))


# Result parts that may be asked for.
RESULT_PARTS = ["md", "middle_json", "model_output", "content_list", "images"]


def select_results(results: DataFrame, parts: list[str]) -> DataFrame:
    """SC10: the parts asked for; unfinished tasks give their status only. Other columns are not read."""
    unknown = set(parts) - set(RESULT_PARTS)
    if unknown:
        raise ValueError(f"unknown result parts: {sorted(unknown)}")
    done = F.col("status") == "completed"
    return results.select("task_id", "status", *(F.when(done, F.col(p)).alias(p) for p in RESULT_PARTS if p in parts))


def inference_batches(pages: DataFrame, size: int = 384, keys: list[str] = ("doc_id", "page_idx")) -> DataFrame:
    """Adds ``batch``: pages in order, cut into chunks of ``size``.

    Rows are numbered per range partition and each partition's offset comes from a list of one count
    per partition, so no single task sees all pages.
    """
    spark = pages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = pages.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # monotonically_increasing_id: partition number in the upper bits, row number in the lower 33.
    placed = ranged.withColumn("mid", F.monotonically_increasing_id()).withColumns({
        "part": F.shiftright("mid", 33), "k": F.col("mid").bitwiseAND(F.lit((1 << 33) - 1))}).drop("mid")
    from ..session import materialize
    placed = materialize(placed, "placed")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return placed.join(F.broadcast(before), "part").withColumn("batch", F.floor((F.col("before") + F.col("k")) / size)).drop("part", "k", "before")


def area_batches(crops: DataFrame, size: int, keys: list[str]) -> DataFrame:
    """W24, formulas: crops by area (order kept on ties), cut into chunks; results carry ids, so the
    order need not be restored."""
    return inference_batches(crops, size, ["area", *keys])


def collapse_tokens(tokens: DataFrame, blank: int = 0) -> DataFrame:
    """AG22: (sample, tokens, confidence): blanks and immediate repeats dropped, mean probability of the
    rest, 1 where nothing is left."""
    w = Window.partitionBy("sample").orderBy("step")
    kept = (F.col("token") != blank) & F.coalesce(F.lag("token").over(w) != F.col("token"), F.lit(True))
    flagged = tokens.withColumn("kept", kept)
    ordered = F.array_sort(F.collect_list(F.when(F.col("kept"), F.struct("step", "token"))))
    return flagged.groupBy("sample").agg(ordered["token"].alias("tokens"), F.coalesce(F.avg(F.when(F.col("kept"), F.col("prob"))), F.lit(1.0)).alias("confidence"))
