"""Markdown and content lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .pairs import PAGE


def text_block_markdown(kind: Column, text: Column, level: Column | None = None) -> Column:
    """FN22 for text, lists and titles: titles get their # marks."""
    marks = F.lit("#") if level is None else F.repeat(F.lit("#"), level)
    return F.when(kind == "title", F.concat(marks, F.lit(" "), text)).otherwise(text)


def assemble_documents(blocks: DataFrame, order: str = "block_id") -> DataFrame:
    """AG19: Markdown of each document, blocks apart by a blank line, blank ones left out.

    Pages are put together first, so a long document meets in one task only as page texts.
    """
    kept = blocks.withColumn("md", tx.strip(F.col("md"))).where(F.col("md") != "")
    page = F.array_join(F.array_sort(F.collect_list(F.struct(order, "md")))["md"], "\n\n")
    pages = kept.groupBy(*PAGE).agg(page.alias("md"))
    doc = F.array_join(F.array_sort(F.collect_list(F.struct("page_idx", "md")))["md"], "\n\n")
    return pages.groupBy("doc_id").agg(doc.alias("md"))


def title_list(titles: DataFrame, lines: DataFrame) -> DataFrame:
    """AG15: per document the titles in order as (text, average line height, page number from 1).

    A given ``line_avg_height`` comes first, then the mean of the block's line heights, then the height
    of the block.
    """
    block = [*PAGE, "block_id"]
    mean = lines.groupBy(*block).agg(F.avg((F.col("y1") - F.col("y0")).cast("bigint")).alias("mean_height"))
    height = F.coalesce("line_avg_height", "mean_height", (F.col("y1") - F.col("y0")).cast("double"))
    rows = titles.join(mean, block, "left").select(
        *block, F.struct("page_idx", "block_id", "text", height.alias("height"), (F.col("page_idx") + 1).alias("page_no")).alias("t"))
    ordered = F.array_sort(F.collect_list("t"))
    return rows.groupBy("doc_id").agg(F.transform(ordered, lambda x: F.struct(x["text"], x["height"], x["page_no"])).alias("titles"))


# ---- blocks of every type
#
# A finished block has: type, text (already joined, W20), level, image_path, html, captions and
# footnotes (arrays of joined texts), items (array, lists of the model form), sub_type, guess_lang,
# and its box. Columns that a source lacks may be null.


def _image(path: Column, folder: str) -> Column:
    return F.when(F.coalesce(path, F.lit("")) != "", F.concat(F.lit(f"![]({folder}/"), path, F.lit(")"))).otherwise(F.lit(""))


def _each(texts: Column, before: str, after: str) -> Column:
    wrapped = F.transform(F.coalesce(texts, F.array().cast("array<string>")), lambda t: F.concat(F.lit(before), t, F.lit(after)))
    return F.array_join(wrapped, "")


def block_markdown(folder: str = "images", mode: str = "mm_markdown", formula_on: bool = True, table_on: bool = True) -> Column:
    """FN22, PF17, PF21: Markdown of a finished block.

    ``nlp_markdown`` leaves images and tables out; with formulas or tables off their image stands in.
    """
    col = F.col
    picture = _image(col("image_path"), folder)
    noted = F.size(F.coalesce("footnotes", F.array().cast("array<string>"))) > 0
    image = F.when(
        noted, F.concat(_each(col("captions"), "", "  \n"), picture, _each(col("footnotes"), "  \n", ""))
    ).otherwise(F.concat(picture, _each(col("captions"), "  \n", "")))
    grid = F.when(F.lit(table_on) & (F.coalesce("html", F.lit("")) != ""), F.concat(F.lit("\n"), "html", F.lit("\n"))).otherwise(picture)
    table = F.concat(_each(col("captions"), "", "  \n"), grid, _each(col("footnotes"), "\n", "  "))
    formula = F.when(F.lit(formula_on) & (F.coalesce("text", F.lit("")) != ""), col("text")).otherwise(picture)
    code = F.concat(_each(col("captions"), "", "  \n"), F.when(
        col("sub_type") == "code", F.concat(F.lit("```"), F.coalesce("guess_lang", F.lit("txt")), F.lit("\n"), "text", F.lit("\n```"))).otherwise(col("text")))
    items = F.when(F.size(F.coalesce("items", F.array().cast("array<string>"))) > 0, _each(col("items"), "", "  \n")).otherwise(col("text"))
    kind = col("type")
    shown = (
        F.when(kind == "title", text_block_markdown(kind, col("text"), _level()))
        .when(kind == "image", image).when(kind == "table", table).when(kind == "interline_equation", formula)
        .when(kind == "code", code).when(kind == "list", items)
        .when(kind.isin("text", "index", "ref_text", "phonetic"), col("text")).otherwise(F.lit("")))
    if mode == "nlp_markdown":
        shown = F.when(kind.isin("image", "table"), F.lit("")).otherwise(shown)
    return tx.strip(shown)


def _level() -> Column:
    """Heading level in 1 to 4, 0 below; 1 where none is given."""
    level = F.coalesce("level", F.lit(1))
    return F.when(level > 4, 4).when(level < 1, 0).otherwise(level).cast("int")


def _per_mille(page_w: Column, page_h: Column) -> Column:
    sizes = (("x0", page_w), ("y0", page_h), ("x1", page_w), ("y1", page_h))
    return F.array(*((F.col(c) * 1000 / size).cast("bigint") for c, size in sizes))


def _only(when: Column, value: Column) -> Column:
    return F.when(when, value)


def content_list(blocks: DataFrame, page_w: Column, page_h: Column, folder: str = "images") -> DataFrame:
    """FN23 v1, PF4: one flat record per block in ``record``; fields that do not apply are null and are
    left out when written as JSON."""
    col, kind = F.col, F.col("type")
    is_image, is_table, is_title = kind == "image", kind == "table", kind == "title"
    is_formula, is_code, is_list = kind == "interline_equation", kind == "code", kind == "list"
    has_items = F.size(F.coalesce("items", F.array().cast("array<string>"))) > 0
    path = F.when(F.coalesce("image_path", F.lit("")) != "", F.concat(F.lit(f"{folder}/"), "image_path")).otherwise(F.lit(""))
    texts = lambda name: F.coalesce(name, F.array().cast("array<string>"))
    out_type = F.when(is_title | kind.isin("index"), "text").when(is_formula, "equation").when(is_list & ~has_items, "text").otherwise(kind)
    plain = ~(is_image | is_table | is_code | (is_list & has_items))
    record = F.struct(
        out_type.alias("type"),
        _only(plain & ~(is_formula & (col("text") == "")), col("text")).alias("text"),
        _only(is_title & (_level() != 0), _level()).alias("text_level"),
        _only(is_formula & (col("text") != ""), F.lit("latex")).alias("text_format"),
        _only(is_image | is_table | is_formula, path).alias("img_path"),
        _only(is_image, texts("captions")).alias("image_caption"), _only(is_image, texts("footnotes")).alias("image_footnote"),
        _only(is_table, texts("captions")).alias("table_caption"), _only(is_table, texts("footnotes")).alias("table_footnote"),
        _only(is_table & (col("html") != ""), col("html")).alias("table_body"),
        _only(is_code | (is_list & has_items), col("sub_type")).alias("sub_type"),
        _only(is_code, texts("captions")).alias("code_caption"), _only(is_code, col("text")).alias("code_body"),
        _only(is_code & (col("sub_type") == "code"), col("guess_lang")).alias("guess_lang"),
        _only(is_list & has_items, F.filter(texts("items"), lambda x: tx.strip(x) != "")).alias("list_items"),
        _per_mille(page_w, page_h).alias("bbox"), col("page_idx"))
    return blocks.select(*PAGE, "block_id", record.alias("record"))


def table_kind(html: Column) -> Column:
    """PF18: struct of table type and nesting level."""
    nested = F.regexp_count(html, F.lit("<table")) > 1
    complex_ = html.contains("colspan") | html.contains("rowspan") | nested
    return F.struct(F.when(complex_, "complex_table").otherwise("simple_table").alias("table_type"),
                    F.when(nested, 2).otherwise(1).alias("table_nest_level"))


PAGE_PARTS = {"header": "page_header", "footer": "page_footer", "aside_text": "page_aside_text",
              "page_number": "page_number", "page_footnote": "page_footnote"}
_PIECES = "array<struct<type:string,content:string>>"


def content_list_v2(blocks: DataFrame, page_w: Column, page_h: Column, folder: str = "images") -> DataFrame:
    """FN23 v2: typed record per block: ``type``, ``content`` as JSON (absent fields left out), ``bbox``.

    Needs ``pieces`` (W21) besides the columns of a finished block; captions and footnotes become text pieces.
    """
    col, kind = F.col, F.col("type")

    def as_pieces(name: str) -> Column:
        texts = F.coalesce(name, F.array().cast("array<string>"))
        return F.transform(texts, lambda t: F.struct(F.lit("text").alias("type"), t.alias("content")))

    source = F.struct(F.concat(F.lit(f"{folder}/"), F.coalesce("image_path", F.lit(""))).alias("path"))
    pieces = F.coalesce("pieces", F.array().cast(_PIECES))
    level = _level()
    is_par = kind.isin("text", "phonetic", "index") | ((kind == "title") & (level == 0))
    is_title = (kind == "title") & (level != 0)
    is_code, is_algo = (kind == "code") & (col("sub_type") == "code"), (kind == "code") & (col("sub_type") == "algorithm")
    is_list, is_ref = kind == "list", kind == "ref_text"
    item = lambda p: F.struct(F.lit("text").alias("item_type"), p.alias("item_content"))
    items = F.transform(F.filter(F.coalesce("items", F.array().cast("array<string>")), lambda x: tx.strip(x) != ""),
                        lambda t: item(F.array(F.struct(F.lit("text").alias("type"), t.alias("content")))))
    fields = {
        "paragraph_content": _only(is_par, pieces), "title_content": _only(is_title, pieces), "level": _only(is_title, level),
        "math_content": _only(kind == "interline_equation", col("text")), "math_type": _only(kind == "interline_equation", F.lit("latex")),
        "image_source": _only(kind.isin("image", "table", "interline_equation"), source),
        "image_caption": _only(kind == "image", as_pieces("captions")), "image_footnote": _only(kind == "image", as_pieces("footnotes")),
        "table_caption": _only(kind == "table", as_pieces("captions")), "table_footnote": _only(kind == "table", as_pieces("footnotes")),
        "html": _only(kind == "table", col("html")), "table_type": _only(kind == "table", table_kind(col("html"))["table_type"]),
        "table_nest_level": _only(kind == "table", table_kind(col("html"))["table_nest_level"]),
        "code_caption": _only(is_code, as_pieces("captions")), "code_content": _only(is_code, pieces),
        "code_language": _only(is_code, F.coalesce("guess_lang", F.lit("txt"))),
        "algorithm_caption": _only(is_algo, as_pieces("captions")), "algorithm_content": _only(is_algo, pieces),
        "list_type": _only(is_list | is_ref, F.when(is_ref | (col("sub_type") == "ref_text"), "reference_list").otherwise("text_list")),
        "list_items": F.when(is_ref, F.array(item(pieces))).when(is_list, items),
    }
    for part, name in PAGE_PARTS.items():
        fields[f"{name}_content"] = _only(kind == part, pieces)
    out_type = (
        F.when(is_par, "paragraph").when(is_title, "title").when(kind == "interline_equation", "equation_interline")
        .when(is_algo, "algorithm").when(is_ref, "list").otherwise(kind))
    for part, name in PAGE_PARTS.items():
        out_type = F.when(kind == part, name).otherwise(out_type)
    content = F.to_json(F.struct(*(v.alias(k) for k, v in fields.items())))
    record = F.struct(out_type.alias("type"), content.alias("content"), _per_mille(page_w, page_h).alias("bbox"))
    return blocks.select(*PAGE, "block_id", record.alias("record"))


def pages_of_records(records: DataFrame, pages: DataFrame) -> DataFrame:
    """AG20: one array of records per page in block order; pages without blocks keep an empty one."""
    kind = dict(records.dtypes)["record"]
    per_page = records.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("block_id", "record")))["record"].alias("records"))
    return pages.select(*PAGE).join(per_page, PAGE, "left").withColumn("records", F.coalesce("records", F.array().cast(f"array<{kind}>")))


def with_discarded(body: DataFrame, discarded: DataFrame) -> DataFrame:
    """SE3: body blocks, then the discarded ones of the page (``block_id`` ranks them behind)."""
    last = body.groupBy(*PAGE).agg(F.max("block_id").alias("last"))
    behind = discarded.join(last, PAGE, "left").withColumn("block_id", F.col("block_id") + F.coalesce("last", F.lit(0)) + 1).drop("last")
    return body.unionByName(behind)


def body_data(spans: DataFrame, keys: list[str], order: str) -> DataFrame:
    """AG21: image path and body (html, formula or text) of the first span of each block body."""
    kind = F.col("type")
    body = F.when(kind == "table", F.col("html")).when(kind.isin("interline_equation", "text"), F.col("content")).otherwise(F.lit(""))
    path = F.when(kind == "text", F.lit("")).otherwise(F.coalesce("image_path", F.lit("")))
    first = F.min_by(F.struct(path.alias("image_path"), F.coalesce(body, F.lit("")).alias("body")), order)
    known = spans.where(kind.isin("table", "image", "interline_equation", "text"))
    return known.groupBy(*keys).agg(first.alias("first")).select(*keys, "first.image_path", "first.body")


# ---- image links

IMAGE_LINK = r"!\[([^\]]*)\]\(([^)]+)\)"


def relink_images(docs: DataFrame, keys: list[str], assets: DataFrame, md: str = "md", as_data: bool = False) -> DataFrame:
    """J32, FN24: image links of Markdown replaced from ``assets`` (doc_id, name, url or content).

    Links are matched by file name within the document; known ones become ``<img>`` tags, or data URIs
    (``as_data``, .jpg only). Unknown ones stay.
    """
    text = F.col(md)
    zipped = F.arrays_zip(
        F.split(text, IMAGE_LINK).alias("before"), F.regexp_extract_all(text, F.lit(IMAGE_LINK), F.lit(0)).alias("link"),
        F.regexp_extract_all(text, F.lit(IMAGE_LINK), F.lit(1)).alias("alt"), F.regexp_extract_all(text, F.lit(IMAGE_LINK), F.lit(2)).alias("path"))
    pieces = docs.select(*keys, F.posexplode(zipped).alias("n", "z")).select(*keys, "n", "z.*")
    pieces = pieces.withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))
    value = "content" if as_data else "url"
    found = pieces.join(assets.select("doc_id", "name", F.col(value).alias("target")), ["doc_id", "name"], "left")
    if as_data:
        usable = F.col("target").isNotNull() & F.col("path").endswith(".jpg")
        new = F.concat(F.lit("!["), "path", F.lit("](data:image/jpeg;base64,"), F.base64("target"), F.lit(")"))
    else:
        usable = F.col("target").isNotNull()
        new = F.concat(F.lit('<img src="'), "target", F.lit('" alt="'), "alt", F.lit('">'))
    piece = F.concat("before", F.coalesce(F.when(usable, new).otherwise(F.col("link")), F.lit("")))
    ordered = F.array_sort(F.collect_list(F.struct("n", piece.alias("p"))))
    return found.groupBy(*keys).agg(F.array_join(ordered["p"], "").alias(md))


# File types that count as images.
IMAGE_SUFFIXES = ["png", "jpg", "jpeg", "gif", "bmp", "webp", "svg"]


def image_inventory(files: DataFrame) -> DataFrame:
    """AG17: per document the number of images and their (name, size), by name."""
    images = files.where(F.lower(F.regexp_extract("name", r"\.([^.]*)$", 1)).isin(IMAGE_SUFFIXES))
    return images.groupBy("doc_id").agg(F.count("*").alias("count"), F.array_sort(F.collect_list(F.struct("name", "size"))).alias("list"))


def layout_counts(blocks: DataFrame, kinds: list[str]) -> DataFrame:
    """AG18: boxes of each page by kind."""
    return blocks.groupBy(*PAGE).pivot("type", kinds).count().na.fill(0)


def numbered_boxes(blocks: DataFrame) -> DataFrame:
    """AG18: boxes in drawing order: by block, caption before body before footnote within one; boxes of
    footnotes moved over from another page are not drawn."""
    from pyspark.sql import Window

    part = F.when(F.col("type").endswith("_caption"), 0).when(F.col("type").endswith("_footnote"), 2).otherwise(1)
    shown = blocks.where(~F.coalesce("cross_page", F.lit(False))).withColumn("part", part)
    w = Window.partitionBy(*PAGE).orderBy("block_id", "part", "idx")
    return shown.withColumn("number", F.row_number().over(w)).drop("part")
