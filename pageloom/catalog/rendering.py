"""Markdown, content lists and image links over F2 and F8."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import PAGE_H, PAGE_W
from ..operators import render as R
from . import query

BK = ["doc_id", "page_idx", "block_id"]


def finished(t):
    """Blocks of every type; discarded ones as page headers."""
    one = lambda c: F.filter(F.array(c), lambda x: x.isNotNull())
    items = F.when(F.col("type") == "list", F.array(F.concat("text", F.lit(" ")), F.lit(" "), F.lit("last")))
    return t.render_blocks.withColumns({
        "type": F.when(F.col("type") == "discarded", "header").otherwise(F.col("type")),
        "text": F.when((F.col("type") == "interline_equation") & (F.col("block_id") % 12 == 4), "").otherwise(F.col("text")),
        "captions": one("caption"), "footnotes": one("footnote"), "items": items,
        "guess_lang": F.when(F.col("block_id") % 3 == 0, "python")})


FIN = """f AS (SELECT *,CASE WHEN image_path='' THEN '' ELSE '![](images/'||image_path||')' END pic,COALESCE(caption,'') cap,COALESCE(footnote,'') note,
  CASE WHEN type='interline_equation' AND block_id%12=4 THEN '' ELSE text END tx,CASE WHEN level>4 THEN 4 WHEN level<1 THEN 0 ELSE level END lv FROM render_blocks)"""


def _md(formula, table):
    grid = "CASE WHEN html<>'' THEN chr(10)||html||chr(10) ELSE pic END" if table else "pic"
    eq = "CASE WHEN tx<>'' THEN tx ELSE pic END" if formula else "pic"
    return f"""CASE type WHEN 'title' THEN REPEAT('#',CAST(lv AS INT))||' '||tx WHEN 'text' THEN tx
 WHEN 'image' THEN CASE WHEN footnote IS NOT NULL THEN CASE WHEN caption IS NULL THEN '' ELSE cap||'  '||chr(10) END||pic||'  '||chr(10)||note
   ELSE pic||CASE WHEN caption IS NULL THEN '' ELSE '  '||chr(10)||cap END END
 WHEN 'table' THEN CASE WHEN caption IS NULL THEN '' ELSE cap||'  '||chr(10) END||{grid}||CASE WHEN footnote IS NULL THEN '' ELSE chr(10)||note||'  ' END
 WHEN 'interline_equation' THEN {eq}
 WHEN 'code' THEN CASE WHEN caption IS NULL THEN '' ELSE cap||'  '||chr(10) END||CASE WHEN sub_type='code' THEN '```'||CASE WHEN block_id%3=0 THEN 'python' ELSE 'txt' END||chr(10)||tx||chr(10)||'```' ELSE tx END
 WHEN 'list' THEN tx||'   '||chr(10)||'   '||chr(10)||'last  '||chr(10) ELSE '' END"""


STRIP = "REGEXP_REPLACE({},'^\\s+|\\s+$','','g')"


@query("FN22_block_markdown", ["render_blocks"], f"SELECT doc_id,page_idx,block_id,{STRIP.format(_md(True, True))} md FROM f", FIN)
def fn22(t):
    return finished(t).select(*BK, R.block_markdown().alias("md"))


@query("PF17_markdown_without_media", ["render_blocks"], f"""
SELECT doc_id,page_idx,block_id,CASE WHEN type IN ('image','table') THEN '' ELSE {STRIP.format(_md(True, True))} END md FROM f""", FIN)
def pf17(t):
    return finished(t).select(*BK, R.block_markdown(mode="nlp_markdown").alias("md"))


@query("PF21_formula_and_table_switches", ["render_blocks"], f"""
SELECT doc_id,page_idx,block_id,{STRIP.format(_md(False, False))} md FROM f WHERE type IN ('table','interline_equation')""", FIN)
def pf21(t):
    return finished(t).where(F.col("type").isin("table", "interline_equation")).select(*BK, R.block_markdown(formula_on=False, table_on=False).alias("md"))


@query("AG19_rendered_documents", ["render_blocks"], f"""
SELECT doc_id,STRING_AGG(md,chr(10)||chr(10) ORDER BY page_idx,block_id) md FROM (SELECT doc_id,page_idx,block_id,{STRIP.format(_md(True, True))} md FROM f) z WHERE md<>'' GROUP BY 1""", FIN)
def ag19_rendered(t):
    return R.assemble_documents(finished(t).select(*BK, R.block_markdown().alias("md")))


@query("PF18_table_kind", ["render_blocks"], """
SELECT doc_id,page_idx,block_id,CASE WHEN CONTAINS(html,'colspan') OR nest THEN 'complex_table' ELSE 'simple_table' END table_type,
 CAST(CASE WHEN nest THEN 2 ELSE 1 END AS BIGINT) table_nest_level FROM (SELECT *,LEN(html)-LEN(REPLACE(html,'<table','<tabl'))>1 nest FROM render_blocks) z""")
def pf18(t):
    return t.render_blocks.select(*BK, R.table_kind(F.col("html")).alias("k")).select(*BK, "k.*")


@query("FN23_content_list", ["render_blocks"], """
SELECT doc_id,page_idx,block_id,CASE type WHEN 'title' THEN 'text' WHEN 'interline_equation' THEN 'equation' WHEN 'discarded' THEN 'header' ELSE type END AS type,
 CASE WHEN type IN ('title','text','discarded') OR (type='interline_equation' AND tx<>'') THEN tx END AS text,
 CASE WHEN type='title' AND lv<>0 THEN lv END text_level,CASE WHEN type='interline_equation' AND tx<>'' THEN 'latex' END text_format,
 CASE WHEN type IN ('image','table','interline_equation') THEN CASE WHEN image_path='' THEN '' ELSE 'images/'||image_path END END img_path,
 CASE WHEN type='image' THEN cap END image_caption,CASE WHEN type='table' THEN note END table_footnote,CASE WHEN type='table' AND html<>'' THEN html END table_body,
 CASE WHEN type='code' THEN tx END code_body,CASE WHEN type='list' THEN tx||' |last' END items,
 CAST(FLOOR(x0*1000/612) AS BIGINT)||','||CAST(FLOOR(y1*1000/792) AS BIGINT) box FROM f""", FIN)
def fn23(t):
    r = R.content_list(finished(t), F.lit(PAGE_W), F.lit(PAGE_H))
    f = F.col("record")
    return r.select(*BK, f["type"].alias("type"), f["text"].alias("text"), f["text_level"].alias("text_level"), f["text_format"].alias("text_format"),
                    f["img_path"].alias("img_path"), F.array_join(f["image_caption"], "|").alias("image_caption"),
                    F.array_join(f["table_footnote"], "|").alias("table_footnote"), f["table_body"].alias("table_body"), f["code_body"].alias("code_body"),
                    F.array_join(f["list_items"], "|").alias("items"), F.concat_ws(",", f["bbox"][0], f["bbox"][3]).alias("box"))


@query("FN23_content_list_v2", ["render_blocks"], """
SELECT doc_id,page_idx,block_id,CASE WHEN type='title' AND lv=0 OR type='text' THEN 'paragraph' WHEN type='interline_equation' THEN 'equation_interline'
  WHEN type='code' THEN sub_type WHEN type='discarded' THEN 'page_header' ELSE type END AS type,
 CASE WHEN type='title' AND lv<>0 THEN lv END AS level,CASE WHEN type='table' THEN html END html,
 CASE WHEN type='title' AND lv<>0 OR type='discarded' OR type='text' OR (type='title' AND lv=0) THEN tx END piece,
 CASE WHEN type='list' THEN 'text_list' END list_type,CASE WHEN type='image' AND caption IS NOT NULL THEN cap END caption,
 CASE WHEN type IN ('image','table','interline_equation') THEN 'images/'||image_path END path FROM f""", FIN)
def fn23_v2(t):
    pieces = F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("content")))
    r = R.content_list_v2(finished(t).withColumn("pieces", pieces), F.lit(PAGE_W), F.lit(PAGE_H))
    get = lambda path: F.get_json_object("record.content", path)
    piece = F.coalesce(get("$.title_content[0].content"), get("$.paragraph_content[0].content"), get("$.page_header_content[0].content"))
    return r.select(*BK, F.col("record.type").alias("type"), get("$.level").cast("long").alias("level"), get("$.html").alias("html"), piece.alias("piece"),
                    get("$.list_type").alias("list_type"), get("$.image_caption[0].content").alias("caption"), get("$.image_source.path").alias("path"))


@query("AG20_one_array_per_page", ["render_blocks"], """
SELECT d.doc_id,p page_idx,COUNT(b.block_id) n,COALESCE(STRING_AGG(CASE b.type WHEN 'title' THEN 'text' WHEN 'interline_equation' THEN 'equation' WHEN 'discarded' THEN 'header' ELSE b.type END,',' ORDER BY b.block_id),'') types
FROM (SELECT doc_id,UNNEST(generate_series(0,MAX(page_idx)+1)) p FROM render_blocks GROUP BY doc_id) d LEFT JOIN render_blocks b ON b.doc_id=d.doc_id AND b.page_idx=p GROUP BY 1,2""")
def ag20(t):
    blocks = finished(t)
    pages = blocks.groupBy("doc_id").agg(F.max("page_idx").alias("last")).select("doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last") + 1)).alias("page_idx"))
    out = R.pages_of_records(R.content_list(blocks, F.lit(PAGE_W), F.lit(PAGE_H)), pages)
    return out.select("doc_id", "page_idx", F.size("records").alias("n"), F.array_join(F.col("records")["type"], ",").alias("types"))


@query("SE3_body_then_discarded", ["render_blocks"], """
SELECT doc_id,page_idx,STRING_AGG(type,',' ORDER BY CASE WHEN type='discarded' THEN 1 ELSE 0 END,block_id) types FROM render_blocks GROUP BY 1,2""")
def se3(t):
    b = t.render_blocks
    out = R.with_discarded(b.where("type <> 'discarded'"), b.where("type = 'discarded'"))
    return out.groupBy("doc_id", "page_idx").agg(F.array_join(F.array_sort(F.collect_list(F.struct("block_id", "type")))["type"], ",").alias("types"))


@query("AG21_body_data", ["render_blocks"], """
SELECT doc_id,page_idx,g,CASE WHEN k='text' THEN '' ELSE image_path END image_path,CASE k WHEN 'table' THEN html WHEN 'image' THEN '' ELSE text END body FROM (
 SELECT *,CAST(FLOOR(block_id/3) AS BIGINT) g,CASE WHEN type IN ('image','table','interline_equation') THEN type ELSE 'text' END k,
  ROW_NUMBER() OVER (PARTITION BY doc_id,page_idx,FLOOR(block_id/3) ORDER BY block_id) rn FROM render_blocks WHERE type<>'code') z WHERE rn=1""")
def ag21(t):
    kind = F.when(F.col("type").isin("image", "table", "interline_equation", "code"), F.col("type")).otherwise("text")
    spans = t.render_blocks.withColumns({"type": kind, "content": F.col("text"), "g": F.floor(F.col("block_id") / 3)})
    return R.body_data(spans, ["doc_id", "page_idx", "g"], "block_id")


@query("J32_relink_images", ["md_refs"], """
SELECT doc_id,line_no,CASE WHEN doc_id%3<>0 THEN REPLACE(md,'![fig](images/'||MD5(CAST(doc_id AS VARCHAR))||'.jpg)',
 '<img src="http://assets/'||doc_id||'.jpg" alt="fig">') ELSE md END md FROM md_refs""")
def j32(t):
    assets = t.documents.where("doc_id % 3 <> 0").select(
        "doc_id", F.concat(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit(".jpg")).alias("name"),
        F.concat(F.lit("http://assets/"), "doc_id", F.lit(".jpg")).alias("url"))
    return R.relink_images(t.md_refs, ["doc_id", "line_no"], assets)


@query("FN24_images_as_data", ["md_refs"], """
SELECT doc_id,line_no,CASE WHEN doc_id%3<>0 THEN REPLACE(md,'![fig](images/'||MD5(CAST(doc_id AS VARCHAR))||'.jpg)',
 '![images/'||MD5(CAST(doc_id AS VARCHAR))||'.jpg](data:image/jpeg;base64,'||TO_BASE64(ENCODE('pixels '||doc_id))||')') ELSE md END md FROM md_refs""")
def fn24(t):
    assets = t.documents.where("doc_id % 3 <> 0").select(
        "doc_id", F.concat(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit(".jpg")).alias("name"),
        F.encode(F.concat(F.lit("pixels "), F.col("doc_id").cast("string")), "UTF-8").alias("content"))
    return R.relink_images(t.md_refs, ["doc_id", "line_no"], assets, as_data=True)


@query("AG17_image_inventory", ["render_blocks"], """
SELECT doc_id,COUNT(*) AS "count",STRING_AGG(image_path||':'||size,',' ORDER BY image_path,size) files FROM (
 SELECT doc_id,image_path,x1 size FROM render_blocks WHERE image_path<>'') z GROUP BY 1""")
def ag17(t):
    files = t.render_blocks.select("doc_id", F.col("image_path").alias("name"), F.col("x1").alias("size"))
    listed = F.array_join(F.transform("list", lambda x: F.concat(x["name"], F.lit(":"), x["size"].cast("string"))), ",")
    return R.image_inventory(files).select("doc_id", "count", listed.alias("files"))


@query("AG18_layout_counts", ["render_blocks"], """
SELECT doc_id,page_idx,COUNT(CASE WHEN type='title' THEN 1 END) title,COUNT(CASE WHEN type='text' THEN 1 END) AS text,COUNT(CASE WHEN type='image' THEN 1 END) image,
 COUNT(CASE WHEN type='table' THEN 1 END) AS "table" FROM render_blocks GROUP BY 1,2""")
def ag18(t):
    return R.layout_counts(t.render_blocks, ["title", "text", "image", "table"])


@query("AG18_numbered_boxes", ["blocks_idx"], """
SELECT doc_id,page_idx,idx,ROW_NUMBER() OVER (PARTITION BY doc_id,page_idx ORDER BY CAST(FLOOR(idx/4) AS BIGINT),
 CASE WHEN type LIKE '%_caption' THEN 0 WHEN type LIKE '%_footnote' THEN 2 ELSE 1 END,idx) number FROM blocks_idx WHERE NOT (type='table_footnote' AND idx%2=0)""")
def ag18_numbered(t):
    blocks = t.blocks_idx.withColumns({"block_id": F.floor(F.col("idx") / 4), "cross_page": (F.col("type") == "table_footnote") & (F.col("idx") % 2 == 0)})
    return R.numbered_boxes(blocks).select("doc_id", "page_idx", "idx", "number")
