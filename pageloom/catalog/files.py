"""Sources and sinks: derived rows written in the exchange formats and read back."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..fixtures import PAGE_H, PAGE_W
from ..operators import render as R
from ..session import checkpoint_root
from ..sources import files as S
from ..sources import sinks
from . import query
from .rendering import finished


def _folder(t, name):
    return os.path.join(checkpoint_root(t.spark), f"{name}-{uuid.uuid4().hex[:12]}")


@query("SC1_route_by_content", ["documents"], """
SELECT doc_id,CASE doc_id%8 WHEN 0 THEN 'pdf' WHEN 7 THEN 'pdf' ELSE 'image' END kind,CASE doc_id%8 WHEN 0 THEN 'pdf' WHEN 1 THEN 'png' WHEN 2 THEN 'jpeg' WHEN 3 THEN 'gif' WHEN 4 THEN 'webp' WHEN 5 THEN 'tiff' ELSE 'pdf' END suffix
FROM documents WHERE doc_id%8<>6""")
def sc1(t):
    k = F.col("doc_id") % 8
    lead = F.when(k == 0, "255044462D").when(k == 1, "89504E470D0A1A0A").when(k == 2, "FFD8FFE0").when(k == 3, "474946383961").when(
        k == 4, "524946460000000057454250").when(k == 5, "49492A00").when(k == 7, "25504446")
    files = t.documents.select("doc_id", F.concat(F.unhex(F.coalesce(lead, F.lit("3C68746D6C"))), F.col("text").cast("binary")).alias("content"))
    return S.route_by_content(files).select("doc_id", "kind", "suffix")


@query("SC2_route_by_extension", ["documents"], "SELECT doc_id,CASE WHEN lang IN ('en','fr') THEN 'pdf_image' ELSE 'other' END route FROM documents")
def sc2(t):
    ext = F.when(F.col("lang") == "en", ".PDF").when(F.col("lang") == "fr", ".tif").when(F.col("lang") == "de", ".docx").otherwise("")
    return t.documents.select("doc_id", S.route_by_extension(F.concat(F.lit("/a.b/"), F.col("doc_id").cast("string"), ext)).alias("route"))


@query("SC3_object_ranges", ["documents"], """
SELECT doc_id,CASE WHEN doc_id%3=2 THEN 'main' ELSE source END bucket,MD5(CASE doc_id%3 WHEN 0 THEN ENCODE(text)[11:60] WHEN 1 THEN ENCODE(text)[6:] ELSE ENCODE(text) END) md5 FROM documents""")
def sc3(t):
    k = F.col("doc_id") % 3
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".jsonl"))
    url = F.concat(F.lit("s3://"), "source", F.lit("/x/"), name)
    ref = F.when(k == 0, F.concat(url, F.lit("?bytes=10,50"))).when(k == 1, F.concat(url, F.lit("?bytes=5,-1"))).otherwise(name)
    objects = t.documents.select(F.when(k == 2, "main").otherwise(F.col("source")).alias("bucket"), F.concat(F.lit("x/"), name).alias("key"), F.col("text").cast("binary").alias("content"))
    ranges = S.object_ranges(t.documents.select("doc_id", ref.alias("ref")), "main", "x")
    return S.read_ranges(ranges, objects).select("doc_id", "bucket", F.md5("data").alias("md5"))


@query("SC5_read_page_results", ["dets"], """
SELECT doc_id,page_idx,det_id,category_id,x0,y1,score_m/1000.0 score,CAST(612 AS BIGINT) width FROM dets""")
def sc5(t):
    xs, ys, xe, ye = (F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1"))
    none = F.lit(None).cast("string")
    det = F.struct(F.col("category_id").cast("int").alias("category_id"), F.array(xs, ys, xe, ys, xe, ye, xs, ye).alias("poly"),
                   (F.col("score_m") / 1000.0).alias("score"), none.alias("latex"), none.alias("html"), none.alias("text"))
    pages = t.dets.groupBy("doc_id", "page_idx").agg(F.array_sort(F.collect_list(F.struct("det_id", det.alias("d"))))["d"].alias("layout_dets"))
    page = F.struct("layout_dets", F.struct(F.col("page_idx").cast("int").alias("page_no"), F.lit(PAGE_H).alias("height"), F.lit(PAGE_W).alias("width")).alias("page_info"))
    docs = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_idx", page.alias("p"))))["p"].alias("pages"))
    folder = _folder(t, "page-results")
    docs.write.json(folder)
    read = S.read_page_results(t.spark, folder)
    p = F.col("poly")
    return read.select("doc_id", "page_idx", "det_id", "category_id", p[0].cast("long").alias("x0"), p[5].cast("long").alias("y1"), "score", "width")


@query("SC6_read_model_blocks", ["blocks_idx"], """
SELECT doc_id,DENSE_RANK() OVER (PARTITION BY doc_id ORDER BY page_idx)-1 page_idx,idx-1 idx,type,x0/1000.0 x0,y1/1000.0 y1,'block '||idx content FROM blocks_idx""")
def sc6(t):
    box = F.array(*(F.col(c) / 1000.0 for c in ("x0", "y0", "x1", "y1")))
    block = F.struct("type", box.alias("bbox"), F.lit(0).alias("angle"), F.concat(F.lit("block "), F.col("idx").cast("string")).alias("content"))
    pages = t.blocks_idx.groupBy("doc_id", "page_idx").agg(F.array_sort(F.collect_list(F.struct("idx", block.alias("b"))))["b"].alias("blocks"))
    docs = pages.groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("page_idx", "blocks")))["blocks"]).alias("value"))
    return S.read_model_blocks(docs).select("doc_id", "page_idx", "idx", "type", "x0", "y1", "content")


@query("SC7_middle_json", ["lines"], """
SELECT doc_id,page_idx,COUNT(DISTINCT block_id) n_blocks,COUNT(*) n_lines,STRING_AGG(txt,'|' ORDER BY block_id,line_no) AS text FROM (
 SELECT *,MIN(line_no) OVER (PARTITION BY doc_id,page_idx,para_no,col_no) block_id FROM lines) z GROUP BY 1,2""")
def sc7(t):
    box = lambda *c: F.array(*(F.col(x).cast("double") for x in c)).alias("bbox")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    span = F.struct(box("x0", "y0", "x1", "y1"), F.lit("text").alias("type"), F.col("txt").alias("content"), none("string", "html"), none("string", "latex"),
                    none("string", "image_path"), F.lit(1.0).alias("score"), none("boolean", "cross_page"))
    line = F.struct("line_no", F.struct(box("x0", "y0", "x1", "y1"), F.array(span).alias("spans"), F.col("line_no").cast("double").alias("index")).alias("l"))
    # Bare lines are shuffled, once: blocks, pages and the document that is one row are made of them where they lie.
    blocks = t.lines.repartition("doc_id").groupBy("doc_id", "page_idx", "para_no", "col_no").agg(
        F.min("line_no").alias("block_id"), F.min("x0").alias("bx0"), F.min("y0").alias("by0"), F.max("x1").alias("bx1"), F.max("y1").alias("by1"), F.array_sort(F.collect_list(line))["l"].alias("lines"))
    empty = F.array().cast("array<struct<type:string,bbox:array<double>,index:double,lines:array<struct<bbox:array<double>,spans:array<struct<bbox:array<double>,type:string,content:string,html:string,latex:string,image_path:string,score:double,cross_page:boolean>>,index:double>>>>")
    block = F.struct("block_id", F.struct(F.lit("text").alias("type"), box("bx0", "by0", "bx1", "by1"), F.col("block_id").cast("double").alias("index"), "lines", empty.alias("blocks")).alias("b"))
    pages = blocks.groupBy("doc_id", "page_idx").agg(F.array_sort(F.collect_list(block))["b"].alias("para_blocks"))
    page = F.struct("para_blocks", "page_idx", F.array(F.lit(float(PAGE_W)), F.lit(float(PAGE_H))).alias("page_size"))
    folder = _folder(t, "middle")
    sinks.write_middle(sinks.middle_documents(pages.select("doc_id", "page_idx", page.alias("page")), "pipeline", "1"), folder)
    back = S.read_middle(t.spark, folder).select("doc_id", F.explode("pdf_info").alias("p")).select("doc_id", "p.page_idx", "p.para_blocks")
    lines = F.flatten(F.col("para_blocks")["lines"])
    texts = F.transform(lines, lambda x: x["spans"][0]["content"])
    return back.select("doc_id", "page_idx", F.size("para_blocks").alias("n_blocks"), F.size(lines).alias("n_lines"), F.array_join(texts, "|").alias("text"))


@query("SC8_markdown_sink", ["render_blocks"], """
SELECT doc_id,MD5(STRING_AGG(REGEXP_REPLACE(text,'^\\s+|\\s+$','','g'),chr(10)||chr(10) ORDER BY page_idx,block_id)) md5 FROM render_blocks WHERE REGEXP_REPLACE(text,'\\s','','g')<>'' GROUP BY 1""")
def sc8(t):
    docs = R.assemble_documents(t.render_blocks.withColumn("md", F.col("text")))
    folder = _folder(t, "markdown")
    sinks.write_markdown(docs, folder)
    return t.spark.read.parquet(folder).select("doc_id", F.md5(F.col("md").cast("binary")).alias("md5"))


@query("SC9_content_list_sink", ["render_blocks"], """
SELECT doc_id,block_id,CASE type WHEN 'title' THEN 'text' WHEN 'interline_equation' THEN 'equation' WHEN 'discarded' THEN 'header' ELSE type END AS type,page_idx,type='table' AND html<>'' has_table FROM render_blocks""")
def sc9(t):
    folder = _folder(t, "content-list")
    sinks.write_content_list(R.content_list(finished(t), F.lit(PAGE_W), F.lit(PAGE_H)), folder)
    read = t.spark.read.schema("doc_id bigint, block_id bigint, type string, page_idx bigint, table_body string").json(folder)
    return read.select("doc_id", "block_id", "type", "page_idx", F.col("table_body").isNotNull().alias("has_table"))


@query("SC9_page_list_sink", ["render_blocks"], "SELECT doc_id,page_idx,COUNT(*) n FROM render_blocks GROUP BY 1,2")
def sc9_pages(t):
    pieces = F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("content")))
    blocks = finished(t).withColumn("pieces", pieces)
    pages = R.pages_of_records(R.content_list_v2(blocks, F.lit(PAGE_W), F.lit(PAGE_H)), blocks.select("doc_id", "page_idx").distinct())
    folder = _folder(t, "page-lists")
    sinks.write_page_lists(pages, folder, "vlm")
    read = t.spark.read.schema("doc_id bigint, page_idx bigint, records array<struct<type:string,content:string>>").json(folder)
    return read.select("doc_id", "page_idx", F.size("records").alias("n"))


@query("SC14_result_texts", ["documents"], "SELECT lang,COUNT(*) n FROM documents GROUP BY 1")
def sc14(t):
    folder = _folder(t, "texts")
    lines = t.documents.select("lang", F.regexp_replace("text", r"\s+", " ").alias("value"))
    lines.write.partitionBy("lang").text(folder)
    read = S.read_result_texts(t.spark, folder)
    rows = read.select(F.regexp_extract("path", r"lang=([^/]+)/", 1).alias("lang"), F.regexp_count("text", F.lit("\n")).alias("n"))
    return rows.groupBy("lang").agg(F.sum("n").alias("n"))


