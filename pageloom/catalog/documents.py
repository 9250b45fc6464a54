"""Documents: classification, languages, page ranges, names, batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import documents as D
from . import query


def text_pages(t):
    pages = t.page_text.groupBy("doc_id", "page_idx").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("line_no", "txt2")))["txt2"], "\n").alias("text"), (F.max("img_pct") / 100.0).alias("image_share"))
    return pages


KINDS = """
pg AS (SELECT doc_id,page_idx,STRING_AGG(txt2,chr(10) ORDER BY line_no) AS text,MAX(img_pct)/100.0 share FROM page_text GROUP BY 1,2),
sm AS (SELECT *,REPLACE(text,chr(10),'') fl FROM pg),
ft AS (SELECT doc_id,AVG(LENGTH(REGEXP_REPLACE(text,'\\s+','','g'))) solid,SUM(LEN(REGEXP_EXTRACT_ALL(fl,'\\(cid:\\d+\\)'))) g,SUM(LENGTH(fl)) c,
  SUM(LENGTH(fl)-LENGTH(REGEXP_REPLACE(fl,'\\(cid:\\d+\\)','','g'))) gc,AVG(CASE WHEN share>=0.8 THEN 1.0 ELSE 0 END) cov FROM sm GROUP BY 1),
kd AS (SELECT d.doc_id,d.lang,CASE WHEN solid IS NULL OR solid<50 OR CAST(g AS DOUBLE)/(g+c-gc)>0.05 OR cov>=0.8 OR d.doc_id%31=0 THEN 'ocr' ELSE 'txt' END kind FROM documents d LEFT JOIN ft USING (doc_id))"""


def kinds(t):
    docs = t.documents.select("doc_id", "lang", (F.col("doc_id") % 31 != 0).alias("extractable"))
    return D.classify_documents(docs, text_pages(t)).join(docs.select("doc_id", "lang"), "doc_id")


@query("AG1_text_or_scanned", ["page_text"], "SELECT doc_id,kind FROM kd", KINDS)
def ag1(t):
    return kinds(t).select("doc_id", "kind")


@query("PF16_recognition_mode", ["page_text"], """
SELECT doc_id,CASE doc_id%3 WHEN 0 THEN kind='ocr' WHEN 1 THEN true ELSE false END ocr_on,
 CASE doc_id%3 WHEN 0 THEN kind='ocr' WHEN 1 THEN true ELSE false END AND lang='en' AND doc_id%5<>0 model_ocr_on FROM kd""", KINDS)
def pf16(t):
    k = F.col("doc_id") % 3
    method = F.when(k == 0, "auto").when(k == 1, "ocr").otherwise("txt")
    df = kinds(t).withColumn("ocr_on", D.recognition_on(method, F.col("kind")))
    return df.select("doc_id", "ocr_on", D.model_recognition_on(F.col("ocr_on"), F.col("lang"), F.col("doc_id") % 5 != 0).alias("model_ocr_on"))


@query("J30_language_family", ["documents"], """
SELECT doc_id,code,CASE WHEN code IN ('fr','de','es') THEN 'latin' WHEN code IN ('ru') THEN 'east_slavic' WHEN code='hi' THEN 'devanagari' ELSE code END family
FROM (SELECT doc_id,CASE WHEN doc_id%7=0 THEN 'ru' WHEN doc_id%7=1 THEN 'hi' ELSE lang END code FROM documents) z""")
def j30(t):
    k = F.col("doc_id") % 7
    codes = t.documents.select("doc_id", F.when(k == 0, "ru").when(k == 1, "hi").otherwise(F.col("lang")).alias("code"))
    return D.language_family(codes, "code")


@query("SC11_page_range", ["lines"], "SELECT doc_id,page_idx,line_no FROM lines WHERE page_idx BETWEEN 1 AND 2")
def sc11(t):
    return D.page_range(t.lines, 1, 2).select("doc_id", "page_idx", "line_no")


@query("SC11_page_range_to_last", ["lines"], "SELECT doc_id,page_idx,line_no FROM lines WHERE page_idx>=2")
def sc11_last(t):
    return D.page_range(t.lines, 2, -1).select("doc_id", "page_idx", "line_no")


@query("SC12_crop_names", ["dets"], """
SELECT doc_id,page_idx,det_id,CASE WHEN det_id%50=0 THEN '' ELSE SHA256('image/'||MD5(CAST(doc_id AS VARCHAR))||'_'||page_idx||'_'||x0||'_'||y0||'_'||x1||'_'||y1)||'.jpg' END name FROM dets""")
def sc12(t):
    x1 = F.when(F.col("det_id") % 50 == 0, F.col("x0")).otherwise(F.col("x1"))
    md5 = F.md5(F.col("doc_id").cast("string").cast("binary"))
    return t.dets.select("doc_id", "page_idx", "det_id", D.crop_name(F.lit("image"), md5, F.col("page_idx"), F.col("x0"), F.col("y0"), x1, F.col("y1")).alias("name"))


@query("SC13_output_paths", ["documents"], """
SELECT doc_id,CASE doc_id%4 WHEN 0 THEN '/out/'||doc_id||'/auto' WHEN 1 THEN '/out/'||doc_id||'/vlm' WHEN 2 THEN '/out/'||doc_id||'/hybrid_ocr' END path FROM documents""")
def sc13(t):
    k = F.col("doc_id") % 4
    backend = F.when(k == 0, "pipeline").when(k == 1, "vlm-http").when(k == 2, "hybrid-auto").otherwise("other")
    method = F.when(k == 2, "ocr").otherwise("auto")
    return t.documents.select("doc_id", D.output_path(F.lit("/out"), F.col("doc_id").cast("string"), backend, method).alias("path"))


@query("SC10_select_results", ["documents"], """
SELECT doc_id task_id,CASE WHEN doc_id%3=0 THEN 'processing' ELSE 'completed' END status,CASE WHEN doc_id%3<>0 THEN text END md,CASE WHEN doc_id%3<>0 THEN lang END content_list FROM documents""")
def sc10(t):
    results = t.documents.select(
        F.col("doc_id").alias("task_id"), F.when(F.col("doc_id") % 3 == 0, "processing").otherwise("completed").alias("status"), F.col("text").alias("md"),
        F.col("source").alias("middle_json"), F.col("source").alias("model_output"), F.col("lang").alias("content_list"), F.col("source").alias("images"))
    return D.select_results(results, ["md", "content_list"])


@query("W24_inference_batches", ["lines"], """
SELECT doc_id,page_idx,CAST(FLOOR((ROW_NUMBER() OVER (ORDER BY doc_id,page_idx)-1)/384) AS BIGINT) batch FROM (SELECT DISTINCT doc_id,page_idx FROM lines) z""")
def w24(t):
    return D.inference_batches(t.lines.select("doc_id", "page_idx").distinct())


@query("W24_area_batches", ["dets"], """
SELECT doc_id,page_idx,det_id,CAST(FLOOR((ROW_NUMBER() OVER (ORDER BY (x1-x0)*(y1-y0),doc_id,page_idx,det_id)-1)/64) AS BIGINT) batch FROM dets""")
def w24_area(t):
    crops = t.dets.select("doc_id", "page_idx", "det_id", ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("area"))
    return D.area_batches(crops, 64, ["doc_id", "page_idx", "det_id"]).drop("area")


@query("AG22_token_collapse", ["tokens"], """
SELECT sample,STRING_AGG(CASE WHEN kept THEN CAST(token AS VARCHAR) END,',' ORDER BY step) tokens,ROUND(COALESCE(AVG(CASE WHEN kept THEN prob_m/1000.0 END),1.0),9) confidence FROM (
 SELECT *,token<>0 AND COALESCE(LAG(token) OVER (PARTITION BY sample ORDER BY step)<>token,true) kept FROM tokens) z GROUP BY 1""")
def ag22(t):
    out = D.collapse_tokens(t.tokens.withColumn("prob", F.col("prob_m") / 1000.0))
    shown = F.when(F.size("tokens") > 0, F.array_join(F.col("tokens").cast("array<string>"), ","))
    return out.select("sample", shown.alias("tokens"), F.round("confidence", 9).alias("confidence"))
