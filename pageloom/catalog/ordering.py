"""Reading order over F1 and F2."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ordering as O
from . import query
from .blocks import BLOCKS, typed

PG = ["doc_id", "page_idx"]


@query("AG2_page_line_height", ["dets"], """
SELECT p.doc_id,p.page_idx,COALESCE(QUANTILE_CONT(k.y1-k.y0,0.5),10) line_height FROM (SELECT DISTINCT doc_id,page_idx FROM k) p
LEFT JOIN k ON k.doc_id=p.doc_id AND k.page_idx=p.page_idx AND k.type IN ('text','title','table_caption') AND (p.doc_id+p.page_idx)%7<>0 GROUP BY 1,2""", BLOCKS)
def ag2(t):
    k = typed(t)
    lines = k.withColumn("type", F.when((F.col("doc_id") + F.col("page_idx")) % 7 == 0, "image_body").otherwise(F.col("type")))
    return O.page_line_height(lines, k.select(*PG).distinct())


VIRTUAL = """vl AS (SELECT doc_id,page_idx,block_id,x0,x1,y0,y1-y0 h,CASE WHEN NOT 24<y1-y0 THEN 1
  WHEN y1-y0>50*0.25 AND x1-x0<400*0.5 AND x1-x0>400*0.25 THEN FLOOR((y1-y0)/12) WHEN x1-x0>400*0.4 THEN 3 WHEN x1-x0>400*0.25 THEN FLOOR((y1-y0)/12)
  WHEN (y1-y0)*10>12*(x1-x0) THEN 1 ELSE 2 END n FROM k)"""


@query("W11_virtual_lines", ["dets"], """
SELECT doc_id,page_idx,block_id,CAST(line AS BIGINT) line,x0,x1,ROUND(y0+line*(h/CAST(n AS DOUBLE)),6) y0,ROUND(y0+(line+1)*(h/CAST(n AS DOUBLE)),6) y1 FROM (
 SELECT *,UNNEST(generate_series(0,CAST(n AS BIGINT)-1)) line FROM vl) z""", BLOCKS + "," + VIRTUAL)
def w11(t):
    blocks = typed(t).withColumn("line_height", F.lit(12.0))
    out = O.virtual_lines(blocks, F.lit(400), F.lit(50))
    return out.select(*PG, "block_id", "line", "x0", "x1", F.round("y0", 6).alias("y0"), F.round("y1", 6).alias("y1"))


@query("W11_blocks_needing_virtual_lines", ["text_blocks"], """
SELECT doc_id,page_idx,block_ord,type IN ('image_body') OR n_lines-1=0 OR (type='title' AND n_lines-1=1 AND y1-y0>24) needed FROM text_blocks""")
def w11_needed(t):
    h = F.col("y1") - F.col("y0")
    return t.text_blocks.select(*PG, "block_ord", O.needs_virtual_lines(F.col("type"), F.col("n_lines") - 1, h, F.lit(12)).alias("needed"))


@query("AG11_block_index", ["lines"], """
SELECT doc_id,page_idx,para_no,col_no,QUANTILE_CONT(rank,0.5) AS index FROM (
 SELECT *,ROW_NUMBER() OVER (PARTITION BY doc_id,page_idx ORDER BY x0,line_no) AS rank FROM lines) z GROUP BY 1,2,3,4""")
def ag11(t):
    from pyspark.sql import Window
    ranked = t.lines.withColumn("rank", F.row_number().over(Window.partitionBy(*PG).orderBy("x0", "line_no")))
    return O.block_index(ranked, [*PG, "para_no", "col_no"])


# One level of the recursion cuts all open parts of all pages: bands by gaps in y, and columns by gaps in x inside a band.
XY_CUT = """thin AS (SELECT doc_id,page_idx,block_id id,x0,y0,x0+(x1-x0)//6+1 x1,y0+(y1-y0)//6+1 y1 FROM k),
cut AS (SELECT doc_id,page_idx,id,x0,y0,x1,y1,CAST([] AS BIGINT[]) path,false done FROM thin
 UNION ALL SELECT doc_id,page_idx,id,x0,y0,x1,y1,CASE WHEN n=0 THEN list_append(path,band) ELSE list_append(list_append(path,band),col) END,n=0 FROM (
  SELECT *,MAX(col) OVER (PARTITION BY doc_id,page_idx,path,band) n FROM (
   SELECT *,CAST(SUM(CASE WHEN x0>reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id,page_idx,path,band ORDER BY x0,id) AS BIGINT) col FROM (
    SELECT *,MAX(x1) OVER (PARTITION BY doc_id,page_idx,path,band ORDER BY x0,id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) reach FROM (
     SELECT *,CAST(SUM(CASE WHEN y0>deep THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id,page_idx,path ORDER BY y0,id) AS BIGINT) band FROM (
      SELECT *,MAX(y1) OVER (PARTITION BY doc_id,page_idx,path ORDER BY y0,id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) deep
      FROM cut WHERE NOT done) a) b) c) d) e)"""


@query("W10_xy_cut_order", ["dets"], """
SELECT doc_id,page_idx,id block_id,ROW_NUMBER() OVER (PARTITION BY doc_id,page_idx ORDER BY path,x0,y0,id)-1 AS rank FROM cut WHERE done""", BLOCKS + "," + XY_CUT)
def w10(t):
    thin = typed(t).withColumns({"x1": F.col("x0") + F.floor((F.col("x1") - F.col("x0")) / 6) + 1, "y1": F.col("y0") + F.floor((F.col("y1") - F.col("y0")) / 6) + 1})
    return O.xy_cut(thin).select(*PG, "block_id", "rank")


# Sorting with a tolerance as a recursive walk: a step inserts the next box behind the last one of the list so far that it does not pass.
def _inserted(group: str, passes: str) -> str:
    return f"""pg AS (SELECT {group},COUNT(*) n,LIST(id ORDER BY y0,x0,id) ids,LIST(x0 ORDER BY y0,x0,id) x0,LIST(y0 ORDER BY y0,x0,id) y0,LIST(y1 ORDER BY y0,x0,id) y1
  FROM src GROUP BY {group}),
w AS (SELECT {group},CAST(1 AS BIGINT) i,CAST([1] AS BIGINT[]) ord FROM pg
 UNION ALL SELECT {group},i+1,list_concat(list_append(ord[1:stop],i+1),ord[stop+1:]) FROM (
  SELECT w.*,COALESCE(list_max(list_filter(generate_series(1,len(ord)),lambda k: NOT ({passes}))),0) stop
  FROM w JOIN pg USING ({group}) WHERE w.i<pg.n) z),
fin AS (SELECT {group},ARG_MAX(ord,i) ord FROM w GROUP BY {group}),
ranked AS (SELECT {group},ids[ord[k]] id,k-1 AS rank FROM (SELECT *,UNNEST(generate_series(1,len(ord))) k FROM fin JOIN pg USING ({group})) z)"""


@query("W12_sort_rows_with_tolerance", ["dets"], "SELECT doc_id,page_idx,id det_id,rank FROM ranked",
       "src AS (SELECT doc_id,page_idx,det_id id,x0,y0,y1 FROM dets)," + _inserted("doc_id,page_idx", "x0[i+1]<x0[ord[k]] AND ABS(y0[i+1]-y0[ord[k]])<10"))
def w12(t):
    return O.sort_rows_with_tolerance(t.dets).select(*PG, "det_id", "rank")


INSIDE = "(y1[{0}]-y0[{0}]-(LEAST(y1[i+1],y1[ord[k]])-GREATEST(y0[i+1],y0[ord[k]])))*10<2*(y1[{0}]-y0[{0}])"


@query("W12_sort_table_boxes", ["cells_ocr"], "SELECT table_id,id cell_no,rank FROM ranked",
       "src AS (SELECT table_id,cell_no id,ox0 x0,oy0 y0,oy1 y1 FROM cells_ocr)," + _inserted(
           "table_id", f"x0[i+1]<x0[ord[k]] AND ABS(y0[i+1]-y0[ord[k]])<20 AND ({INSIDE.format('i+1')} OR {INSIDE.format('ord[k]')})"))
def w12_table(t):
    boxes = t.cells_ocr.select("table_id", "cell_no", F.col("ox0").alias("x0"), F.col("oy0").alias("y0"), F.col("ox1").alias("x1"), F.col("oy1").alias("y1"))
    return O.sort_table_boxes(boxes, ["table_id"], "cell_no").select("table_id", "cell_no", "rank")


@query("SO2_children_by_index", ["blocks_idx"], """
SELECT doc_id,page_idx,STRING_AGG(type,'>' ORDER BY x0+y0,type,idx) types FROM blocks_idx GROUP BY 1,2""")
def so2(t):
    blocks = t.blocks_idx.withColumn("index", F.col("x0") + F.col("y0"))
    out = O.ordered_children(blocks, PG, "index", "type", "idx")
    return out.select(*PG, F.array_join(F.col("blocks")["type"], ">").alias("types"))


@query("SO5_from_top_left", ["dets"], "SELECT doc_id,page_idx,det_id,ROW_NUMBER() OVER (PARTITION BY doc_id,page_idx ORDER BY x0*x0+y0*y0,det_id) AS rank FROM dets")
def so5(t):
    return O.from_top_left(t.dets, "det_id").select(*PG, "det_id", "rank")


@query("SO6_pages_in_order", ["lines"], "SELECT doc_id,page_idx,COUNT(*) n FROM lines GROUP BY 1,2 ORDER BY 1,2")
def so6(t):
    return t.lines.groupBy(*PG).agg(F.count("*").alias("n")).orderBy("doc_id", "page_idx")
