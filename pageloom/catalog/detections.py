"""Detection filters, projections and pair rules over F1."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import geom as g
from ..operators import detections as D
from . import query

# F1 with real scores, with categories 2 and 8 read as table footnotes and image captions.
SCORED = "d AS (SELECT *,score_m/1000.0 score FROM dets)"
RELABEL = """d AS (SELECT doc_id,page_idx,det_id,CAST(CASE category_id WHEN 2 THEN 7 WHEN 8 THEN 4 ELSE category_id END AS BIGINT) category_id,
  x0,y0,x1,y1,score_m FROM dets)"""
COLS = "doc_id,page_idx,det_id,category_id,x0,y0,x1,y1,score_m"


def scored(t):
    return t.dets.withColumn("score", F.col("score_m") / F.lit(1000.0))


def relabelled(t):
    c = F.col("category_id")
    return scored(t).withColumn("category_id", F.when(c == 2, 7).when(c == 8, 4).otherwise(c).cast("bigint"))


def _bare(df):
    return df.select(*COLS.split(","))


def polys(t):
    """F1 as polygons at 2.5 pixels a point, every 50th row without extent."""
    x1 = F.when(F.col("det_id") % 50 == 0, F.col("x0")).otherwise(F.col("x1"))
    jitter = (F.col("det_id") % 5) / 2.0
    xs, ys, xe, ye = F.col("x0") * 2.5 + jitter, F.col("y0") * 2.5 + jitter, x1 * 2.5 + jitter, F.col("y1") * 2.5 + jitter
    return t.dets.withColumn("poly", F.array(xs, ys, xe, ys, xe, ye, xs, ye)).drop("x0", "y0", "x1", "y1")


POLYS = """p AS (SELECT doc_id,page_idx,det_id,category_id,score_m,x0*2.5+(det_id%5)/2.0 px0,y0*2.5+(det_id%5)/2.0 py0,
  CASE WHEN det_id%50=0 THEN x0 ELSE x1 END*2.5+(det_id%5)/2.0 px1,y1*2.5+(det_id%5)/2.0 py1 FROM dets)"""


@query("PF1_fix_axis", ["dets"], f"SELECT {COLS} FROM q WHERE x1>x0 AND y1>y0", POLYS + """,
q AS (SELECT doc_id,page_idx,det_id,category_id,score_m,CAST(TRUNC(CAST(px0 AS DOUBLE)/2.5) AS BIGINT) x0,CAST(TRUNC(CAST(py0 AS DOUBLE)/2.5) AS BIGINT) y0,
  CAST(TRUNC(CAST(px1 AS DOUBLE)/2.5) AS BIGINT) x1,CAST(TRUNC(CAST(py1 AS DOUBLE)/2.5) AS BIGINT) y1 FROM p)""")
def pf1(t):
    return D.poly_to_page_box(polys(t), 2.5).select(*COLS.split(","))


UNIT = """u AS (SELECT doc_id,page_idx,det_id,CASE WHEN det_id%3=0 THEN x1 ELSE x0 END/1000.0 x0,y0/1000.0 y0,
  CASE WHEN det_id%3=0 THEN x0 ELSE x1 END/1000.0 x1,y1/1000.0 y1 FROM dets)"""


@query("PF2_cal_real_bbox", ["dets"], """
SELECT doc_id,page_idx,det_id,LEAST(a,b) x0,LEAST(c,d) y0,GREATEST(a,b) x1,GREATEST(c,d) y1 FROM (SELECT doc_id,page_idx,det_id,
  CAST(TRUNC(CAST(x0 AS DOUBLE)*612) AS BIGINT) a,CAST(TRUNC(CAST(x1 AS DOUBLE)*612) AS BIGINT) b,
  CAST(TRUNC(CAST(y0 AS DOUBLE)*792) AS BIGINT) c,CAST(TRUNC(CAST(y1 AS DOUBLE)*792) AS BIGINT) d FROM u) z""", UNIT)
def pf2(t):
    flip = F.col("det_id") % 3 == 0
    u = t.dets.select("doc_id", "page_idx", "det_id",
                      (F.when(flip, F.col("x1")).otherwise(F.col("x0")) / 1000.0).alias("x0"), (F.col("y0") / 1000.0).alias("y0"),
                      (F.when(flip, F.col("x0")).otherwise(F.col("x1")) / 1000.0).alias("x1"), (F.col("y1") / 1000.0).alias("y1"))
    return D.unit_to_page_box(u, F.lit(612), F.lit(792))


@query("PF3_normalize_poly_to_bbox", ["dets"], """
SELECT doc_id,page_idx,det_id,CAST(format('{:.3f}',LEAST(GREATEST(CAST(px0 AS DOUBLE)/1600,0),1)) AS DOUBLE) x0,CAST(format('{:.3f}',LEAST(GREATEST(CAST(py0 AS DOUBLE)/1600,0),1)) AS DOUBLE) y0,
  CAST(format('{:.3f}',LEAST(GREATEST(CAST(px1 AS DOUBLE)/1600,0),1)) AS DOUBLE) x1,CAST(format('{:.3f}',LEAST(GREATEST(CAST(py1 AS DOUBLE)/1600,0),1)) AS DOUBLE) y1 FROM p""", POLYS)
def pf3(t):
    return D.poly_to_unit_box(polys(t), F.lit(1600), F.lit(1600)).select("doc_id", "page_idx", "det_id", "x0", "y0", "x1", "y1")


@query("PF4_content_list_bbox", ["dets"], """
SELECT doc_id,page_idx,det_id,CAST(FLOOR(x0*1000/612) AS BIGINT) x0,CAST(FLOOR(y0*1000/792) AS BIGINT) y0,
 CAST(FLOOR(x1*1000/612) AS BIGINT) x1,CAST(FLOOR(y1*1000/792) AS BIGINT) y1 FROM dets""")
def pf4(t):
    return D.per_mille_box(t.dets.drop("category_id", "score_m"), F.lit(612), F.lit(792))


@query("PF5_remove_low_confidence", ["dets"], f"SELECT {COLS} FROM dets WHERE score_m>50")
def pf5(t):
    return _bare(D.drop_low_confidence(scored(t)))


@query("PF6_ocr_quality", ["dets"], """
SELECT doc_id,page_idx,det_id,CAST(CASE WHEN score_m<500 OR (txt IN ('号','c') AND score_m<800 AND x1-x0<y1-y0) THEN 16 ELSE 15 END AS BIGINT) category_id
FROM o WHERE x1-x0>=3""", """o AS (SELECT doc_id,page_idx,det_id,x0,y0,CASE WHEN det_id%9=0 THEN x0+det_id%6 ELSE x1 END x1,y1,score_m,
  CASE det_id%4 WHEN 0 THEN '号' WHEN 1 THEN 'c' ELSE 'word' END txt FROM dets)""")
def pf6(t):
    k = F.col("det_id")
    o = scored(t).withColumns({
        "x1": F.when(k % 9 == 0, F.col("x0") + k % 6).otherwise(F.col("x1")), "category_id": F.lit(S.OCR_TEXT),
        "text": F.when(k % 4 == 0, "号").when(k % 4 == 1, "c").otherwise("word")})
    return D.grade_recognised_text(o).select("doc_id", "page_idx", "det_id", "category_id")


@query("PF7_late_ocr_accept", ["dets"], """
SELECT doc_id,page_idx,det_id,CASE WHEN score_m>500 THEN 'text' ELSE '' END content,
 CASE WHEN score_m>500 THEN score_m/1000.0 ELSE 0.0 END score FROM dets""")
def pf7(t):
    return D.accept_late_text(scored(t).withColumn("content", F.lit("text"))).select("doc_id", "page_idx", "det_id", "content", "score")


@query("PF9_block_and_span_types", ["dets"], """
SELECT category_id,block_type,span_type,COUNT(*) n FROM (SELECT category_id,
  CASE category_id WHEN 0 THEN 'title' WHEN 1 THEN 'text' WHEN 2 THEN 'discarded' WHEN 3 THEN 'image_body' WHEN 5 THEN 'table_body'
    WHEN 6 THEN 'table_caption' WHEN 8 THEN 'interline_equation' END block_type,
  CASE category_id WHEN 3 THEN 'image' WHEN 5 THEN 'table' END span_type FROM dets) z GROUP BY 1,2,3""")
def pf9(t):
    return D.with_types(t.dets).groupBy("category_id", "block_type", "span_type").agg(F.count("*").alias("n"))


@query("PF9_model_block_types", ["blocks_idx"], """
SELECT type,CASE type WHEN 'equation' THEN 'interline_equation' WHEN 'code' THEN 'code_body' WHEN 'image' THEN 'image_body' ELSE 'text' END block_type,
  CASE type WHEN 'equation' THEN 'interline_equation' WHEN 'image' THEN 'image' ELSE 'text' END span_type,COUNT(*) n
FROM (SELECT CASE type WHEN 'table_body' THEN 'equation' WHEN 'image_body' THEN 'image' WHEN 'table_caption' THEN 'code' WHEN 'image_caption' THEN 'other' ELSE 'text' END AS type FROM blocks_idx) z
WHERE type<>'other' GROUP BY 1,2,3""")
def pf9_model(t):
    k = F.col("type")
    model = t.blocks_idx.withColumn("type", F.when(k == "table_body", "equation").when(k == "image_body", "image")
                                    .when(k == "table_caption", "code").when(k == "image_caption", "other").otherwise("text"))
    return D.with_model_types(model).groupBy("type", "block_type", "span_type").agg(F.count("*").alias("n"))


@query("PF13_crop_frame", ["dets"], """
SELECT doc_id,page_idx,det_id,x0-100+50 x0,y0-120+50 y0,x1-100+50 x1,y1-120+50 y1 FROM dets
WHERE x1-50>=0 AND y1-70>=0 AND x0-50<=400 AND y0-70<=400""")
def pf13(t):
    crop = g.Box(F.lit(100), F.lit(120), F.lit(400), F.lit(420))
    return D.into_crop(t.dets.drop("category_id", "score_m"), crop, 50, F.lit(400), F.lit(400))


@query("PF13_crop_frame_and_back", ["dets"], """
SELECT doc_id,page_idx,det_id,x0,y0,x1,y1 FROM dets WHERE x1-50>=0 AND y1-70>=0 AND x0-50<=400 AND y0-70<=400""")
def pf13_back(t):
    crop = g.Box(F.lit(100), F.lit(120), F.lit(400), F.lit(420))
    return D.out_of_crop(D.into_crop(t.dets.drop("category_id", "score_m"), crop, 50, F.lit(400), F.lit(400)), crop, 50)


def tilted(t):
    """Four corners, the right side shifted down by up to 12."""
    shift = F.col("det_id") % 13
    def pt(x, y):
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    return t.dets.withColumn("points", F.array(pt(x0, y0), pt(x1, y0 + shift), pt(x1, y1 + shift), pt(x0, y1)))


@query("PF14_skew_and_square_up", ["dets"], """
SELECT doc_id,page_idx,det_id,skewed,(x0+x1)/2.0-(x1-x0)/2.0 left_x,(2*y0+2*y1+2*s)/4.0-(y1-y0)/2.0 top_y,
 (x0+x1)/2.0+(x1-x0)/2.0 right_x,(2*y0+2*y1+2*s)/4.0+(y1-y0)/2.0 bottom_y
FROM (SELECT *,NOT ((y1+s-y0)*10>=8*(y1-y0) AND (y1+s-y0)*10<=12*(y1-y0)) skewed FROM (SELECT *,det_id%13 s FROM dets) y) z""")
def pf14(t):
    df = tilted(t)
    b = D.points_to_box(D.squared_up(F.col("points")))
    return df.select("doc_id", "page_idx", "det_id", D.is_skewed(F.col("points")).alias("skewed"), b.x0.alias("left_x"),
                     b.y0.alias("top_y"), b.x1.alias("right_x"), b.y1.alias("bottom_y"))


@query("PF15_points_and_boxes", ["dets"],
       "SELECT doc_id,page_idx,det_id,CAST(x0 AS DOUBLE) x0,CAST(y0 AS DOUBLE) y0,CAST(x1 AS DOUBLE) x1,CAST(y1+det_id%13 AS DOUBLE) y1 FROM dets")
def pf15(t):
    b = D.points_to_box(F.col("points"))
    return tilted(t).select("doc_id", "page_idx", "det_id", b.x0.alias("x0"), b.y0.alias("y0"), b.x1.alias("x1"), b.y1.alias("y1"))


@query("PF19_shape_buckets", ["dets"], """
SELECT CAST(FLOOR((y1-y0+63)/64)*64 AS BIGINT) bucket_h,CAST(FLOOR((x1-x0+63)/64)*64 AS BIGINT) bucket_w,
 CAST(FLOOR((y1-y0)/128)*128+128 AS BIGINT) turn_h,CAST(FLOOR((x1-x0)/128)*128+128 AS BIGINT) turn_w,COUNT(*) n FROM dets GROUP BY 1,2,3,4""")
def pf19(t):
    b = g.box()
    h, w = g.height(b), g.width(b)
    return t.dets.groupBy(D.size_bucket(h).alias("bucket_h"), D.size_bucket(w).alias("bucket_w"),
                          D.orientation_bucket(h).alias("turn_h"), D.orientation_bucket(w).alias("turn_w")).agg(F.count("*").alias("n"))


@query("PF20_line_grid", ["dets"], """
SELECT *,0<=x0 AND x0<=x1 AND x1<=1000 AND 0<=y0 AND y0<=y1 AND y1<=1000 AS "valid" FROM (SELECT doc_id,page_idx,det_id,
 CAST(ROUND_EVEN(GREATEST(x0-30,0)*(CAST(1000.0 AS DOUBLE)/612),0) AS BIGINT) x0,CAST(ROUND_EVEN(GREATEST(y0-30,0)*(CAST(1000.0 AS DOUBLE)/700),0) AS BIGINT) y0,
 CAST(ROUND_EVEN(LEAST(x1-30,612)*(CAST(1000.0 AS DOUBLE)/612),0) AS BIGINT) x1,CAST(ROUND_EVEN(LEAST(y1-30,700)*(CAST(1000.0 AS DOUBLE)/700),0) AS BIGINT) y1 FROM dets) z""")
def pf20(t):
    moved = t.dets.drop("category_id", "score_m").withColumns({c: F.col(c) - 30 for c in ("x0", "y0", "x1", "y1")})
    return D.layout_grid_box(moved, F.lit(612), F.lit(700))


@query("PF24_equation_sources", ["dets"], """
SELECT formulas_on,COUNT(*) n_blocks,COUNT(CASE WHEN NOT formulas_on THEN 1 END) n_spans FROM (
 SELECT true formulas_on FROM dets WHERE category_id=6 UNION ALL SELECT false FROM dets WHERE category_id=8) z GROUP BY 1""")
def pf24(t):
    dets = scored(t).withColumn("category_id", F.when(F.col("category_id") == 6, 14).otherwise(F.col("category_id")))
    out = None
    for flag in (True, False):
        blocks, spans = D.equation_sources(dets, flag)
        both = blocks.select(F.lit(1).alias("b"), F.lit(0).alias("s")).unionByName(spans.select(F.lit(0).alias("b"), F.lit(1).alias("s")))
        row = both.agg(F.sum("b").alias("n_blocks"), F.sum("s").alias("n_spans")).withColumn("formulas_on", F.lit(flag))
        out = row if out is None else out.unionByName(row)
    return out


@query("PF25_split_regions", ["dets"], """
SELECT CASE category_id WHEN 5 THEN 'table' WHEN 1 THEN 'text' WHEN 8 THEN NULL ELSE 'ocr' END region,COUNT(*) n FROM dets GROUP BY 1""")
def pf25_split(t):
    return D.split_regions(t.dets).groupBy("region").agg(F.count("*").alias("n"))


@query("PF26_clip_points", ["dets"], """
SELECT doc_id,page_idx,det_id,CAST(LEAST(x0,449) AS DOUBLE) x0,CAST(LEAST(y0,619) AS DOUBLE) y0,CAST(LEAST(x1,449) AS DOUBLE) x1,CAST(LEAST(y1+s,619) AS DOUBLE) y1 FROM (SELECT *,det_id%13 s FROM dets) z
WHERE FLOOR(SQRT((LEAST(x1,449)-LEAST(x0,449))*(LEAST(x1,449)-LEAST(x0,449))+(LEAST(y0+s,619)-LEAST(y0,619))*(LEAST(y0+s,619)-LEAST(y0,619))))>3
 AND LEAST(y1,619)-LEAST(y0,619)>3""")
def pf26(t):
    shuffled = tilted(t).withColumn("points", F.array(*(F.col("points")[i] for i in (2, 0, 3, 1))))
    kept = D.clip_and_filter_points(shuffled, F.lit(450), F.lit(620))
    p = F.col("points")
    return kept.select("doc_id", "page_idx", "det_id", p[0]["x"].alias("x0"), p[0]["y"].alias("y0"), p[2]["x"].alias("x1"), p[2]["y"].alias("y1"))


@query("PF27_structure_boxes", ["dets"], """
SELECT doc_id,page_idx,det_id,ROUND(GREATEST(x0-1,0)*(488/(600*(488/800.0))),6) x0,ROUND(GREATEST(y0-1,0)*(488/(800*(488/800.0))),6) y0,
 ROUND(LEAST(x1+1,600)*(488/(600*(488/800.0))),6) x1,ROUND(LEAST(y1+det_id%13+1,800)*(488/(800*(488/800.0))),6) y1 FROM dets""")
def pf27(t):
    b = D.padded_bounds(F.col("points"), F.lit(600), F.lit(800))
    df = tilted(t).select("doc_id", "page_idx", "det_id", b.x0.alias("x0"), b.y0.alias("y0"), b.x1.alias("x1"), b.y1.alias("y1"))
    out = D.rescale_structure_boxes(df, F.lit(600.0), F.lit(800.0))
    return out.select("doc_id", "page_idx", "det_id", *(F.round(c, 6).alias(c) for c in ("x0", "y0", "x1", "y1")))


IOU = """ap AS (SELECT a.doc_id,a.page_idx,a.det_id i,b.det_id j,a.score_m si,b.score_m sj,
  (LEAST(a.x1,b.x1)-GREATEST(a.x0,b.x0))*(LEAST(a.y1,b.y1)-GREATEST(a.y0,b.y0)) inter,
  (a.x1-a.x0)*(a.y1-a.y0) ai,(b.x1-b.x0)*(b.y1-b.y0) aj,a.category_id ci,b.category_id cj
  FROM d a JOIN d b ON a.doc_id=b.doc_id AND a.page_idx=b.page_idx AND a.det_id<b.det_id
   AND a.x0<=b.x1 AND b.x0<=a.x1 AND a.y0<=b.y1 AND b.y0<=a.y1)"""


@query("J1_remove_high_iou_low_score", ["dets"], f"""
SELECT {COLS} FROM dets e ANTI JOIN (SELECT DISTINCT doc_id,page_idx,CASE WHEN si<sj THEN i ELSE j END det_id FROM ap
  WHERE ci IN (0,1,3,4,5,6,7,8,9) AND cj IN (0,1,3,4,5,6,7,8,9) AND inter*10>9*(ai+aj-inter)) l USING (doc_id,page_idx,det_id)""", "d AS (SELECT * FROM dets)," + IOU)
def j1(t):
    return _bare(D.drop_high_iou(scored(t)))


# Growth in list order as a recursive walk: a page (or kind on a page) is a row of lists, and a step goes to the next pair of the list
# that overlaps by enough (a pair is i * 10000 + j); when a box has grown its pairs are found anew.
# src: (doc_id, page_idx, kind, id, x0, y0, x1, y1, s).
def _grown(threshold: str, by_score: bool = False) -> str:
    area = lambda k: f"(x1[{k}]-x0[{k}])*(y1[{k}]-y0[{k}])"
    smaller = lambda i, j: f"CASE WHEN {area(i)}<={area(j)} THEN {i} ELSE {j} END"
    put = ",".join(f"CASE WHEN grows THEN list_transform({c},lambda v,k: CASE WHEN k=big THEN {fn}({c}[big],{c}[small]) ELSE v END) ELSE {c} END {c}"
                   for c, fn in (("x0", "LEAST"), ("y0", "LEAST"), ("x1", "GREATEST"), ("y1", "GREATEST")))
    if by_score:  # boxes that are gone take no part, but for the outer one of the pairs under way
        open_ = "NOT list_contains(gone,c%10000) AND (c//10000=cur//10000 OR NOT list_contains(gone,c//10000))"
        loses, grows = "CASE WHEN s[small]>s[big] THEN big ELSE small END", "s[small]<=s[big] AND NOT list_contains(gone,small)"
    else:
        open_ = f"NOT list_contains(gone,{smaller('c//10000', 'c%10000')})"
        loses, grows = "small", "true"
    return f"""
pg AS (SELECT doc_id,page_idx,kind,COUNT(*) n,LIST(id ORDER BY id) ids,LIST(x0 ORDER BY id) x0,LIST(y0 ORDER BY id) y0,LIST(x1 ORDER BY id) x1,
  LIST(y1 ORDER BY id) y1,LIST(s ORDER BY id) s FROM src GROUP BY 1,2,3),
num AS (SELECT *,ROW_NUMBER() OVER (PARTITION BY doc_id,page_idx,kind ORDER BY id) k FROM src),
pr AS (SELECT a.doc_id,a.page_idx,a.kind,LIST(a.k*10000+b.k) pairs FROM num a JOIN num b ON a.doc_id=b.doc_id AND a.page_idx=b.page_idx AND a.kind=b.kind
  AND a.k<b.k AND a.x0<b.x1 AND b.x0<a.x1 AND a.y0<b.y1 AND b.y0<a.y1 AND (LEAST(a.x1,b.x1)-GREATEST(a.x0,b.x0))*(LEAST(a.y1,b.y1)-GREATEST(a.y0,b.y0))*10
    >{threshold}*LEAST((a.x1-a.x0)*(a.y1-a.y0),(b.x1-b.x0)*(b.y1-b.y0)) GROUP BY 1,2,3),
w AS (SELECT doc_id,page_idx,kind,CAST(0 AS BIGINT) cur,n,ids,x0,y0,x1,y1,s,pairs,CAST([] AS BIGINT[]) gone FROM pg JOIN pr USING (doc_id,page_idx,kind)
 UNION ALL SELECT doc_id,page_idx,kind,p,n,ids,x0,y0,x1,y1,s,CASE WHEN grows THEN list_concat(
    list_filter(pairs,lambda c: c//10000<>big AND c%10000<>big),
    list_transform(list_filter(generate_series(1,n),lambda m: m<>big AND x0[m]<x1[big] AND x0[big]<x1[m] AND y0[m]<y1[big] AND y0[big]<y1[m]
      AND (LEAST(x1[m],x1[big])-GREATEST(x0[m],x0[big]))*(LEAST(y1[m],y1[big])-GREATEST(y0[m],y0[big]))*10>{threshold}*LEAST({area("m")},{area("big")})),
     lambda m: LEAST(m,big)*10000+GREATEST(m,big))) ELSE pairs END,
   CASE WHEN list_contains(gone,loses) THEN gone ELSE list_append(gone,loses) END FROM (
  SELECT doc_id,page_idx,kind,p,n,ids,{put},s,pairs,gone,grows,big,loses FROM (
   SELECT *,{loses} loses,{grows} grows FROM (SELECT *,p//10000+p%10000-small big FROM (SELECT *,{smaller("p//10000", "p%10000")} small FROM (
    SELECT *,list_min(list_filter(pairs,lambda c: c>cur AND {open_})) p FROM w) z1 WHERE p IS NOT NULL) z2) z3) z4) z5),
fin AS (SELECT doc_id,page_idx,kind,ARG_MAX(w,cur) w FROM w GROUP BY 1,2,3),
grown AS (SELECT doc_id,page_idx,kind,w.ids[k] id,w.x0[k] x0,w.y0[k] y0,w.x1[k] x1,w.y1[k] y1 FROM (
  SELECT doc_id,page_idx,kind,w,UNNEST(generate_series(1,len(w.ids))) k FROM fin) z WHERE NOT list_contains(w.gone,k)
 UNION ALL SELECT doc_id,page_idx,kind,id,x0,y0,x1,y1 FROM src a WHERE NOT EXISTS (
  SELECT 1 FROM pr b WHERE b.doc_id=a.doc_id AND b.page_idx=a.page_idx AND b.kind=a.kind))"""


def tagged(ctes: str, tag: str) -> str:
    """The CTEs of a walk under names of their own, for a query that takes several."""
    return re.sub(r"\b(src|pg|pr|w|fin|grown|merged|num|ins|held)\b", rf"\1_{tag}", ctes)


SRC = "src AS (SELECT doc_id,page_idx,{kind} kind,det_id id,x0,y0,x1,y1,score_m s FROM dets{where})"
GROWN = """SELECT g.doc_id,g.page_idx,g.id det_id,d.category_id,g.x0,g.y0,g.x1,g.y1,d.score_m FROM grown g
JOIN dets d ON d.doc_id=g.doc_id AND d.page_idx=g.page_idx AND d.det_id=g.id"""


@query("J2_absorb_overlapping_bodies", ["dets"], GROWN + f" UNION ALL SELECT {COLS} FROM dets WHERE category_id NOT IN (3,5)",
       SRC.format(kind="category_id", where=" WHERE category_id IN (3,5)") + "," + _grown("8"))
def j2(t):
    return _bare(D.absorb_overlapping_bodies(scored(t)))


# The sides of joins are materialised where they are filtered, so that no planner turns the join into a product under a filter.
NEAR = """
f7 AS MATERIALIZED (SELECT * FROM d WHERE category_id=7),
b35 AS MATERIALIZED (SELECT * FROM d WHERE category_id IN (3,5)),
n AS (SELECT f.doc_id,f.page_idx,f.det_id,b.category_id c,
  (b.x1<f.x0 OR f.x1<b.x0) beside,(b.y1<f.y0 OR f.y1<b.y0) above,
  b.x1-b.x0 bw,b.y1-b.y0 bh,f.x1-f.x0 fw,f.y1-f.y0 fh,
  GREATEST(f.x0-b.x1,b.x0-f.x1,0) gx,GREATEST(f.y0-b.y1,b.y0-f.y1,0) gy
  FROM f7 f JOIN b35 b ON f.doc_id=b.doc_id AND f.page_idx=b.page_idx),
m AS (SELECT doc_id,page_idx,det_id,
  MIN(CASE WHEN c=3 THEN dist END) fig,COALESCE(MIN(CASE WHEN c=5 THEN dist END),1e18) tab FROM (
   SELECT *,CASE WHEN (CASE WHEN beside THEN (fh-bh)*10>3*bh ELSE (fw-bw)*10>3*bw END) THEN 1e18 ELSE CAST(gx+gy AS DOUBLE) END dist
   FROM n WHERE NOT (beside AND above)) z GROUP BY 1,2,3)"""


@query("J3_retype_footnotes", ["dets"], """
SELECT d.doc_id,d.page_idx,d.det_id,CAST(CASE WHEN tab>fig THEN 101 ELSE category_id END AS BIGINT) category_id FROM d
LEFT JOIN m ON m.doc_id=d.doc_id AND m.page_idx=d.page_idx AND m.det_id=d.det_id""", RELABEL + "," + NEAR)
def j3(t):
    return D.retype_footnotes(relabelled(t)).select("doc_id", "page_idx", "det_id", "category_id")


@query("J4_drop_contained", ["dets"], f"""
SELECT {COLS} FROM dets z ANTI JOIN (SELECT DISTINCT e.doc_id,e.page_idx,e.det_id FROM dets e JOIN dets o ON o.doc_id=e.doc_id AND o.page_idx=e.page_idx
 AND o.category_id=e.category_id AND o.det_id<>e.det_id AND e.x0>=o.x0 AND e.y0>=o.y0 AND e.x1<=o.x1 AND e.y1<=o.y1) l USING (doc_id,page_idx,det_id)""")
def j4(t):
    return _bare(D.drop_contained(t.dets, ["category_id"]))


# Matching by distance as a recursive walk: a step starts from the free box nearest the corner of all free boxes.
def _gap2(i: str, j: str) -> str:
    x, y = f"GREATEST(x0[{i}]-x1[{j}],x0[{j}]-x1[{i}],0)", f"GREATEST(y0[{i}]-y1[{j}],y0[{j}]-y1[{i}],0)"
    return f"({x}*{x}+{y}*{y})"


MATCH = f"""src AS (SELECT doc_id,page_idx,det_id id,CASE category_id WHEN 3 THEN 0 ELSE 1 END kind,x0,y0,x1,y1 FROM d z WHERE category_id IN (3,4) AND NOT EXISTS (
  SELECT 1 FROM d o WHERE o.doc_id=z.doc_id AND o.page_idx=z.page_idx AND o.category_id=z.category_id AND o.det_id<>z.det_id
  AND z.x0>=o.x0 AND z.y0>=o.y0 AND z.x1<=o.x1 AND z.y1<=o.y1)),
pg AS (SELECT doc_id,page_idx,COUNT(*) n,COUNT(*) FILTER (kind=0) bodies,LIST(id ORDER BY kind,x0*x0+y0*y0,id) ids,LIST(x0 ORDER BY kind,x0*x0+y0*y0,id) x0,
  LIST(y0 ORDER BY kind,x0*x0+y0*y0,id) y0,LIST(x1 ORDER BY kind,x0*x0+y0*y0,id) x1,LIST(y1 ORDER BY kind,x0*x0+y0*y0,id) y1 FROM src GROUP BY 1,2),
w AS (SELECT doc_id,page_idx,0 step,CAST([] AS BIGINT[]) used,CAST([] AS BIGINT[]) mb,CAST([] AS BIGINT[]) mp FROM pg
 UNION ALL SELECT doc_id,page_idx,step+1,CASE WHEN far THEN list_append(used,body) ELSE list_append(list_append(used,body),part) END,
   CASE WHEN far THEN mb ELSE list_append(mb,body) END,CASE WHEN far THEN mp ELSE list_append(mp,part) END FROM (
  SELECT *,{_gap2("body", "part")}>=9*list_min(list_transform(generate_series(1,bodies),lambda b: {_gap2("b", "part")})) far FROM (
   SELECT *,LEAST(first,other) body,GREATEST(first,other) part FROM (
    SELECT *,list_min(list_transform(list_filter(free,lambda f: (f<=bodies)<>(first<=bodies)),
      lambda f: {{'g':{_gap2("f", "first")},'c':(x0[f]-left_)*(x0[f]-left_)+(y0[f]-top_)*(y0[f]-top_),'k':f}})).k other FROM (
     SELECT *,list_min(list_transform(free,lambda f: {{'c':(x0[f]-left_)*(x0[f]-left_)+(y0[f]-top_)*(y0[f]-top_),'k':f}})).k first FROM (
      SELECT *,list_min(list_transform(free,lambda f: x0[f])) left_,list_min(list_transform(free,lambda f: y0[f])) top_ FROM (
       SELECT w.*,pg.bodies,pg.x0,pg.y0,pg.x1,pg.y1,list_filter(generate_series(1,pg.n),lambda f: NOT list_contains(w.used,f)) free
       FROM w JOIN pg USING (doc_id,page_idx) WHERE len(mb)<pg.bodies) a) b) c) e WHERE other IS NOT NULL) f) g),
fin AS (SELECT doc_id,page_idx,ARG_MAX(w,step) w FROM w GROUP BY 1,2),
paired AS (SELECT doc_id,page_idx,UNNEST(w.mb) body,UNNEST(w.mp) part FROM fin
 UNION ALL SELECT doc_id,page_idx,list_min(list_transform(generate_series(1,bodies),lambda b: {{'g':{_gap2("b", "part")},'k':b}})).k,part FROM (
  SELECT *,UNNEST(generate_series(bodies+1,n)) part FROM fin JOIN pg USING (doc_id,page_idx) WHERE bodies>0) z WHERE NOT list_contains(w.used,part))"""


@query("J5_captions_by_distance", ["dets"], """
SELECT doc_id,page_idx,ids[body] body_id,ids[part] part_id FROM paired JOIN pg USING (doc_id,page_idx)
UNION ALL SELECT doc_id,page_idx,ids[b],NULL FROM (SELECT *,UNNEST(generate_series(1,bodies)) b FROM pg) z
 WHERE NOT EXISTS (SELECT 1 FROM paired p WHERE p.doc_id=z.doc_id AND p.page_idx=z.page_idx AND p.body=z.b)""", RELABEL + "," + MATCH)
def j5(t):
    return D.match_captions(relabelled(t), S.IMAGE_BODY, S.IMAGE_CAPTION)


@query("J12_absorb_by_score", ["dets"], GROWN, SRC.format(kind="0", where="") + "," + _grown("8", by_score=True))
def j12(t):
    return _bare(D.absorb_by_score(scored(t)))


# Merging as a recursive walk: the list of a page without the first pair that is alike, and their hull at its end.
def _merged(threshold: str) -> str:
    cut = lambda c, new: f"list_append(list_filter({c},lambda v,k: k<>i AND k<>j),{new}) {c}"
    area = lambda k: f"(x1[{k}]-x0[{k}])*(y1[{k}]-y0[{k}])"
    both = "(LEAST(x1[p//10000],x1[p%10000])-GREATEST(x0[p//10000],x0[p%10000]))*(LEAST(y1[p//10000],y1[p%10000])-GREATEST(y0[p//10000],y0[p%10000]))"
    return f"""
pg AS (SELECT doc_id,page_idx,LIST(id ORDER BY id) ids,LIST(x0 ORDER BY id) x0,LIST(y0 ORDER BY id) y0,LIST(x1 ORDER BY id) x1,LIST(y1 ORDER BY id) y1
  FROM src GROUP BY 1,2),
w AS (SELECT *,0 made FROM pg
 UNION ALL SELECT doc_id,page_idx,{cut("ids", "ids[i]")},{cut("x0", "LEAST(x0[i],x0[j])")},{cut("y0", "LEAST(y0[i],y0[j])")},
   {cut("x1", "GREATEST(x1[i],x1[j])")},{cut("y1", "GREATEST(y1[i],y1[j])")},made+1 FROM (SELECT *,p//10000 i,p%10000 j FROM (
  SELECT *,list_min(list_filter(flatten(list_transform(generate_series(1,len(ids)-1),lambda i: list_transform(generate_series(i+1,len(ids)),lambda j: i*10000+j))),
    lambda p: x0[p//10000]<x1[p%10000] AND x0[p%10000]<x1[p//10000] AND y0[p//10000]<y1[p%10000] AND y0[p%10000]<y1[p//10000]
     AND {both}*10>{threshold}*({area("p//10000")}+{area("p%10000")}-{both}))) p FROM w) z1 WHERE p IS NOT NULL) z2),
fin AS (SELECT doc_id,page_idx,ARG_MAX(w,made) w FROM w GROUP BY 1,2),
merged AS (SELECT doc_id,page_idx,w.ids[k] id,w.x0[k] x0,w.y0[k] y0,w.x1[k] x1,w.y1[k] y1,k-1 ord FROM (
  SELECT doc_id,page_idx,w,UNNEST(generate_series(1,len(w.ids))) k FROM fin) z)"""


@query("J25_merge_alike_tables", ["dets"], """
SELECT g.doc_id,g.page_idx,g.id det_id,d.category_id,g.x0,g.y0,g.x1,g.y1,d.score_m,g.ord FROM merged g
JOIN dets d ON d.doc_id=g.doc_id AND d.page_idx=g.page_idx AND d.det_id=g.id""", SRC.format(kind="0", where=" WHERE category_id=5") + "," + _merged("7"))
def j25(t):
    return D.merge_alike_tables(scored(t).where("category_id = 5")).select(*COLS.split(","), "ord")


TABLES_SQL = """
big AS (SELECT doc_id,page_idx,CAST(FLOOR(det_id/8) AS BIGINT)*1000 det_id,MIN(x0) x0,MIN(y0) y0,MAX(x1) x1,MAX(y1) y1 FROM small
  GROUP BY doc_id,page_idx,FLOOR(det_id/8)),
tb AS (SELECT doc_id,page_idx,det_id,x0,y0,x1,y1 FROM small UNION ALL SELECT * FROM big),
held AS (SELECT * FROM (SELECT a.doc_id,a.page_idx,a.det_id big,(a.x1-a.x0)*(a.y1-a.y0) oa,b.det_id,b.x0,b.y0,b.x1,b.y1,(b.x1-b.x0)*(b.y1-b.y0) ia,
  a.det_id-b.det_id apart,LEAST(a.x1,b.x1)-GREATEST(a.x0,b.x0) iw,LEAST(a.y1,b.y1)-GREATEST(a.y0,b.y0) ih
  FROM tb a JOIN tb b ON a.doc_id=b.doc_id AND a.page_idx=b.page_idx) pp WHERE apart<>0 AND iw>0 AND ih>0 AND iw*ih*10>=8*ia),
crossing AS (SELECT DISTINCT doc_id,page_idx,big FROM (SELECT p.doc_id,p.page_idx,p.big,q.det_id-p.det_id step,
   LEAST(p.x1,q.x1)-GREATEST(p.x0,q.x0) iw,LEAST(p.y1,q.y1)-GREATEST(p.y0,q.y0) ih
   FROM held p JOIN held q ON p.doc_id=q.doc_id AND p.page_idx=q.page_idx AND p.big=q.big) qq WHERE step>0 AND iw>0 AND ih>0),
gone AS (SELECT doc_id,page_idx,big FROM held GROUP BY doc_id,page_idx,big,oa HAVING COUNT(*)>=3 AND SUM(ia)*10>8*oa)"""


@query("J26_filter_nested_tables", ["dets"], """
SELECT doc_id,page_idx,det_id FROM tb WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id=tb.doc_id AND g.page_idx=tb.page_idx AND g.big=tb.det_id
 AND NOT EXISTS (SELECT 1 FROM crossing c WHERE c.doc_id=g.doc_id AND c.page_idx=g.page_idx AND c.big=g.big))""",
       "small AS (SELECT doc_id,page_idx,det_id,(det_id%4)*100 x0,det_id*10 y0,(det_id%4)*100+100-det_id%3 x1,det_id*10+50-det_id%2 y1 FROM dets),"
       + TABLES_SQL)
def j26(t):
    k = F.col("det_id")
    small = t.dets.select("doc_id", "page_idx", "det_id", ((k % 4) * 100).alias("x0"), (k * 10).alias("y0"),
                          ((k % 4) * 100 + 100 - k % 3).alias("x1"), (k * 10 + 50 - k % 2).alias("y1"))
    big = small.groupBy("doc_id", "page_idx", (F.floor(k / 8) * 1000).alias("det_id")).agg(
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    return D.drop_tables_of_tables(small.unionByName(big)).select("doc_id", "page_idx", "det_id")


# A big box against those inside as a recursive walk: a step goes to the next live box of the list with two or more live ones inside.
def _outvoted(order: str = "id") -> str:
    hull = ",".join(f"CASE WHEN wins THEN list_transform({c},lambda v,k: CASE WHEN k=i THEN {fn}(v,{low}(list_transform(own,lambda o: {c}[o]))) ELSE v END) ELSE {c} END {c}"
                    for c, fn, low in (("x0", "LEAST", "list_min"), ("y0", "LEAST", "list_min"), ("x1", "GREATEST", "list_max"), ("y1", "GREATEST", "list_max")))
    return f"""
num AS (SELECT *,ROW_NUMBER() OVER (PARTITION BY doc_id,page_idx ORDER BY {order}) k FROM src),
ins AS (SELECT a.doc_id,a.page_idx,a.k i,LIST(b.k ORDER BY b.k) own FROM num a JOIN num b ON a.doc_id=b.doc_id AND a.page_idx=b.page_idx AND a.k<>b.k
  AND a.x0<b.x1 AND b.x0<a.x1 AND a.y0<b.y1 AND b.y0<a.y1
  AND (LEAST(a.x1,b.x1)-GREATEST(a.x0,b.x0))*(LEAST(a.y1,b.y1)-GREATEST(a.y0,b.y0))*10>=8*(b.x1-b.x0)*(b.y1-b.y0) GROUP BY 1,2,3 HAVING COUNT(*)>1),
held AS (SELECT doc_id,page_idx,MAP(LIST(i),LIST(own)) inner_of,LIST(i ORDER BY i) bigs FROM ins GROUP BY 1,2),
pg AS (SELECT doc_id,page_idx,LIST(id ORDER BY k) ids,LIST(x0 ORDER BY k) x0,LIST(y0 ORDER BY k) y0,LIST(x1 ORDER BY k) x1,LIST(y1 ORDER BY k) y1,
  LIST(s ORDER BY k) s FROM num GROUP BY 1,2),
w AS (SELECT doc_id,page_idx,CAST(0 AS BIGINT) cur,ids,x0,y0,x1,y1,s,CAST([] AS BIGINT[]) gone FROM pg
 UNION ALL SELECT doc_id,page_idx,i,ids,{hull},s,CASE WHEN wins THEN list_concat(gone,own) ELSE list_append(gone,i) END FROM (
  SELECT *,s[i]*len(own)>list_sum(list_transform(own,lambda o: s[o])) wins FROM (
   SELECT *,list_filter(inner_of[i],lambda o: NOT list_contains(gone,o)) own FROM (
    SELECT w.*,inner_of,list_min(list_filter(bigs,lambda b: b>cur AND NOT list_contains(gone,b)
      AND len(list_filter(inner_of[b],lambda o: NOT list_contains(gone,o)))>1)) i FROM w JOIN held USING (doc_id,page_idx)) z1 WHERE i IS NOT NULL) z2) z3),
fin AS (SELECT doc_id,page_idx,ARG_MAX(w,cur) w FROM w GROUP BY 1,2),
grown AS (SELECT doc_id,page_idx,w.ids[k] id,w.x0[k] x0,w.y0[k] y0,w.x1[k] x1,w.y1[k] y1 FROM (
  SELECT doc_id,page_idx,w,UNNEST(generate_series(1,len(w.ids))) k FROM fin) z WHERE NOT list_contains(w.gone,k))"""


@query("J27_big_block_against_inner", ["dets"], GROWN, SRC.format(kind="0", where="") + "," + _outvoted())
def j27(t):
    return _bare(D.big_against_inner(scored(t)))


# The chain over regions: tables merged, without tables of tables, absorbed by score; text absorbed; all against those inside.
REGIONS = ",".join([
    tagged(SRC.format(kind="0", where=" WHERE category_id=5") + "," + _merged("7"), "m"),
    "tb AS (SELECT doc_id,page_idx,ord,id det_id,x0,y0,x1,y1 FROM merged_m)",
    TABLES_SQL[TABLES_SQL.index("held AS"):].strip(),
    "kept_tables AS (SELECT tb.*,d.score_m FROM tb JOIN dets d ON d.doc_id=tb.doc_id AND d.page_idx=tb.page_idx AND d.det_id=tb.det_id "
    "WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id=tb.doc_id AND g.page_idx=tb.page_idx AND g.big=tb.det_id "
    "AND NOT EXISTS (SELECT 1 FROM crossing c WHERE c.doc_id=g.doc_id AND c.page_idx=g.page_idx AND c.big=g.big)))",
    tagged("src AS (SELECT doc_id,page_idx,0 kind,ord id,x0,y0,x1,y1,score_m s FROM kept_tables)," + _grown("8", by_score=True), "t"),
    tagged(SRC.format(kind="0", where=" WHERE category_id=1") + "," + _grown("8", by_score=True), "x"),
    """src_j AS (SELECT doc_id,page_idx,0 part,det_id id,det_id,x0,y0,x1,y1,score_m s,'ocr' region FROM dets WHERE category_id IN (0,2,3,4,6,7)
 UNION ALL SELECT g.doc_id,g.page_idx,1,g.id,g.id,g.x0,g.y0,g.x1,g.y1,d.score_m,'text' FROM grown_x g JOIN dets d ON d.doc_id=g.doc_id AND d.page_idx=g.page_idx AND d.det_id=g.id
 UNION ALL SELECT g.doc_id,g.page_idx,2,g.id,k.det_id,g.x0,g.y0,g.x1,g.y1,k.score_m,'table' FROM grown_t g JOIN kept_tables k ON k.doc_id=g.doc_id AND k.page_idx=g.page_idx AND k.ord=g.id)""",
    tagged(_outvoted("part,id"), "j")])


@query("PF25_layout_regions", ["dets"], """
SELECT g.doc_id,g.page_idx,n.det_id,n.region,g.x0,g.y0,g.x1,g.y1 FROM (SELECT doc_id,page_idx,w_j.ids[k] id,k,w_j.x0[k] x0,w_j.y0[k] y0,w_j.x1[k] x1,w_j.y1[k] y1 FROM (
  SELECT doc_id,page_idx,w_j,UNNEST(generate_series(1,len(w_j.ids))) k FROM fin_j) z WHERE NOT list_contains(w_j.gone,k)) g
JOIN num_j n ON n.doc_id=g.doc_id AND n.page_idx=g.page_idx AND n.k=g.k""", REGIONS)
def pf25(t):
    return D.layout_regions(scored(t)).select("doc_id", "page_idx", "det_id", "region", "x0", "y0", "x1", "y1")


# Ordered elimination as a recursive walk over the conflicting pairs of each page.
ELIMINATE = """
e AS (SELECT doc_id,page_idx,i,j,loser,ROW_NUMBER() OVER (PARTITION BY doc_id,page_idx ORDER BY i,j) n FROM conflict),
w AS (SELECT doc_id,page_idx,CAST(0 AS BIGINT) n,CAST([] AS BIGINT[]) gone FROM (SELECT DISTINCT doc_id,page_idx FROM e) s
  UNION ALL SELECT w.doc_id,w.page_idx,e.n,CASE WHEN list_contains(w.gone,e.i) OR list_contains(w.gone,e.j) THEN w.gone ELSE list_append(w.gone,e.loser) END
  FROM w JOIN e ON e.doc_id=w.doc_id AND e.page_idx=w.page_idx AND e.n=w.n+1),
lost AS (SELECT doc_id,page_idx,UNNEST(gone) id FROM (SELECT doc_id,page_idx,ARG_MAX(gone,n) gone FROM w GROUP BY doc_id,page_idx) z)"""


@query("J28_filter_formula_boxes", ["dets"], f"""
SELECT {COLS} FROM dets x ANTI JOIN (SELECT DISTINCT doc_id,page_idx,id AS det_id FROM lost) l USING (doc_id,page_idx,det_id)""",
       "d AS (SELECT * FROM dets)," + IOU + """,
conflict AS (SELECT doc_id,page_idx,i,j,CASE WHEN si<sj THEN i ELSE j END loser FROM ap WHERE inter*10>8*(ai+aj-inter))""" + "," + ELIMINATE)
def j28(t):
    return _bare(D.keep_confident_formulas(scored(t)))


@query("SE1_distinct_spans", ["dets"], """
SELECT doc_id,page_idx,MIN(det_id) det_id FROM (SELECT doc_id,page_idx,det_id,category_id,CAST(FLOOR(x0/40) AS BIGINT) gx,CAST(FLOOR(y0/40) AS BIGINT) gy FROM dets) z
GROUP BY doc_id,page_idx,category_id,gx,gy""")
def se1(t):
    coarse = t.dets.withColumns({"gx": F.floor(F.col("x0") / 40), "gy": F.floor(F.col("y0") / 40)})
    return D.distinct_spans(coarse, "det_id", ["category_id", "gx", "gy"]).select("doc_id", "page_idx", "det_id")


@query("SE2_union_detections", ["dets"], """
SELECT category_id,has_text,COUNT(*) n FROM (SELECT category_id,false has_text FROM dets UNION ALL
 SELECT 13,false FROM dets WHERE category_id=8 UNION ALL SELECT 15,true FROM dets WHERE category_id=1) z GROUP BY 1,2""")
def se2(t):
    layout = t.dets
    formulas = t.dets.where("category_id = 8").withColumns({"category_id": F.lit(13).cast("bigint"), "latex": F.lit("x")})
    words = t.dets.where("category_id = 1").withColumns({"category_id": F.lit(15).cast("bigint"), "text": F.lit("x")})
    joined = layout.unionByName(formulas, allowMissingColumns=True).unionByName(words, allowMissingColumns=True)
    return joined.groupBy("category_id", F.col("text").isNotNull().alias("has_text")).agg(F.count("*").alias("n"))
