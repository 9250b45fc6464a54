"""Geometry predicates over meeting or neighbouring boxes of a page."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geom as g
from ..operators.pairs import meeting_pairs
from ..operators.strips import meeting_chars
from . import query

A, B = g.box("a"), g.box("b")

# Pairs of boxes that meet, for the area functions. The join has equalities only; extents are compared by their differences.
MEET = """
pp AS (SELECT a.doc_id,a.page_idx,a.det_id id1,b.det_id id2,b.det_id-a.det_id step,
  a.x0 ax0,a.y0 ay0,a.x1 ax1,a.y1 ay1,b.x0 bx0,b.y0 by0,b.x1 bx1,b.y1 by1,
  (a.x1-a.x0)*(a.y1-a.y0) aa,(b.x1-b.x0)*(b.y1-b.y0) ab,
  LEAST(a.x1,b.x1)-GREATEST(a.x0,b.x0) iw,LEAST(a.y1,b.y1)-GREATEST(a.y0,b.y0) ih
  FROM dets a JOIN dets b ON a.doc_id=b.doc_id AND a.page_idx=b.page_idx),
mp AS (SELECT * FROM pp WHERE step>0 AND iw>=0 AND ih>=0)"""

# Each box with the next one of the page, so that boxes apart occur too.
NEXT = """
mp AS (SELECT * FROM (SELECT doc_id,page_idx,det_id id1,x0 ax0,y0 ay0,x1 ax1,y1 ay1,
  LEAD(det_id) OVER w id2,LEAD(x0) OVER w bx0,LEAD(y0) OVER w by0,LEAD(x1) OVER w bx1,LEAD(y1) OVER w by1
  FROM dets WINDOW w AS (PARTITION BY doc_id,page_idx ORDER BY det_id)) z WHERE id2 IS NOT NULL)"""


def _meeting(t):
    d = t.dets.drop("score_m", "category_id")
    return meeting_pairs(d, d, F.col("a.det_id") < F.col("b.det_id"))


def _ids(df, *cols):
    return df.select("a.doc_id", "a.page_idx", F.col("a.det_id").alias("id1"), F.col("b.det_id").alias("id2"), *cols)


def _neighbours(t):
    d = t.dets.drop("score_m", "category_id")
    nxt = d.withColumn("det_id", F.col("det_id") - 1)
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("doc_id", "page_idx", "det_id")]
    return d.alias("a").join(nxt.alias("b"), on)


def _next_ids(df, *cols):
    return df.select("a.doc_id", "a.page_idx", F.col("a.det_id").alias("id1"), *cols)


@query("G1_is_in", ["dets"], "SELECT doc_id,page_idx,id1,id2 FROM mp WHERE ax0>=bx0 AND ay0>=by0 AND ax1<=bx1 AND ay1<=by1", MEET)
def g1(t):
    return _ids(_meeting(t).where(g.contains(A, B)))


@query("G2_bbox_relative_pos", ["dets"],
       "SELECT doc_id,page_idx,id1,bx1<ax0 is_left,ax1<bx0 is_right,by1<ay0 is_bottom,ay1<by0 is_top FROM mp", NEXT)
def g2(t):
    s = g.relative_position(A, B)
    return _next_ids(_neighbours(t), s.left.alias("is_left"), s.right.alias("is_right"),
                     s.bottom.alias("is_bottom"), s.top.alias("is_top"))


@query("G3_bbox_distance", ["dets"], """
SELECT doc_id,page_idx,id1,ROUND(CASE
  WHEN bx1<ax0 AND ay1<by0 THEN SQRT((ax0-bx1)*(ax0-bx1)+(by0-ay1)*(by0-ay1))
  WHEN bx1<ax0 AND by1<ay0 THEN SQRT((ax0-bx1)*(ax0-bx1)+(ay0-by1)*(ay0-by1))
  WHEN ax1<bx0 AND by1<ay0 THEN SQRT((bx0-ax1)*(bx0-ax1)+(ay0-by1)*(ay0-by1))
  WHEN ax1<bx0 AND ay1<by0 THEN SQRT((bx0-ax1)*(bx0-ax1)+(by0-ay1)*(by0-ay1))
  WHEN bx1<ax0 THEN ax0-bx1 WHEN ax1<bx0 THEN bx0-ax1 WHEN by1<ay0 THEN ay0-by1 WHEN ay1<by0 THEN by0-ay1
  ELSE 0 END,6) distance FROM mp""", NEXT)
def g3(t):
    return _next_ids(_neighbours(t), F.round(g.edge_distance(A, B), 6).alias("distance"))


@query("G4_bbox_center_distance", ["dets"], """
SELECT doc_id,page_idx,id1,ROUND(SQRT(((ax0+ax1)/2.0-(bx0+bx1)/2.0)*((ax0+ax1)/2.0-(bx0+bx1)/2.0)
  +((ay0+ay1)/2.0-(by0+by1)/2.0)*((ay0+ay1)/2.0-(by0+by1)/2.0)),6) distance FROM mp""", NEXT)
def g4(t):
    return _next_ids(_neighbours(t), F.round(g.center_distance(A, B), 6).alias("distance"))


@query("G5_overlap_of_smaller", ["dets"], """
SELECT doc_id,page_idx,id1,id2,CASE WHEN aa<=ab THEN id1 ELSE id2 END smaller FROM mp WHERE iw*ih*10>8*LEAST(aa,ab)""", MEET)
def g5(t):
    pick = F.when(g.first_is_smaller(A, B), F.col("a.det_id")).otherwise(F.col("b.det_id"))
    return _ids(_meeting(t).where(g.overlap_of_smaller(A, B) > 0.8), pick.alias("smaller"))


@query("G6_iou", ["dets"],
       "SELECT doc_id,page_idx,id1,id2,ROUND(CAST(iw*ih AS DOUBLE)/(aa+ab-iw*ih),6) iou FROM mp", MEET)
def g6(t):
    return _ids(_meeting(t), F.round(g.iou(A, B), 6).alias("iou"))


@query("G7_overlap_of_first", ["dets"],
       "SELECT doc_id,page_idx,id1,id2,ROUND(CAST(iw*ih AS DOUBLE)/aa,6) share FROM mp", MEET)
def g7(t):
    return _ids(_meeting(t), F.round(g.overlap_of_first(A, B), 6).alias("share"))


@query("G8_x_projection_overlap", ["dets"],
       "SELECT doc_id,page_idx,id1,ROUND(CAST(GREATEST(LEAST(ax1,bx1)-GREATEST(ax0,bx0),0) AS DOUBLE)/(ax1-ax0),6) share FROM mp", NEXT)
def g8(t):
    return _next_ids(_neighbours(t), F.round(g.x_projection_overlap(A, B), 6).alias("share"))


@query("G9_axis_overlap", ["dets"], """
SELECT doc_id,page_idx,id1,GREATEST(LEAST(ay1,by1)-GREATEST(ay0,by0),0)*10>8*LEAST(ay1-ay0,by1-by0) same_row,
  GREATEST(LEAST(ax1,bx1)-GREATEST(ax0,bx0),0)*10>8*LEAST(ax1-ax0,bx1-bx0) same_column FROM mp""", NEXT)
def g9(t):
    return _next_ids(_neighbours(t), g.y_overlaps(A, B).alias("same_row"), g.x_overlaps(A, B).alias("same_column"))


@query("G10_box_contained", ["dets"], """
SELECT doc_id,page_idx,id1,id2,CAST(CASE WHEN (aa-iw*ih)*10<2*aa THEN 1 WHEN (ab-iw*ih)*10<2*ab THEN 2 END AS BIGINT) inner_one FROM mp""", MEET)
def g10(t):
    return _ids(_meeting(t), g.box_contained(A, B).alias("inner_one"))


@query("G11_axis_contained", ["dets"], """
SELECT doc_id,page_idx,id1,
 CAST(CASE WHEN ((ax1-ax0)-(LEAST(ax1,bx1)-GREATEST(ax0,bx0)))*10<2*(ax1-ax0) THEN 1
      WHEN ((bx1-bx0)-(LEAST(ax1,bx1)-GREATEST(ax0,bx0)))*10<2*(bx1-bx0) THEN 2 END AS BIGINT) on_x,
 CAST(CASE WHEN ((ay1-ay0)-(LEAST(ay1,by1)-GREATEST(ay0,by0)))*10<2*(ay1-ay0) THEN 1
      WHEN ((by1-by0)-(LEAST(ay1,by1)-GREATEST(ay0,by0)))*10<2*(by1-by0) THEN 2 END AS BIGINT) on_y FROM mp""", NEXT)
def g11(t):
    return _next_ids(_neighbours(t), g.axis_contained(A, B, "x").alias("on_x"), g.axis_contained(A, B, "y").alias("on_y"))


@query("G12_table_iou", ["dets"], """
SELECT doc_id,page_idx,id1,id2,ROUND(CASE WHEN aa+ab-iw*ih=0 THEN 1 ELSE CAST(iw*ih AS DOUBLE)/(aa+ab-iw*ih) END,6) iou FROM mp""", MEET)
def g12(t):
    return _ids(_meeting(t), F.round(g.table_iou(A, B), 6).alias("iou"))


@query("G13_inside_overlap_iou", ["dets"], """
SELECT doc_id,page_idx,id1,id2,iw>0 AND ih>0 overlap,iw>0 AND ih>0 AND iw*ih*10>=8*aa inside,
  ROUND(CASE WHEN iw>0 AND ih>0 THEN CAST(iw*ih AS DOUBLE)/(aa+ab-iw*ih) ELSE 0 END,6) iou FROM mp""", MEET)
def g13(t):
    return _ids(_meeting(t), g.overlaps(A, B).alias("overlap"), g.mostly_inside(A, B).alias("inside"),
                F.round(g.area_iou(A, B), 6).alias("iou"))


@query("G14_structure_distance", ["dets"], """
SELECT doc_id,page_idx,id1,
  ABS(bx0-ax0)+ABS(by0-ay0)+ABS(bx1-ax1)+ABS(by1-ay1)+LEAST(ABS(bx0-ax0)+ABS(by0-ay0),ABS(bx1-ax1)+ABS(by1-ay1)) distance,
  ROUND(CASE WHEN LEAST(ax1,bx1)>GREATEST(ax0,bx0) AND LEAST(ay1,by1)>GREATEST(ay0,by0) THEN
    CAST((LEAST(ax1,bx1)-GREATEST(ax0,bx0))*(LEAST(ay1,by1)-GREATEST(ay0,by0)) AS DOUBLE)
    /((ax1-ax0)*(ay1-ay0)+(bx1-bx0)*(by1-by0)-(LEAST(ax1,bx1)-GREATEST(ax0,bx0))*(LEAST(ay1,by1)-GREATEST(ay0,by0)))
    ELSE 0 END,6) iou FROM mp""", NEXT)
def g14(t):
    return _next_ids(_neighbours(t), g.structure_distance(A, B).alias("distance"), F.round(g.structure_iou(A, B), 6).alias("iou"))


@query("G15_char_in_span", ["chars", "spans"], """
SELECT doc_id,page_idx,COUNT(*) n_pairs,COUNT(CASE WHEN cxx<=sx0*2 OR cxx>=sx1*2 THEN 1 END) n_by_border FROM c GROUP BY doc_id,page_idx""", """
c AS (SELECT ch.doc_id,ch.page_idx,ch.x0+ch.x1 cxx,s.x0 sx0,s.x1 sx1 FROM chars ch
  JOIN spans s ON s.doc_id=ch.doc_id AND s.page_idx=ch.page_idx AND ch.y0+ch.y1>2*s.y0 AND ch.y0+ch.y1<2*s.y1
  AND ABS(ch.y0+ch.y1-s.y0-s.y1)*50<(s.y1-s.y0)*33
  AND ((ch.x0+ch.x1>2*s.x0 AND ch.x0+ch.x1<2*s.x1)
   OR (ch.ch IN ('.','!','?','。','！','？',')','）','"','”',':','：',';','；',']','】','}','>','》','、',',','，','-','—','–')
       AND ch.x0>s.x1-(s.y1-s.y0) AND ch.x0<s.x1 AND ch.x0+ch.x1>2*s.x0)
   OR (ch.ch IN ('(','（','“','【','{','《','<','「','『','[')
       AND ch.x1>s.x0 AND ch.x1<s.x0+(s.y1-s.y0) AND ch.x0+ch.x1<2*s.x1)))""")
def g15(t):
    ch, sp = g.box("a"), g.box("b")
    chars = t.chars.select("doc_id", "page_idx", "ch", "x0", "y0", "x1", "y1")
    spans = t.spans.select("doc_id", "page_idx", "x0", "y0", "x1", "y1")
    pairs = meeting_chars(chars, spans).where(g.char_in_span(ch, sp, F.col("a.ch")))
    cx = ch.x0 + ch.x1
    return pairs.groupBy("doc_id", "page_idx").agg(
        F.count("*").alias("n_pairs"),
        F.count(F.when((cx <= sp.x0 * 2) | (cx >= sp.x1 * 2), 1)).alias("n_by_border"))
