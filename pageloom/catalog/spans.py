"""Span rules over F1, characters and lines over F2."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geom as g
from ..operators import spans as S
from . import query
from .blocks import BLOCKS, FIT, SPANS, page_spans, typed
from .detections import ELIMINATE, IOU

IDS = ["doc_id", "page_idx", "span_id"]
LEFT = """SELECT doc_id,page_idx,det_id span_id FROM dets x
 ANTI JOIN (SELECT DISTINCT doc_id,page_idx,id AS det_id FROM lost) l USING (doc_id,page_idx,det_id)"""


@query("J13_remove_outside_spans", ["dets"], """
SELECT doc_id,page_idx,span_id FROM s SEMI JOIN (SELECT DISTINCT doc_id,page_idx,span_id FROM fit f WHERE
 ((kt='discarded' AND inter*10>4*f.ar) OR (inter*10>5*f.ar AND kt<>'discarded' AND
   CASE st WHEN 'image' THEN kt='image_body' WHEN 'table' THEN kt='table_body' ELSE kt NOT IN ('image_body','table_body') END))) z USING (doc_id,page_idx,span_id)""",
       SPANS + "," + BLOCKS + "," + FIT)
def j13(t):
    k = typed(t)
    return S.keep_spans_in_blocks(page_spans(t), k.where("type <> 'discarded'"), k.where("type = 'discarded'")).select(*IDS)


@query("J14_low_confidence_spans", ["dets"], LEFT, "d AS (SELECT * FROM dets)," + IOU + """,
conflict AS (SELECT doc_id,page_idx,i,j,CASE WHEN si<sj THEN i ELSE j END loser FROM ap WHERE inter*10>9*(ai+aj-inter)),""" + ELIMINATE)
def j14(t):
    return S.drop_low_score_overlaps(page_spans(t)).select(*IDS)


@query("J15_smaller_spans", ["dets"], LEFT, "d AS (SELECT * FROM dets)," + IOU + """,
conflict AS (SELECT doc_id,page_idx,i,j,CASE WHEN ai<=aj THEN i ELSE j END loser FROM ap WHERE inter*100>65*LEAST(ai,aj)),""" + ELIMINATE)
def j15(t):
    return S.drop_smaller_overlaps(page_spans(t)).select(*IDS)


@query("AG3_median_span_height", ["dets"], "SELECT doc_id,page_idx,QUANTILE_CONT(y1-y0,0.5) median_height FROM s WHERE type='text' GROUP BY 1,2", SPANS)
def ag3(t):
    return S.page_median_height(page_spans(t))


@query("PF11_upright_lines", ["lines"], """
SELECT doc_id,page_idx,line_no FROM lines WHERE (doc_id+line_no)%5 IN (0,1,2,3) OR (doc_id+line_no)%25 IN (4,9)""")
def pf11(t):
    k = F.col("doc_id") + F.col("line_no")
    off = F.when(k % 25 == 4, 0.05).when(k % 25 == 9, -0.09).when(k % 25 == 14, 0.11).otherwise(45.0)
    turned = F.radians(F.when(k % 5 == 4, off + 90).otherwise((k % 5) * 90))
    return S.upright_lines(t.lines.withColumn("rotation", turned), F.col("rotation")).select("doc_id", "page_idx", "line_no")


TALL = """v AS (SELECT s.doc_id,s.page_idx,s.span_id,s.x0,s.y0,s.x0+14 x1,s.y1+CASE WHEN span_id%3=0 THEN 60 ELSE 0 END y1,s.type FROM s),
vm AS (SELECT doc_id,page_idx,QUANTILE_CONT(y1-y0,0.5) m FROM v WHERE type='text' GROUP BY 1,2),
vt AS (SELECT v.*,COALESCE(v.type='text' AND y1-y0>m*CAST(2.3 AS DOUBLE) AND y1-y0>(x1-x0)*CAST(2.3 AS DOUBLE),false) vertical FROM v LEFT JOIN vm USING (doc_id,page_idx))"""


def tall_spans(t):
    """Spans 14 wide, every third one higher by 60."""
    extra = F.when(F.col("span_id") % 3 == 0, 60).otherwise(0)
    return page_spans(t).withColumns({"x1": F.col("x0") + 14, "y1": F.col("y1") + extra})


@query("PF12_vertical_spans", ["dets"], "SELECT doc_id,page_idx,span_id,vertical FROM vt", SPANS + "," + TALL)
def pf12(t):
    return S.mark_vertical(tall_spans(t)).select(*IDS, "vertical")


@query("J20_lines_in_vertical_spans", ["dets"], """
SELECT doc_id,page_idx,span_id,STRING_AGG('<'||line_id||'>','' ORDER BY line_id) content FROM (
 SELECT d.doc_id,d.page_idx,d.det_id line_id,MIN(v.span_id) span_id FROM dets d JOIN vt v ON v.vertical AND v.doc_id=d.doc_id AND v.page_idx=d.page_idx
  AND d.x0<=v.x1 AND v.x0<=d.x0+10 AND d.y0<=v.y1 AND v.y0<=d.y1
  AND (LEAST(d.x0+10,v.x1)-GREATEST(d.x0,v.x0))*(LEAST(d.y1,v.y1)-GREATEST(d.y0,v.y0))*2>10*(d.y1-d.y0) GROUP BY 1,2,3) z GROUP BY 1,2,3""",
       SPANS + "," + TALL)
def j20(t):
    lines = t.dets.select("doc_id", "page_idx", F.col("det_id").alias("line_id"), F.concat(F.lit("<"), "det_id", F.lit(">")).alias("text"),
                          "x0", "y0", (F.col("x0") + 10).alias("x1"), "y1")
    return S.fill_vertical_spans(lines, S.mark_vertical(tall_spans(t)).where("vertical"))


# Characters drawn a little to the right, so that some leave their span.
SHIFT = """ch AS (SELECT doc_id,page_idx,line_no*1000+i char_id,i,ch,x0+2 x0,y0,x1+2-CASE WHEN i%7=0 THEN 2 ELSE 0 END x1,y1 FROM chars),
won AS (SELECT doc_id,page_idx,char_id,i,ch,cx0,cx1,span_id FROM (SELECT c.doc_id,c.page_idx,c.char_id,c.i,c.ch,c.x0 cx0,c.x1 cx1,s.span_id,
  ROW_NUMBER() OVER (PARTITION BY c.doc_id,c.page_idx,c.char_id ORDER BY s.y0,s.span_id) rn FROM ch c
  JOIN spans s ON s.doc_id=c.doc_id AND s.page_idx=c.page_idx AND c.y0+c.y1>2*s.y0 AND c.y0+c.y1<2*s.y1
  AND ABS(c.y0+c.y1-s.y0-s.y1)*50<(s.y1-s.y0)*33
  AND ((c.x0+c.x1>2*s.x0 AND c.x0+c.x1<2*s.x1)
   OR (c.ch IN ('.','!','?','。','！','？',')','）','"','”',':','：',';','；',']','】','}','>','》','、',',','，','-','—','–')
       AND c.x0>s.x1-(s.y1-s.y0) AND c.x0<s.x1 AND c.x0+c.x1>2*s.x0)
   OR (c.ch IN ('(','（','“','【','{','《','<','「','『','[')
       AND c.x1>s.x0 AND c.x1<s.x0+(s.y1-s.y0) AND c.x0+c.x1<2*s.x1))) z WHERE rn=1)"""


def shifted_chars(t):
    narrow = F.when(F.col("i") % 7 == 0, 2).otherwise(0)
    return t.chars.select("doc_id", "page_idx", (F.col("line_no") * 1000 + F.col("i")).alias("char_id"), "i", "ch",
                          (F.col("x0") + 2).alias("x0"), "y0", (F.col("x1") + 2 - narrow).alias("x1"), "y1")


@query("J17_fill_chars_in_spans", ["chars", "spans"], """
SELECT doc_id,page_idx,span_id,COUNT(*) n,MIN(i) lo,MAX(i) hi,CAST(SUM(char_id) AS BIGINT) ids,CAST(SUM(char_id*i) AS BIGINT) places FROM won GROUP BY 1,2,3""", SHIFT)
def j17(t):
    won = S.fill_chars(shifted_chars(t), S.rank_spans(t.spans), ["span_id"])
    found = won.groupBy(*S.SPAN_ORD, "span_id").agg(F.count("*").alias("n"), F.min("i").alias("lo"), F.max("i").alias("hi"),
                                         F.sum("char_id").alias("ids"), F.sum(F.col("char_id") * F.col("i")).alias("places"))
    return found.drop("ord")


CONTENT = """, pieces AS (SELECT doc_id,page_idx,span_id,i,ch,cx1,LEAD(cx0) OVER w nx,LEAD(ch) OVER w nc,
  QUANTILE_CONT(cx1-cx0,0.5) OVER (PARTITION BY doc_id,page_idx,span_id) mw FROM won WINDOW w AS (PARTITION BY doc_id,page_idx,span_id ORDER BY i)),
content AS (SELECT doc_id,page_idx,span_id,MAX(mw) median_width,REGEXP_REPLACE(STRING_AGG(
  CASE WHEN nx-cx1>mw*0.25 AND ch<>' ' AND nc<>' ' THEN ch||' ' ELSE ch END,'' ORDER BY i),'^\\s+|\\s+$','','g') content FROM pieces GROUP BY 1,2,3)"""


def _contents(t):
    return S.span_texts(shifted_chars(t), S.rank_spans(t.spans), ["span_id"]).drop("ord")


@query("W19_chars_to_content", ["chars", "spans"], "SELECT doc_id,page_idx,span_id,content FROM content", SHIFT + CONTENT)
def w19(t):
    return _contents(t).drop("median_width")


@query("AG4_median_char_width", ["chars", "spans"], "SELECT doc_id,page_idx,span_id,median_width FROM content", SHIFT + CONTENT)
def ag4(t):
    return _contents(t).drop("content")


LINES = """
fl AS (SELECT *,LAG(y0) OVER w py0,LAG(y1) OVER w py1,LAG(type) OVER w pt FROM s WINDOW w AS (PARTITION BY doc_id,page_idx ORDER BY y0,span_id)),
ln AS (SELECT *,SUM(CASE WHEN pt IS NULL OR type IN ('interline_equation','image','table') OR pt IN ('interline_equation','image','table')
   OR GREATEST(LEAST(y1,py1)-GREATEST(y0,py0),0)*10<=6*LEAST(y1-y0,py1-py0) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id,page_idx ORDER BY y0,span_id) line_no FROM fl)"""


@query("W1_spans_to_lines", ["dets"], """
SELECT doc_id,page_idx,span_id,CAST(line_no AS BIGINT) line_no,ROW_NUMBER() OVER (PARTITION BY doc_id,page_idx,line_no ORDER BY x0,y0,span_id) pos FROM ln""",
       SPANS + "," + LINES)
def w1(t):
    return S.spans_to_lines(page_spans(t), ["doc_id", "page_idx"]).select(*IDS, "line_no", "pos")


@query("AG6_line_bounds", ["dets"], """
SELECT doc_id,page_idx,CAST(line_no AS BIGINT) line_no,MIN(x0) x0,MIN(y0) y0,MAX(x1) x1,MAX(y1) y1 FROM ln GROUP BY doc_id,page_idx,line_no""", SPANS + "," + LINES)
def ag6(t):
    return S.bounds(S.spans_to_lines(page_spans(t), ["doc_id", "page_idx"]), ["doc_id", "page_idx", "line_no"])


@query("W2_spans_to_vertical_lines", ["dets"], """
SELECT doc_id,page_idx,span_id,line_no,ROW_NUMBER() OVER (PARTITION BY doc_id,page_idx,line_no ORDER BY y0,x1 DESC,span_id) pos FROM (
 SELECT *,CAST(SUM(CASE WHEN pt IS NULL OR type IN ('interline_equation','image','table') OR pt IN ('interline_equation','image','table')
   OR GREATEST(LEAST(x1,px1)-GREATEST(x0,px0),0)*10<=6*LEAST(x1-x0,px1-px0) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id,page_idx ORDER BY x1 DESC,span_id) AS BIGINT) line_no
 FROM (SELECT *,LAG(x0) OVER w px0,LAG(x1) OVER w px1,LAG(type) OVER w pt FROM s WINDOW w AS (PARTITION BY doc_id,page_idx ORDER BY x1 DESC,span_id)) z) y""", SPANS)
def w2(t):
    return S.spans_to_lines(page_spans(t), ["doc_id", "page_idx"], vertical=True).select(*IDS, "line_no", "pos")


MERGED = """
rx AS (SELECT *,MAX(x1) OVER (PARTITION BY doc_id,page_idx,line_no ORDER BY x0,span_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) reach FROM ln),
pt AS (SELECT *,CAST(SUM(CASE WHEN reach>=x0 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id,page_idx,line_no ORDER BY x0,span_id) AS BIGINT) part FROM rx)"""


@query("W3_merge_spans_on_line", ["dets"], """
SELECT doc_id,page_idx,CAST(line_no AS BIGINT) line_no,part,MIN(x0) x0,MIN(y0) y0,MAX(x1) x1,MAX(y1) y1 FROM pt GROUP BY doc_id,page_idx,line_no,part""",
       SPANS + "," + LINES + "," + MERGED)
def w3(t):
    return S.merge_on_line(S.spans_to_lines(page_spans(t), ["doc_id", "page_idx"]), ["doc_id", "page_idx", "line_no"])


@query("W4_merge_det_boxes", ["dets"], """
SELECT doc_id,page_idx,x0,y0,x1,y1,COUNT(*) n FROM (
 SELECT doc_id,page_idx,MIN(x0) x0,MIN(y0) y0,MAX(x1) x1,MAX(y1) y1 FROM pt JOIN lw USING (doc_id,page_idx,line_no) WHERE lw.long GROUP BY doc_id,page_idx,line_no,part
 UNION ALL SELECT doc_id,page_idx,x0,y0,x1,y1 FROM ln JOIN lw USING (doc_id,page_idx,line_no) WHERE NOT lw.long
 UNION ALL SELECT doc_id,page_idx,x0,y0,x1,y1 FROM (SELECT doc_id,page_idx,det_id,x0+2 x0,y0+1 y0,x1+2 x1,y1+1 y1 FROM dets) q WHERE det_id%11=0) z GROUP BY 1,2,3,4,5,6""",
       """s AS (SELECT doc_id,page_idx,det_id span_id,x0+2 x0,y0+1 y0,x1+2 x1,y1+1 y1,'text' AS type FROM dets WHERE det_id%11<>0),""" + LINES + "," + MERGED + """,
lw AS (SELECT doc_id,page_idx,line_no,MAX(x1)-MIN(x0)>4*(MAX(y1)-MIN(y0)) long FROM ln GROUP BY 1,2,3)""")
def w4(t):
    boxes = page_spans(t).withColumn("skewed", F.col("span_id") % 11 == 0)
    out = S.merge_detected_boxes(boxes)
    return out.groupBy(*out.columns).agg(F.count("*").alias("n"))


ISLANDS = """iv AS (SELECT doc_id,page_idx,x0 lo,LEAST(x1,x0+60) hi FROM dets WHERE category_id IN (0,3,8)),
ir AS (SELECT *,MAX(hi) OVER (PARTITION BY doc_id,page_idx ORDER BY lo,hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) reach FROM iv),
ii AS (SELECT *,SUM(CASE WHEN reach>=lo THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id,page_idx ORDER BY lo,hi) run FROM ir),
mi AS (SELECT doc_id,page_idx,MIN(lo) lo,MAX(hi) hi FROM ii GROUP BY doc_id,page_idx,run)"""


def _intervals(t):
    return t.dets.where("category_id in (0, 3, 8)").select("doc_id", "page_idx", F.col("x0").alias("lo"), F.least("x1", F.col("x0") + 60).alias("hi"))


@query("W5_merge_intervals", ["dets"], "SELECT * FROM mi", ISLANDS)
def w5_merge(t):
    return S.merge_intervals(_intervals(t), ["doc_id", "page_idx"])


@query("W5_remove_intervals", ["dets"], """
SELECT doc_id,page_idx,lo,hi FROM (
 SELECT doc_id,page_idx,COALESCE(LAG(hi) OVER (PARTITION BY doc_id,page_idx ORDER BY lo)+1,100) lo,lo-1 hi FROM mi WHERE lo<=500 AND hi>=100
 UNION ALL SELECT doc_id,page_idx,MAX(hi)+1,500 FROM mi WHERE lo<=500 AND hi>=100 GROUP BY 1,2
 UNION ALL SELECT doc_id,page_idx,100,500 FROM (SELECT DISTINCT doc_id,page_idx FROM dets) p WHERE NOT EXISTS (
   SELECT 1 FROM mi WHERE mi.doc_id=p.doc_id AND mi.page_idx=p.page_idx AND lo<=500 AND hi>=100)) z WHERE lo<=hi""", ISLANDS)
def w5_remove(t):
    ranges = t.dets.select("doc_id", "page_idx").distinct().withColumns({"start": F.lit(100).cast("bigint"), "end": F.lit(500).cast("bigint")})
    return S.subtract_intervals(ranges, _intervals(t), ["doc_id", "page_idx"])


# A text box loses the ranges of the formulas on its height: what is left lies before each mask, behind all masks before it, and at the end.
CUTS = """cuts AS MATERIALIZED (SELECT * FROM dets WHERE category_id=8),
txt AS (SELECT doc_id,page_idx,det_id span_id,x0,y0,x1,y1,det_id%11=0 skewed FROM dets WHERE category_id<>8),
plain AS MATERIALIZED (SELECT * FROM txt WHERE NOT skewed),
fm AS MATERIALIZED (SELECT * FROM (SELECT t.doc_id,t.page_idx,t.span_id,t.x0 a,t.x1 b,t.y0,t.y1,f.x0 lo,f.x1 hi,LEAST(t.x1,f.x1)-GREATEST(t.x0,f.x0) iw,
   GREATEST(LEAST(t.y1,f.y1)-GREATEST(t.y0,f.y0),0)*10-8*LEAST(t.y1-t.y0,f.y1-f.y0) beyond
   FROM plain t JOIN cuts f ON f.doc_id=t.doc_id AND f.page_idx=t.page_idx) pp WHERE beyond>0 AND iw>=0),
left_ AS (SELECT doc_id,page_idx,span_id,GREATEST(a,COALESCE(MAX(hi) OVER (PARTITION BY doc_id,page_idx,span_id ORDER BY lo,hi
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)+1,a)) x0,y0,lo-1 x1,y1 FROM fm
  UNION ALL SELECT doc_id,page_idx,span_id,MAX(hi)+1,y0,b,y1 FROM fm GROUP BY doc_id,page_idx,span_id,y0,b,y1)"""


@query("J24_cut_text_at_formulas", ["dets"], """
SELECT doc_id,page_idx,span_id,x0,y0,x1,y1 FROM left_ WHERE x0<=x1
UNION ALL SELECT doc_id,page_idx,span_id,x0,y0,x1,y1 FROM txt t
 WHERE NOT EXISTS (SELECT 1 FROM fm WHERE fm.doc_id=t.doc_id AND fm.page_idx=t.page_idx AND fm.span_id=t.span_id)""", CUTS)
def j24(t):
    d = t.dets.withColumnRenamed("det_id", "span_id")
    text = d.where("category_id <> 8").withColumn("skewed", F.col("span_id") % 11 == 0)
    return S.cut_text_at_formulas(text, d.where("category_id = 8"))
