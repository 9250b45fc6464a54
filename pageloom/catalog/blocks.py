"""Block conflicts over F1 and caption matching over F3."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geom as g
from ..operators import blocks as B
from ..operators import detections as D
from . import query
from .detections import _grown, scored

TYPES = {0: "title", 1: "text", 2: "discarded", 3: "image_body", 5: "table_body", 6: "table_caption", 8: "interline_equation"}
CASE = "CASE category_id " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in TYPES.items()) + " END"
BLOCKS = f"""k AS (SELECT doc_id,page_idx,det_id block_id,{CASE} AS type,x0,y0,x1,y1,(x1-x0)*(y1-y0) ar FROM dets)"""
# Near copies of a block get the type that should yield, so that coinciding types occur.
COPIES = """k AS (SELECT doc_id,page_idx,det_id*2+dup block_id,CASE WHEN dup=1 THEN other ELSE own END AS type,x0+dup x0,y0,x1+dup x1,y1,(x1-x0)*(y1-y0) ar
  FROM (SELECT *,CASE category_id WHEN 0 THEN 'title' WHEN 8 THEN 'interline_equation' ELSE 'text' END own,
    CASE category_id WHEN 0 THEN 'text' WHEN 8 THEN 'text' WHEN 1 THEN 'title' ELSE 'image_body' END other FROM dets) y
  CROSS JOIN (SELECT 0 dup UNION ALL SELECT 1) z)"""
HIT = """hit AS (SELECT a.doc_id,a.page_idx,a.block_id,a.type ta,b.type tb,a.ar aa,b.ar ab,b.block_id other,
  (LEAST(a.x1,b.x1)-GREATEST(a.x0,b.x0))*(LEAST(a.y1,b.y1)-GREATEST(a.y0,b.y0)) inter
  FROM k a JOIN k b ON a.doc_id=b.doc_id AND a.page_idx=b.page_idx AND a.block_id<>b.block_id
  AND a.x0<=b.x1 AND b.x0<=a.x1 AND a.y0<=b.y1 AND b.y0<=a.y1)"""
KEEP = """SELECT doc_id,page_idx,block_id FROM (SELECT * FROM k {only}) z
  ANTI JOIN (SELECT DISTINCT doc_id,page_idx,block_id FROM hit WHERE {rule}) h USING (doc_id,page_idx,block_id)"""
# Blocks below a wide discarded block that starts low enough on the page.
UNDER = """low AS (SELECT DISTINCT k.doc_id,k.page_idx,k.block_id,1 hit FROM (SELECT * FROM k WHERE type<>'discarded') k
  JOIN (SELECT * FROM k WHERE type='discarded' AND (x1-x0)*{share}>612 AND y1-y0>10 AND y0*10>{tenths}*792) f
  ON f.doc_id=k.doc_id AND f.page_idx=k.page_idx AND k.y0>=f.y1 AND GREATEST(LEAST(k.x1,f.x1)-GREATEST(k.x0,f.x0),0)*10>=8*(k.x1-k.x0))"""
OUT = ["doc_id", "page_idx", "block_id"]


def typed(t):
    case = F.create_map(*(F.lit(x) for kv in TYPES.items() for x in kv))
    return t.dets.select("doc_id", "page_idx", F.col("det_id").alias("block_id"),
                         case[F.col("category_id").cast("int")].alias("type"), "x0", "y0", "x1", "y1")


def copied(t):
    c = F.col("category_id")
    own = F.when(c == 0, "title").when(c == 8, "interline_equation").otherwise("text")
    other = F.when(c.isin(0, 8), "text").when(c == 1, "title").otherwise("image_body")
    d = t.dets.withColumn("dup", F.explode(F.array(F.lit(0), F.lit(1))))
    return d.select("doc_id", "page_idx", (F.col("det_id") * 2 + F.col("dup")).alias("block_id"),
                    F.when(F.col("dup") == 1, other).otherwise(own).alias("type"),
                    (F.col("x0") + F.col("dup")).alias("x0"), "y0", (F.col("x1") + F.col("dup")).alias("x1"), "y1")


@query("J7_title_under_text", ["dets"], KEEP.format(only="", rule="ta='title' AND tb='text' AND inter*10>8*(aa+ab-inter)"), COPIES + "," + HIT)
def j7(t):
    return B.drop_titles_under_text(copied(t)).select(*OUT)


@query("J8_block_on_discarded", ["dets"], KEEP.format(only="WHERE type<>'discarded'", rule="tb='discarded' AND inter*10>6*aa"), BLOCKS + "," + HIT)
def j8(t):
    k = typed(t)
    return B.drop_blocks_on_discarded(k.where("type <> 'discarded'"), k.where("type = 'discarded'")).select(*OUT)


@query("J9_text_under_equation", ["dets"], KEEP.format(only="", rule="ta='text' AND tb='interline_equation' AND inter*10>8*(aa+ab-inter)"),
       COPIES + "," + HIT)
def j9(t):
    return B.drop_text_under_equations(copied(t)).select(*OUT)


@query("PF8_page_footnotes", ["dets"], "SELECT doc_id,page_idx,block_id FROM k WHERE type='discarded' AND (x1-x0)*3>612 AND y1-y0>10 AND y0*10>7*792", BLOCKS)
def pf8(t):
    return B.page_footnotes(typed(t).where("type = 'discarded'"), F.lit(612), F.lit(792)).select(*OUT)


@query("J10_blocks_under_footnote", ["dets"], """
SELECT doc_id,page_idx,block_id,hit IS NOT NULL under FROM k LEFT JOIN low USING (doc_id,page_idx,block_id) WHERE type<>'discarded'""",
       BLOCKS + "," + UNDER.format(share="5", tenths="2"))
def j10(t):
    k = typed(t)
    b = g.box()
    notes = k.where("type = 'discarded'").where((g.width(b) > F.lit(612) / 5) & (g.height(b) > 10) & (b.y0 > F.lit(792) * 0.2))
    stay, under = B.split_under_footnotes(k.where("type <> 'discarded'"), notes)
    return stay.select(*OUT, F.lit(False).alias("under")).unionByName(under.select(*OUT, F.lit(True).alias("under")))


@query("SE5_move_to_discarded", ["dets"], """
SELECT doc_id,page_idx,COUNT(CASE WHEN type='discarded' OR under THEN 1 END) n_discarded,COUNT(CASE WHEN type<>'discarded' AND NOT under THEN 1 END) n_blocks
FROM (SELECT k.*,hit IS NOT NULL under FROM k LEFT JOIN low USING (doc_id,page_idx,block_id)) z GROUP BY 1,2""",
       BLOCKS + "," + UNDER.format(share="3", tenths="7"))
def se5(t):
    k = typed(t)
    discarded = k.where("type = 'discarded'")
    notes = B.page_footnotes(discarded, F.lit(612), F.lit(792))
    stay, under = B.split_under_footnotes(k.where("type <> 'discarded'"), notes)
    both = stay.select("doc_id", "page_idx", F.lit(0).alias("d")).unionByName(
        discarded.unionByName(under).select("doc_id", "page_idx", F.lit(1).alias("d")))
    return both.groupBy("doc_id", "page_idx").agg(F.sum("d").alias("n_discarded"), F.sum(1 - F.col("d")).alias("n_blocks"))


GROWN = """SELECT g.doc_id,g.page_idx,g.id block_id,k.type,g.x0,g.y0,g.x1,g.y1 FROM grown g
JOIN k ON k.doc_id=g.doc_id AND k.page_idx=g.page_idx AND k.block_id=g.id"""


@query("J11_absorb_overlapping_blocks", ["dets"], GROWN,
       BLOCKS + ",src AS (SELECT doc_id,page_idx,0 kind,block_id id,x0,y0,x1,y1,0 s FROM k)," + _grown("8"))
def j11(t):
    return B.absorb_overlapping_blocks(typed(t))


@query("SO1_coarse_order", ["dets"], "SELECT doc_id,page_idx,block_id,ROW_NUMBER() OVER (PARTITION BY doc_id,page_idx ORDER BY x0+y0,block_id) AS rank FROM k", BLOCKS)
def so1(t):
    return B.coarse_order(typed(t)).select(*OUT, "rank")


def _without(name: str, source: str, rule: str, other: str) -> str:
    """CTE ``name``: rows a of ``source`` for which no row b of ``other`` on the page meets ``rule``."""
    return f"""{name} AS MATERIALIZED (SELECT a.* FROM {source} a ANTI JOIN (SELECT DISTINCT doc_id,page_idx,block_id FROM (
  SELECT a.doc_id,a.page_idx,a.block_id,a.type ta,b.type tb,a.ar aa,b.ar ab,a.x1-a.x0 aw,a.y0-b.y1 below,
   GREATEST(LEAST(a.x1,b.x1)-GREATEST(a.x0,b.x0),0) iw,GREATEST(LEAST(a.y1,b.y1)-GREATEST(a.y0,b.y0),0) ih
  FROM {source} a JOIN {other} b ON a.doc_id=b.doc_id AND a.page_idx=b.page_idx) pp WHERE {rule}) l USING (doc_id,page_idx,block_id))"""


CONFLICTS = ",".join([
    BLOCKS, "b0 AS MATERIALIZED (SELECT * FROM k WHERE type<>'discarded')", "dc AS MATERIALIZED (SELECT * FROM k WHERE type='discarded')",
    _without("b1", "b0", "ta='title' AND tb='text' AND iw*ih*10>8*(aa+ab-iw*ih)", "b0"),
    _without("b2", "b1", "iw*ih*10>6*aa", "dc"),
    _without("b3", "b2", "ta='text' AND tb='interline_equation' AND iw*ih*10>8*(aa+ab-iw*ih)", "b2"),
    "fn AS MATERIALIZED (SELECT * FROM dc WHERE (x1-x0)*3>612 AND y1-y0>10 AND y0*10>7*792)",
    _without("b4", "b3", "below>=0 AND iw*10>=8*aw", "fn"),
    "src AS (SELECT doc_id,page_idx,0 kind,block_id id,x0,y0,x1,y1,0 s FROM b4)", _grown("8")])


@query("J7_to_J11_block_conflicts", ["dets"], f"""
SELECT *,ROW_NUMBER() OVER (PARTITION BY doc_id,page_idx ORDER BY x0+y0,block_id) AS rank FROM ({GROWN}) z""", CONFLICTS)
def resolve(t):
    k = typed(t)
    kept, _, _ = B.resolve_blocks(k.where("type <> 'discarded'"), k.where("type = 'discarded'"), F.lit(612), F.lit(792))
    return kept


SPANS = """s AS (SELECT doc_id,page_idx,det_id span_id,x0+2 x0,y0+1 y0,x1+2 x1,y1+1 y1,(x1-x0)*(y1-y0) ar,
  CASE category_id WHEN 3 THEN 'image' WHEN 5 THEN 'table' WHEN 8 THEN 'interline_equation' WHEN 6 THEN 'inline_equation' ELSE 'text' END AS type FROM dets)"""
FIT = """fit AS (SELECT *,iw*ih inter FROM (SELECT s.doc_id,s.page_idx,s.span_id,k.block_id,s.type st,k.type kt,s.ar,
  LEAST(s.x1,k.x1)-GREATEST(s.x0,k.x0) iw,LEAST(s.y1,k.y1)-GREATEST(s.y0,k.y0) ih
  FROM s JOIN k ON s.doc_id=k.doc_id AND s.page_idx=k.page_idx) pp WHERE iw>=0 AND ih>=0)"""
COMPATIBLE = """((st IN ('text','inline_equation') AND kt IN ('text','title','image_caption','image_footnote','table_caption','table_footnote','discarded'))
  OR (st='interline_equation' AND kt IN ('interline_equation','text')) OR (st='image' AND kt='image_body') OR (st='table' AND kt='table_body'))"""


def page_spans(t):
    """F1 read as spans, moved a little against the blocks."""
    c = F.col("category_id")
    kind = F.when(c == 3, "image").when(c == 5, "table").when(c == 8, "interline_equation").when(c == 6, "inline_equation").otherwise("text")
    return scored(t).select("doc_id", "page_idx", F.col("det_id").alias("span_id"), kind.alias("type"), (F.col("x0") + 2).alias("x0"),
                            (F.col("y0") + 1).alias("y0"), (F.col("x1") + 2).alias("x1"), (F.col("y1") + 1).alias("y1"), "score")


@query("PF10_span_block_compatible", ["dets"], f"SELECT st,kt,{COMPATIBLE} fits,COUNT(*) n FROM fit GROUP BY 1,2,3", SPANS + "," + BLOCKS + "," + FIT)
def pf10(t):
    from ..operators.pairs import meeting_pairs
    st, kt = F.col("a.type"), F.col("b.type")
    pairs = meeting_pairs(page_spans(t).drop("score"), typed(t))
    return pairs.groupBy(st.alias("st"), kt.alias("kt"), B.span_fits(st, kt).alias("fits")).agg(F.count("*").alias("n"))


@query("J16_fill_spans_in_blocks", ["dets"], f"""
SELECT s.doc_id,s.page_idx,s.span_id,MIN(f.block_id) block_id FROM s LEFT JOIN fit f ON f.doc_id=s.doc_id AND f.page_idx=s.page_idx AND f.span_id=s.span_id
 AND inter*10>CASE WHEN st IN ('image','table') THEN 9 ELSE 5 END*f.ar AND {COMPATIBLE} GROUP BY 1,2,3""", SPANS + "," + BLOCKS + "," + FIT)
def j16(t):
    spans = page_spans(t)
    won = B.assign_spans(spans, typed(t))
    return spans.select("doc_id", "page_idx", "span_id").join(won, ["doc_id", "page_idx", "span_id"], "left")


@query("PF23_demote_display_formulas", ["dets"], """
SELECT kt block_type,CASE WHEN st='interline_equation' AND kt IN ('text','title','image_caption','image_footnote','table_caption','table_footnote','discarded')
 THEN 'inline_equation' ELSE st END AS type,COUNT(*) n FROM (SELECT *,CAST(1 AS INT) one FROM (SELECT doc_id,page_idx,det_id,
  CASE category_id WHEN 3 THEN 'image' WHEN 5 THEN 'table' WHEN 8 THEN 'interline_equation' WHEN 6 THEN 'inline_equation' ELSE 'text' END st,
  CASE det_id%3 WHEN 0 THEN 'text' WHEN 1 THEN 'interline_equation' ELSE 'title' END kt FROM dets) z) y GROUP BY 1,2""")
def pf23(t):
    k = F.col("span_id") % 3
    spans = page_spans(t).withColumn("block_type", F.when(k == 0, "text").when(k == 1, "interline_equation").otherwise("title"))
    return B.demote_display_formulas(spans).groupBy("block_type", "type").agg(F.count("*").alias("n"))


@query("AG5_vertical_blocks", ["dets"], """
SELECT doc_id,page_idx,category_id block_id,AVG(CASE WHEN h>2*w THEN 1.0 ELSE 0.0 END)>0.8 vertical FROM (
 SELECT doc_id,page_idx,category_id,x1-x0-40 w,y1-y0 h FROM dets) z WHERE w>0 GROUP BY 1,2,3
UNION ALL SELECT doc_id,page_idx,category_id,false FROM dets GROUP BY 1,2,3 HAVING MAX(x1-x0-40)<=0""", "")
def ag5(t):
    narrow = t.dets.withColumn("x1", F.col("x1") - 40).withColumnRenamed("category_id", "block_id")
    wide = narrow.where(F.col("x1") > F.col("x0"))
    flat = B.vertical_blocks(narrow).join(wide, ["doc_id", "page_idx", "block_id"], "left_anti")
    return B.vertical_blocks(wide).unionByName(flat)


@query("J21_images_that_are_text", ["dets"], """
SELECT i.doc_id,i.page_idx,i.block_id,COALESCE(SUM(f.ar)*4>MAX(i.ar),false) is_text FROM (SELECT * FROM k WHERE type='image_body') i
LEFT JOIN (SELECT * FROM fit WHERE st='text' AND inter*10>7*ar) f ON f.doc_id=i.doc_id AND f.page_idx=i.page_idx AND f.block_id=i.block_id GROUP BY 1,2,3""",
       SPANS + "," + BLOCKS + "," + FIT)
def j21(t):
    return B.images_that_are_text(typed(t).where("type = 'image_body'"), page_spans(t), F.lit(True)).select(*OUT, "is_text")


LISTS = """l AS (SELECT doc_id,page_idx,det_id block_id,x0-30 x0,y0-30 y0,x1+60 x1,y1+60 y1 FROM dets WHERE category_id=5),
tx AS (SELECT doc_id,page_idx,det_id block_id,CASE WHEN category_id=1 THEN 'text' ELSE 'ref_text' END AS type,x0,y0,x1,y1 FROM dets WHERE category_id IN (0,1)),
fl AS (SELECT x.doc_id,x.page_idx,x.block_id,MIN(x.type) AS type,MIN(l.block_id) list_id FROM tx x JOIN l ON x.doc_id=l.doc_id AND x.page_idx=l.page_idx
 AND x.x0<=l.x1 AND l.x0<=x.x1 AND x.y0<=l.y1 AND l.y0<=x.y1
 AND (LEAST(x.x1,l.x1)-GREATEST(x.x0,l.x0))*(LEAST(x.y1,l.y1)-GREATEST(x.y0,l.y0))*10>=8*(x.x1-x.x0)*(x.y1-x.y0) GROUP BY 1,2,3)"""


def _lists(t):
    d = t.dets.withColumnRenamed("det_id", "block_id")
    lists = d.where("category_id = 5").select(*OUT, (F.col("x0") - 30).alias("x0"), (F.col("y0") - 30).alias("y0"),
                                              (F.col("x1") + 60).alias("x1"), (F.col("y1") + 60).alias("y1"))
    texts = d.where("category_id in (0, 1)").withColumn("type", F.when(F.col("category_id") == 1, "text").otherwise("ref_text"))
    return texts, lists


@query("J22_fill_lists", ["dets"], "SELECT doc_id,page_idx,block_id,list_id FROM fl", LISTS)
def j22(t):
    return B.fill_lists(*_lists(t))


@query("AG9_list_sub_type", ["dets"], """
SELECT doc_id,page_idx,list_id,type sub_type FROM (SELECT *,ROW_NUMBER() OVER (PARTITION BY doc_id,page_idx,list_id ORDER BY n DESC,f) rn FROM (
 SELECT doc_id,page_idx,list_id,type,COUNT(*) n,MIN(block_id) f FROM fl GROUP BY 1,2,3,4) z) y WHERE rn=1""", LISTS)
def ag9(t):
    texts, lists = _lists(t)
    return B.list_sub_types(texts, B.fill_lists(texts, lists))


# ---- captions by index over F3

IDX = ["doc_id", "page_idx", "idx"]


def _by_index(kind):
    return f"""
part AS (SELECT * FROM blocks_idx WHERE type='{kind}'), body AS (SELECT * FROM blocks_idx WHERE type='{kind.split('_')[0]}_body'),
c AS (SELECT p.doc_id,p.page_idx,p.idx,b.idx bi,ABS(p.idx-b.idx)-(SELECT COUNT(*) FROM part o WHERE o.doc_id=p.doc_id AND o.page_idx=p.page_idx
   AND o.idx>LEAST(p.idx,b.idx) AND o.idx<GREATEST(p.idx,b.idx)) gap,
  SQRT(GREATEST(p.x0-b.x1,b.x0-p.x1,0)*GREATEST(p.x0-b.x1,b.x0-p.x1,0)+GREATEST(p.y0-b.y1,b.y0-p.y1,0)*GREATEST(p.y0-b.y1,b.y0-p.y1,0)) edge,
  SQRT((p.x0+p.x1-b.x0-b.x1)*(p.x0+p.x1-b.x0-b.x1)+(p.y0+p.y1-b.y0-b.y1)*(p.y0+p.y1-b.y0-b.y1)) center
  FROM part p JOIN body b ON p.doc_id=b.doc_id AND p.page_idx=b.page_idx),
m AS (SELECT *,MIN(gap) OVER w mg FROM c WINDOW w AS (PARTITION BY doc_id,page_idx,idx)),
e AS (SELECT *,MAX(edge) OVER w - MIN(edge) OVER w spread FROM m WHERE gap=mg WINDOW w AS (PARTITION BY doc_id,page_idx,idx)),
r AS (SELECT *,ROW_NUMBER() OVER (PARTITION BY doc_id,page_idx,idx ORDER BY CASE WHEN spread>2 THEN edge END,
  CASE WHEN spread>2 THEN 0 {"ELSE -bi" if kind == "table_caption" else "ELSE bi" if kind.endswith("footnote") else "ELSE center"} END, bi) rn FROM e),
{kind}_m AS (SELECT doc_id,page_idx,idx,bi body_idx FROM r WHERE rn=1)"""


def _match(t, kind):
    k = t.blocks_idx
    return B.match_by_index(k.where(F.col("type") == kind.split("_")[0] + "_body"), k.where(F.col("type") == kind), kind)


@query("J6_image_captions_by_index", ["blocks_idx"], "SELECT doc_id,page_idx,idx,body_idx FROM image_caption_m", _by_index("image_caption"))
def j6_image(t):
    return _match(t, "image_caption")


@query("J6_table_captions_by_index", ["blocks_idx"], "SELECT doc_id,page_idx,idx,body_idx FROM table_caption_m", _by_index("table_caption"))
def j6_table(t):
    return _match(t, "table_caption")


@query("J6_table_footnotes_by_index", ["blocks_idx"], "SELECT doc_id,page_idx,idx,body_idx FROM table_footnote_m", _by_index("table_footnote"))
def j6_foot(t):
    return _match(t, "table_footnote")


REHOMED = _by_index("table_footnote") + """,
h AS (SELECT doc_id,page_idx,idx,CASE WHEN idx<body_idx THEN (SELECT MAX(b.idx) FROM body b WHERE b.doc_id=f.doc_id AND b.page_idx=f.page_idx
  AND b.idx<=f.idx AND b.idx<>f.body_idx) ELSE body_idx END body_idx FROM table_footnote_m f)"""


@query("J23_misplaced_footnotes", ["blocks_idx"], "SELECT doc_id,page_idx,idx,body_idx FROM h", REHOMED)
def j23(t):
    return B.rehome_footnotes(_match(t, "table_footnote"), t.blocks_idx.where("type = 'table_body'"))


@query("W9_caption_contiguity", ["blocks_idx"], """
SELECT doc_id,page_idx,idx,body_idx,MAX(CASE WHEN p IS NULL OR idx=p-1 OR (idx=p-2 AND body_idx=p-1) THEN 0 ELSE 1 END)
 OVER (PARTITION BY doc_id,page_idx,body_idx ORDER BY idx DESC)=0 kept FROM (
 SELECT *,LAG(idx) OVER (PARTITION BY doc_id,page_idx,body_idx ORDER BY idx DESC) p FROM table_caption_m) z""", _by_index("table_caption"))
def w9_captions(t):
    return B.contiguous_parts(_match(t, "table_caption"), True)


@query("W9_footnote_contiguity", ["blocks_idx"], """
SELECT doc_id,page_idx,idx,body_idx,MAX(CASE WHEN p IS NULL OR idx=p+1 THEN 0 ELSE 1 END)
 OVER (PARTITION BY doc_id,page_idx,body_idx ORDER BY idx)=0 kept FROM (
 SELECT *,LAG(idx) OVER (PARTITION BY doc_id,page_idx,body_idx ORDER BY idx) p FROM h WHERE body_idx IS NOT NULL) z""", REHOMED)
def w9_footnotes(t):
    homes = B.rehome_footnotes(_match(t, "table_footnote"), t.blocks_idx.where("type = 'table_body'"))
    return B.contiguous_parts(homes.where(F.col("body_idx").isNotNull()), False)


# Image groups of F3 have no footnotes, so their groups need only J4, J6 and W9.
GROUPS = """
img AS (SELECT * FROM blocks_idx WHERE type IN ('image_body','image_caption')),
free AS (SELECT * FROM img e WHERE NOT EXISTS (SELECT 1 FROM img o WHERE o.doc_id=e.doc_id AND o.page_idx=e.page_idx AND o.idx<>e.idx AND o.type=e.type
 AND e.x0>=o.x0 AND e.y0>=o.y0 AND e.x1<=o.x1 AND e.y1<=o.y1)),""" + _by_index("image_caption").replace("FROM blocks_idx", "FROM free") + """,
kc AS (SELECT doc_id,page_idx,idx,body_idx FROM (SELECT *,MAX(CASE WHEN p IS NULL OR idx=p-1 OR (idx=p-2 AND body_idx=p-1) THEN 0 ELSE 1 END)
 OVER (PARTITION BY doc_id,page_idx,body_idx ORDER BY idx DESC) bad FROM (
 SELECT *,LAG(idx) OVER (PARTITION BY doc_id,page_idx,body_idx ORDER BY idx DESC) p FROM image_caption_m) z) y WHERE bad=0),
mem AS (SELECT doc_id,page_idx,idx,'body' part,idx body_idx FROM body UNION ALL SELECT doc_id,page_idx,idx,'caption',body_idx FROM kc)"""


@query("AG10_image_groups", ["blocks_idx"], """
SELECT m.doc_id,m.page_idx,m.body_idx,MAX(CASE WHEN part='body' THEN x0 END) x0,MAX(CASE WHEN part='body' THEN y1 END) y1,
 STRING_AGG(part||m.idx,',' ORDER BY m.idx) parts,QUANTILE_CONT(m.idx,0.5) AS index FROM mem m JOIN blocks_idx k ON k.doc_id=m.doc_id AND k.page_idx=m.page_idx AND k.idx=m.idx
GROUP BY 1,2,3""", GROUPS)
def ag10(t):
    groups = B.assemble_groups(B.two_layer_members(t.blocks_idx, "image"), t.blocks_idx)
    parts = F.array_join(F.transform("parts", lambda p: F.concat(p["part"], p["idx"].cast("string"))), ",")
    return groups.select("doc_id", "page_idx", "body_idx", F.col("body.x0").alias("x0"), F.col("body.y1").alias("y1"), parts.alias("parts"), "index")


@query("SE4_leftovers_to_text", ["blocks_idx"], """
SELECT doc_id,page_idx,idx,'text' AS type FROM img WHERE NOT EXISTS (SELECT 1 FROM mem m WHERE m.doc_id=img.doc_id AND m.page_idx=img.page_idx AND m.idx=img.idx)""", GROUPS)
def se4(t):
    return B.plain_leftovers(t.blocks_idx, B.two_layer_members(t.blocks_idx, "image"), "image").select(*IDX, "type")


@query("SE6_page_blocks_union", ["blocks_idx"], """
SELECT doc_id,page_idx,COUNT(*) n,STRING_AGG(type,',' ORDER BY idx) types FROM (
 SELECT doc_id,page_idx,idx,'image' AS type FROM body UNION ALL SELECT doc_id,page_idx,idx,'text' FROM img WHERE NOT EXISTS (SELECT 1 FROM mem m WHERE m.doc_id=img.doc_id AND m.page_idx=img.page_idx AND m.idx=img.idx)
 UNION ALL SELECT doc_id,page_idx,idx,'text' FROM blocks_idx WHERE type='text') z GROUP BY 1,2""", GROUPS)
def se6(t):
    members = B.two_layer_members(t.blocks_idx, "image")
    rows = members.where("part = 'body'").select(*IDX, F.lit("image").alias("type"))
    rows = rows.unionByName(B.plain_leftovers(t.blocks_idx, members, "image").select(*IDX, "type"))
    rows = rows.unionByName(t.blocks_idx.where("type = 'text'").select(*IDX, "type"))
    ordered = F.array_sort(F.collect_list(F.struct("idx", "type")))
    return rows.groupBy("doc_id", "page_idx").agg(F.count("*").alias("n"), F.array_join(ordered["type"], ",").alias("types"))
