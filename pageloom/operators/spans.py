"""Spans and characters of a page: filters, assignment of characters, lines, intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geom as g
from ..functions import text as tx
from ..session import by_page, parts, share_pages
from . import settle, strips
from .pairs import PAGE, meeting_pairs, only, without

A, B = g.box("a"), g.box("b")
BOX_COLS = ["x0", "y0", "x1", "y1"]
SPAN = [*PAGE, "span_id"]
ALONE = ["interline_equation", "image", "table"]


def keep_spans_in_blocks(spans: DataFrame, blocks: DataFrame, discarded: DataFrame) -> DataFrame:
    """Spans more than 0.4 on a discarded block, or more than 0.5 on a block of their sort."""
    sort = F.when(F.col("type").isin("image_body", "table_body"), F.col("type")).otherwise("other")
    targets = blocks.select(*PAGE, *BOX_COLS, sort.alias("sort")).unionByName(
        discarded.select(*PAGE, *BOX_COLS, F.lit("discarded").alias("sort")))
    own = F.when(F.col("a.type") == "image", "image_body").when(F.col("a.type") == "table", "table_body").otherwise("other")
    share = g.overlap_of_first(A, B)
    fits = ((F.col("b.sort") == "discarded") & (share > 0.4)) | ((F.col("b.sort") == own) & (share > 0.5))
    pairs = meeting_pairs(spans.select(*SPAN, "type", *BOX_COLS), targets, fits)
    return only(spans, pairs.select(*(F.col(f"a.{k}").alias(k) for k in SPAN)), SPAN)


def _settled(spans: DataFrame, conflict: Column, first_loses: Column, centred: bool = False) -> DataFrame:
    slim = spans.select(*SPAN, *BOX_COLS, "score")
    pairs = meeting_pairs(slim, slim, (F.col("a.span_id") < F.col("b.span_id")) & conflict, centred=centred)
    edges = settle.conflict_edges(pairs, F.col("a.span_id"), F.col("b.span_id"), first_loses)
    return without(spans, settle.eliminate(edges).withColumnRenamed("loser", "span_id"), SPAN)


def drop_low_score_overlaps(spans: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Ordered elimination by IoU; the lower score goes, ties the second."""
    return _settled(spans, g.iou(A, B) > threshold, F.col("a.score") < F.col("b.score"), centred=threshold > 0.5)


def drop_smaller_overlaps(spans: DataFrame, threshold: float = 0.65) -> DataFrame:
    """Ordered elimination by overlap of the smaller; the smaller goes, ties the first."""
    return _settled(spans, g.overlap_of_smaller(A, B) > threshold, g.first_is_smaller(A, B))


def page_median_height(spans: DataFrame) -> DataFrame:
    """AG3: median height of the text spans of a page."""
    return spans.where(F.col("type") == "text").groupBy(*PAGE).agg(F.percentile(F.col("y1") - F.col("y0"), 0.5).alias("median_height"))


def upright_lines(lines: DataFrame, radians: Column) -> DataFrame:
    """PF11: lines within 0.1 degree of 0, 90, 180 or 270."""
    turned = F.degrees(radians)
    return lines.where(F.least(*(F.abs(turned - angle) for angle in (0, 90, 180, 270))) < 0.1)


def mark_vertical(spans: DataFrame) -> DataFrame:
    """PF12: text spans over 2.3 times the page's median height and their own width."""
    b = g.box()
    tall = (F.col("type") == "text") & (g.height(b) > F.col("median_height") * 2.3) & (g.height(b) > g.width(b) * 2.3)
    return spans.join(page_median_height(spans), PAGE, "left").withColumn("vertical", F.coalesce(tall, F.lit(False))).drop("median_height")


def fill_vertical_spans(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """(page, span_id, content): texts of the lines that lie by more than half in a vertical span,
    each line in the first such span, in line order."""
    pairs = meeting_pairs(lines.select(*PAGE, "line_id", "text", *BOX_COLS), spans.select(*SPAN, *BOX_COLS), g.overlap_of_first(A, B) > 0.5)
    home = pairs.groupBy(*(F.col(f"a.{k}").alias(k) for k in PAGE), F.col("a.line_id").alias("line_id")).agg(
        F.min("b.span_id").alias("span_id"), F.first("a.text").alias("text"))
    ordered = F.array_sort(F.collect_list(F.struct("line_id", "text")))
    return home.groupBy(*SPAN).agg(F.array_join(ordered["text"], "").alias("content"))


SPAN_ORD = [*PAGE, "ord"]


def rank_spans(spans: DataFrame) -> DataFrame:
    """Adds ``ord``, the place of a span by (top edge, id) on its page."""
    return spans.withColumn("ord", F.row_number().over(Window.partitionBy(*PAGE).orderBy("y0", "span_id")))


def fill_chars(chars: DataFrame, ranked: DataFrame, ids: list[str] = []) -> DataFrame:
    """Each character with the topmost span that takes it, as ``ord`` of :func:`rank_spans` and its whole-number ``ids``; others are absent.

    Characters are shuffled in strips (:mod:`strips`), and the choice needs no second shuffle.
    """
    return strips.first_spans(chars, ranked, ["char_id", "i", "x0", "x1"], ids)


def span_texts(chars: DataFrame, ranked: DataFrame, ids: list[str] = []) -> DataFrame:
    """J17, W19, AG4: (page, ord, whole-number ``ids``, content, median_width): text of each span of the characters that it takes, with a blank where the gap to
    the next character exceeds a quarter of the median width and neither is a blank; then control marks, ligatures and end blanks."""
    pieces = strips.span_pieces(chars, ranked, ids)
    return pieces.select(*SPAN_ORD, *ids, tx.strip(tx.expand_ligatures(tx.drop_control_marks(F.col("raw")))).alias("content"), "median_width")


def needs_late_recognition(content: Column, b: g.Box) -> Column:
    """Text too short for the span: length times height under half the width."""
    return F.length(content) * g.height(b) < g.width(b) * 0.5


# Blocks that give no text to the spans in them.
NO_TEXT = ["image_body", "table_body", "interline_equation"]


def fill_text_layer(spans: DataFrame, chars: DataFrame, lines: DataFrame, blocks: DataFrame, discarded: DataFrame) -> DataFrame:
    """Text spans with the text of the page's own characters (J17, W19) or, if they stand upright (PF12), of its lines.

    ``chars``: page, char_id, ``i`` (place on the page), ch, box; ``lines``: page, line_id, text, box. Where either has ``rotation``
    (radians, of the line), skewed ones take no part (PF11). Only spans that lie by more than half in a block of text are filled;
    all others pass as they are. Upright spans that no line fills are dropped. Spans with too little text get none and ``late``,
    for a recogniser.
    """
    chars, lines = (upright_lines(df, F.col("rotation")) if "rotation" in df.columns else df for df in (chars, lines))
    spark = spans.sparkSession
    share_pages(spark)
    # Dealt by page once, without what else they hold; heights, homes and ranks are then found where the spans lie.
    text = mark_vertical(by_page(spans.where("type = 'text'").select(*SPAN, "type", *BOX_COLS, "score"), "spans"))
    targets = blocks.select(*PAGE, "type", *BOX_COLS).unionByName(discarded.select(*PAGE, "type", *BOX_COLS)).where(~F.col("type").isin(NO_TEXT))
    pairs = meeting_pairs(text.select(*SPAN, *BOX_COLS), targets.drop("type"), g.overlap_of_first(A, B) > 0.5, centred=True)
    homed = pairs.select(*(F.col(f"a.{k}").alias(k) for k in SPAN)).repartition(parts(spark), *PAGE).distinct().withColumn("homed", F.lit(True))
    # Written, as the ranks are read by the search for characters, by the lines and by the result.
    text = by_page(rank_spans(text.join(homed, SPAN, "left")), "text-spans")
    flat, tall = text.where("homed and not vertical"), text.where("homed and vertical")
    filled = span_texts(chars, flat).select(*SPAN_ORD, F.col("content").alias("filled"))
    found = F.coalesce("filled", F.lit(""))
    late = needs_late_recognition(found, g.box())
    flat = flat.join(filled, SPAN_ORD, "left").withColumn("late", late).withColumns({
        "content": F.when(F.col("late"), "").otherwise(found), "score": F.when(F.col("late"), 1.0).otherwise(F.col("score"))})
    tall = tall.join(fill_vertical_spans(lines, tall).where("content <> ''"), SPAN).withColumn("late", F.lit(False))
    done = flat.drop("filled").unionByName(tall)
    if carried := [c for c in spans.columns if c not in done.columns]:
        done = done.join(spans.where("type = 'text'").select(*SPAN, *carried), SPAN)
    out = done.select(*spans.columns, "late")
    for rest in (spans.join(text.where("homed is null").select(*SPAN), SPAN, "left_semi"), spans.where("type <> 'text'")):
        out = out.unionByName(rest.select(*spans.columns, F.lit(False).alias("late")))
    return out


def apply_recognition(spans: DataFrame, found: DataFrame, least: float = 0.5) -> DataFrame:
    """``late`` spans with the recognised text of ``found`` (page, span_id, text, score) if its score is above ``least``; else they
    stay empty with score 0."""
    late = spans.where("late").drop("content", "score").join(found.select(*SPAN, "text", F.col("score").alias("sure")), SPAN, "left")
    sure = F.coalesce(F.col("sure") > least, F.lit(False)) & F.col("text").isNotNull()
    late = late.withColumns({"content": F.when(sure, F.col("text")).otherwise(""), "score": F.when(sure, F.round("sure", 3)).otherwise(0.0)})
    return spans.where(~F.col("late")).unionByName(late.select(*spans.columns))


# ---- lines


def spans_to_lines(spans: DataFrame, keys: list[str], order: str = "span_id", vertical: bool = False,
                   threshold: float = 0.6, type_col: str | None = "type") -> DataFrame:
    """Adds ``line_no`` and ``pos`` (place in the line).

    Sorted by top edge (vertical: by right edge from the right), a span opens a line unless it shares
    more than ``threshold`` of the shorter extent with the span before it; formulas on display, images
    and tables stand alone. The open line's last span is always the previous span, so ``lag`` is exact.
    """
    first = F.desc("x1") if vertical else F.asc("y0")
    w = Window.partitionBy(*keys).orderBy(first, order)
    here = g.box()
    before = g.Box(*(F.lag(c).over(w) for c in BOX_COLS))
    meets = g.x_overlaps(here, before, threshold) if vertical else g.y_overlaps(here, before, threshold)
    if type_col:
        alone = F.col(type_col).isin(ALONE)
        meets = meets & ~alone & ~F.lag(alone).over(w)
    flagged = spans.withColumn("opens", F.when(F.coalesce(meets, F.lit(False)), 0).otherwise(1))
    numbered = flagged.withColumn("line_no", F.sum("opens").over(w)).drop("opens")
    inner = Window.partitionBy(*keys, "line_no").orderBy(*((F.asc("y0"), F.desc("x1")) if vertical else (F.asc("x0"), F.asc("y0"))), order)
    return numbered.withColumn("pos", F.row_number().over(inner))


def bounds(df: DataFrame, keys: list[str]) -> DataFrame:
    """AG6: union box of the rows of each key."""
    return df.groupBy(*keys).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def merge_on_line(boxes: DataFrame, keys: list[str], order: str = "span_id") -> DataFrame:
    """Boxes of a line whose x ranges meet, joined into one; ``part`` numbers them from the left."""
    w = Window.partitionBy(*keys).orderBy("x0", order)
    reach = F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = boxes.withColumn("opens", F.when(reach >= F.col("x0"), 0).otherwise(1))
    return bounds(flagged.withColumn("part", F.sum("opens").over(w)), [*keys, "part"])


def merge_detected_boxes(boxes: DataFrame, order: str = "span_id") -> DataFrame:
    """Boxes by line; lines over four times as wide as high have meeting boxes joined; skewed boxes pass."""
    straight = spans_to_lines(boxes.where(~F.col("skewed")), PAGE, order, type_col=None)
    line = Window.partitionBy(*PAGE, "line_no")
    long = (F.max("x1").over(line) - F.min("x0").over(line)) > (F.max("y1").over(line) - F.min("y0").over(line)) * 4
    straight = straight.withColumn("long", long)
    joined = merge_on_line(straight.where("long"), [*PAGE, "line_no"], order).select(*PAGE, *BOX_COLS)
    rest = straight.where(~F.col("long")).select(*PAGE, *BOX_COLS)
    return joined.unionByName(rest).unionByName(boxes.where("skewed").select(*PAGE, *BOX_COLS))


def merge_intervals(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Intervals [lo, hi] of a key that meet, joined."""
    w = Window.partitionBy(*keys).orderBy("lo", "hi")
    reach = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = intervals.withColumn("opens", F.when(reach >= F.col("lo"), 0).otherwise(1))
    return flagged.withColumn("run", F.sum("opens").over(w)).groupBy(*keys, "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("run")


def subtract_intervals(ranges: DataFrame, masks: DataFrame, keys: list[str]) -> DataFrame:
    """What is left of each range [start, end] after its masks, bounds inclusive (cut edges move by one)."""
    merged = merge_intervals(masks, keys)
    on = [F.col(f"r.{k}") == F.col(f"m.{k}") for k in keys] + [F.col("lo") <= F.col("end"), F.col("hi") >= F.col("start")]
    hits = ranges.select(*keys, "start", "end").alias("r").join(merged.alias("m"), on, "left").select(*(F.col(f"r.{k}").alias(k) for k in keys), "start", "end", "lo", "hi")
    # One pass: each mask gives what lies before it, the last one also what is left behind it; a range without masks stays whole.
    w = Window.partitionBy(*keys).orderBy("lo")
    opened = F.coalesce(F.lag("hi").over(w) + 1, F.col("start"))
    before = F.struct(opened.alias("lo"), (F.col("lo") - 1).alias("hi"))
    behind = F.struct(F.coalesce(F.col("hi") + 1, F.col("start")).alias("lo"), F.col("end").alias("hi"))
    parts = hits.withColumns({"before": before, "behind": F.when(F.lead(F.lit(True)).over(w).isNull(), behind)})
    left = parts.select(*keys, F.explode(F.array("before", "behind")).alias("p"))
    return left.select(*keys, "p.lo", "p.hi").where(F.col("lo") <= F.col("hi"))


def cut_text_at_formulas(text: DataFrame, formulas: DataFrame) -> DataFrame:
    """Text boxes less the x ranges of formulas on their row (y overlap > 0.8); skewed boxes pass."""
    straight = text.where(~F.col("skewed"))
    pairs = meeting_pairs(straight.select(*SPAN, *BOX_COLS), formulas.select(*PAGE, *BOX_COLS), g.y_overlaps(A, B))
    masks = pairs.select(*(F.col(f"a.{k}").alias(k) for k in SPAN), F.col("b.x0").alias("lo"), F.col("b.x1").alias("hi"))
    ranges = straight.select(*SPAN, F.col("x0").alias("start"), F.col("x1").alias("end"))
    cut = subtract_intervals(ranges, masks, SPAN).join(straight.select(*SPAN, "y0", "y1"), SPAN)
    return cut.select(*SPAN, F.col("lo").alias("x0"), "y0", F.col("hi").alias("x1"), "y1").unionByName(
        text.where("skewed").select(*SPAN, *BOX_COLS))


def distinct_by_value(spans: DataFrame) -> DataFrame:
    """SE1 for content spans: of spans alike in type, box, score and content the first stays."""
    alike = [*BOX_COLS, "type", "score", "content", "html"]
    # one pass: with a join the texts would be dealt and ordered twice
    first = F.min("span_id").over(Window.partitionBy(*PAGE, *alike))
    return spans.withColumn("_first", first).where(F.col("span_id") == F.col("_first")).drop("_first")
