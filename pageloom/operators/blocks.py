"""Blocks of a page: conflicts, footnotes, lists, captions by reading index, groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import geom as g
from ..session import materialize
from . import growth
from .detections import band_pairs
from .pairs import PAGE, meeting_pairs, only, without

A, B = g.box("a"), g.box("b")
BOX_COLS = ["x0", "y0", "x1", "y1"]


def _slim(blocks: DataFrame, *types: str) -> DataFrame:
    return blocks.where(F.col("type").isin(*types)).select(*PAGE, "block_id", *BOX_COLS)


def _side_ids(pairs: DataFrame, side: str, name: str = "block_id") -> DataFrame:
    return pairs.select(*(F.col(f"{side}.{k}").alias(k) for k in PAGE), F.col(f"{side}.{name}").alias(name))


BLOCK = [*PAGE, "block_id"]


def _titles_under_text(blocks: DataFrame) -> DataFrame:
    return meeting_pairs(_slim(blocks, "title"), _slim(blocks, "text"), g.iou(A, B) > 0.8, centred=True)


def _blocks_on_discarded(blocks: DataFrame, discarded: DataFrame) -> DataFrame:
    return meeting_pairs(blocks.select(*BLOCK, *BOX_COLS), discarded.select(*BLOCK, *BOX_COLS), g.overlap_of_first(A, B) > 0.6, centred=True)


def _text_under_equations(blocks: DataFrame) -> DataFrame:
    return meeting_pairs(_slim(blocks, "text"), _slim(blocks, "interline_equation"), g.iou(A, B) > 0.8, centred=True)


def drop_titles_under_text(blocks: DataFrame) -> DataFrame:
    """A title that coincides with a text block (IoU > 0.8) goes."""
    return without(blocks, _side_ids(_titles_under_text(blocks), "a"), BLOCK)


def drop_blocks_on_discarded(blocks: DataFrame, discarded: DataFrame) -> DataFrame:
    """A block lying by more than 0.6 on a discarded one goes."""
    return without(blocks, _side_ids(_blocks_on_discarded(blocks, discarded), "a"), BLOCK)


def drop_text_under_equations(blocks: DataFrame) -> DataFrame:
    """Text that coincides with a display equation goes."""
    return without(blocks, _side_ids(_text_under_equations(blocks), "a"), BLOCK)


def drop_conflicts(blocks: DataFrame, discarded: DataFrame) -> DataFrame:
    """J7, J8, J9 in turn, with the blocks shuffled once for all that go.

    J7 takes titles only and J8 looks at no other block, so of what they take only an equation or text under J8 matters to J9.
    """
    covered = materialize(_side_ids(_blocks_on_discarded(blocks, discarded), "a").distinct(), "covered")
    pairs = _text_under_equations(blocks)
    pairs = pairs.select(*(F.col(f"a.{k}").alias(k) for k in PAGE), F.col("a.block_id").alias("text_id"), F.col("b.block_id").alias("block_id"))
    under = without(pairs, covered, BLOCK).select(*PAGE, F.col("text_id").alias("block_id"))
    gone = _side_ids(_titles_under_text(blocks), "a").unionByName(covered).unionByName(under)
    return without(blocks, gone, BLOCK)


def page_footnotes(discarded: DataFrame, page_w: Column, page_h: Column) -> DataFrame:
    """PF8: wide discarded blocks low on the page."""
    b = g.box()
    return discarded.where((g.width(b) > page_w / 3) & (g.height(b) > 10) & (b.y0 > page_h * 0.7))


def split_under_footnotes(blocks: DataFrame, footnotes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J10, SE5: (blocks that stay, blocks under a footnote). 0.8 of the width must lie below it."""
    pairs = band_pairs(blocks.select(*BLOCK, *BOX_COLS), footnotes.select(*BLOCK, *BOX_COLS), "x", centred=True)
    under = _side_ids(pairs.where((A.y0 >= B.y1) & (g.x_projection_overlap(A, B) >= 0.8)), "a")
    return without(blocks, under, BLOCK), only(blocks, under, BLOCK)


def absorb_overlapping_blocks(blocks: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Of two blocks that overlap the larger takes both areas."""
    return growth.settled(blocks, "block_id", growth.absorbing(threshold), threshold, threshold).drop("_key")


def coarse_order(blocks: DataFrame) -> DataFrame:
    """SO1: rank by x0 + y0, input order on ties."""
    w = Window.partitionBy(*PAGE).orderBy(F.col("x0") + F.col("y0"), "block_id")
    return blocks.withColumn("rank", F.row_number().over(w))


def resolve_blocks(blocks: DataFrame, discarded: DataFrame, page_w: Column, page_h: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Block conflicts in order J7, J8, J9, J10, J11: (blocks ranked by SO1, discarded, footnotes).

    J10 and J11 read the blocks that are left several times, so these are written.
    """
    blocks = materialize(drop_conflicts(blocks, discarded), "blocks")
    footnotes = page_footnotes(discarded, page_w, page_h)
    blocks, under = split_under_footnotes(blocks, footnotes)
    discarded = absorb_overlapping_blocks(discarded.unionByName(under))
    return coarse_order(absorb_overlapping_blocks(blocks)), discarded, footnotes


def span_fits(span_type: Column, block_type: Column) -> Column:
    """PF10."""
    fits = F.lit(False)
    for kind, blocks in S.SPAN_FITS.items():
        fits = fits | ((span_type == kind) & block_type.isin(*blocks))
    return fits


def assign_spans(spans: DataFrame, blocks: DataFrame, share: float = 0.5) -> DataFrame:
    """(page, span_id, block_id): the first block by id that fits the span's type and covers more
    than ``share`` of it (0.9 for images and tables). Spans without a block are absent."""
    needed = F.when(F.col("a.type").isin("image", "table"), F.lit(0.9)).otherwise(F.lit(share))
    pairs = meeting_pairs(
        spans.select(*PAGE, "span_id", "type", *BOX_COLS), blocks.select(*BLOCK, "type", *BOX_COLS),
        (g.overlap_of_first(A, B) > needed) & span_fits(F.col("a.type"), F.col("b.type")), centred=share >= 0.5)
    return pairs.groupBy(*(F.col(f"a.{k}").alias(k) for k in PAGE), F.col("a.span_id").alias("span_id")).agg(
        F.min("b.block_id").alias("block_id"))


def demote_display_formulas(spans: DataFrame) -> DataFrame:
    """PF23: display formulas inside text-like blocks become inline ones."""
    inside = F.col("block_type").isin(*S.TEXT_LIKE_BLOCKS, "discarded")
    return spans.withColumn("type", F.when(inside & (F.col("type") == "interline_equation"), "inline_equation").otherwise(F.col("type")))


def vertical_blocks(spans: DataFrame) -> DataFrame:
    """AG5: blocks where more than 0.8 of the spans are over twice as high as wide; no width = not vertical."""
    b = g.box()
    tall = F.coalesce(F.try_divide(g.height(b).cast("double"), g.width(b).cast("double")) > 2, F.lit(False))
    return spans.groupBy(*BLOCK).agg((F.avg(tall.cast("double")) > 0.8).alias("vertical"))


def images_that_are_text(images: DataFrame, spans: DataFrame, ocr_on: Column) -> DataFrame:
    """Images without caption or footnote whose text spans (each > 0.7 inside) cover over a quarter.

    ``images`` holds only bodies without parts; adds ``is_text``.
    """
    text = spans.where(F.col("type") == "text").select(*PAGE, *BOX_COLS)
    pairs = meeting_pairs(text, images.select(*BLOCK, *BOX_COLS), g.overlap_of_first(A, B) > 0.7, centred=True)
    covered = pairs.groupBy(*(F.col(f"b.{k}").alias(k) for k in BLOCK)).agg(F.sum(g.area(A)).alias("covered"))
    share = F.try_divide(F.col("covered").cast("double"), g.area(g.box()).cast("double"))
    return images.join(covered, BLOCK, "left").withColumn("is_text", ocr_on & F.coalesce(share > 0.25, F.lit(False))).drop("covered")


def fill_lists(texts: DataFrame, lists: DataFrame) -> DataFrame:
    """(page, block_id, list_id): the first list that covers at least 0.8 of the text."""
    pairs = meeting_pairs(texts.select(*BLOCK, *BOX_COLS), lists.select(*BLOCK, *BOX_COLS), g.overlap_of_first(A, B) >= 0.8, centred=True)
    return pairs.groupBy(*(F.col(f"a.{k}").alias(k) for k in BLOCK)).agg(F.min("b.block_id").alias("list_id"))


def list_sub_types(texts: DataFrame, filled: DataFrame) -> DataFrame:
    """AG9: most frequent child type of each list, ties to the one seen first."""
    kinds = (
        texts.select(*BLOCK, "type").join(filled, BLOCK)
        .groupBy(*PAGE, "list_id", "type").agg(F.count("*").alias("n"), F.min("block_id").alias("first"))
    )
    best = F.max_by("type", F.struct("n", -F.col("first")))
    return kinds.groupBy(*PAGE, "list_id").agg(best.alias("sub_type"))


# ---- captions and footnotes by reading index


def match_by_index(bodies: DataFrame, parts: DataFrame, part_type: str) -> DataFrame:
    """(page, idx, body_idx) for each caption or footnote.

    The gap to a body is the index distance less the other parts strictly between. Beyond the
    neighbouring body on either side the gap only grows, so the candidates are the previous and the
    next body, found by two running windows instead of a join.
    """
    rows = bodies.select(*PAGE, "idx", *BOX_COLS, F.lit(True).alias("is_body")).unionByName(
        parts.select(*PAGE, "idx", *BOX_COLS, F.lit(False).alias("is_body")))
    up = Window.partitionBy(*PAGE).orderBy("idx")
    down = Window.partitionBy(*PAGE).orderBy(F.desc("idx"))
    rows = rows.withColumn("n", F.sum((~F.col("is_body")).cast("long")).over(up))
    body = F.when(F.col("is_body"), F.struct("idx", "n", *BOX_COLS))
    found = (
        rows.withColumn("prev", F.last(body, ignorenulls=True).over(up))
        .withColumn("next", F.last(body, ignorenulls=True).over(down))
        .where(~F.col("is_body"))
    )
    here = g.box()
    before, after = (g.Box(*(F.col(f"{side}.{c}") for c in BOX_COLS)) for side in ("prev", "next"))
    gap_before = F.col("idx") - F.col("prev.idx") - (F.col("n") - 1 - F.col("prev.n"))
    gap_after = F.col("next.idx") - F.col("idx") - (F.col("next.n") - F.col("n"))
    edge_before, edge_after = g.edge_distance(here, before), g.edge_distance(here, after)
    by_edge = F.abs(edge_before - edge_after) > 2
    if part_type == "table_caption":
        tie = F.lit(False)
    elif part_type.endswith("footnote"):
        tie = F.lit(True)
    else:
        tie = g.center_distance(here, before) <= g.center_distance(here, after)
    take_before = (
        F.when(F.col("next").isNull(), True).when(F.col("prev").isNull(), False)
        .when(gap_before != gap_after, gap_before < gap_after)
        .when(by_edge, edge_before < edge_after).otherwise(tie)
    )
    pick = F.when(take_before, F.col("prev.idx")).otherwise(F.col("next.idx")).alias("body_idx")
    return found.where(F.col("prev").isNotNull() | F.col("next").isNotNull()).select(*PAGE, "idx", pick)


def rehome_footnotes(matched: DataFrame, bodies: DataFrame) -> DataFrame:
    """A footnote before its body goes to the last body at or before it (as-of), or to none (null)."""
    rows = matched.select(*PAGE, "idx", "body_idx").unionByName(
        bodies.select(*PAGE, "idx", F.lit(None).cast("bigint").alias("body_idx")))
    up = Window.partitionBy(*PAGE).orderBy("idx")
    last_body = F.last(F.when(F.col("body_idx").isNull(), F.col("idx")), ignorenulls=True).over(up)
    late = F.col("idx") < F.col("body_idx")
    return (
        rows.withColumn("earlier", last_body).where(F.col("body_idx").isNotNull())
        .select(*PAGE, "idx", F.when(late, F.col("earlier")).otherwise(F.col("body_idx")).alias("body_idx"))
    )


def contiguous_parts(matched: DataFrame, captions: bool) -> DataFrame:
    """Adds ``kept``: parts up to the first index gap, going away from the body.

    Captions run downwards, and a gap that holds only the body does not count; footnotes run upwards.
    """
    order = F.desc("idx") if captions else F.asc("idx")
    w = Window.partitionBy(*PAGE, "body_idx").orderBy(order)
    before = F.lag("idx").over(w)
    if captions:
        broken = (F.col("idx") != before - 1) & ~((F.col("idx") + 2 == before) & (F.col("body_idx") == F.col("idx") + 1))
    else:
        broken = F.col("idx") != before + 1
    return (
        matched.withColumn("broken", F.coalesce(broken, F.lit(False)).cast("int"))
        .withColumn("kept", F.max("broken").over(w) == 0).drop("broken")
    )


def two_layer_members(blocks: DataFrame, kind: str) -> DataFrame:
    """(page, idx, part, body_idx) of every image, table or code group: J4, J6, J23, W9 in turn.

    Blocks of the kind that are absent from the result become plain text (SE4).
    """
    def of(part: str) -> DataFrame:
        rows = blocks.where(F.col("type") == f"{kind}_{part}").select(*PAGE, "idx", *BOX_COLS)
        held = meeting_pairs(rows, rows, (F.col("a.idx") != F.col("b.idx")) & g.contains(A, B))
        return without(rows, _side_ids(held, "a", "idx"), [*PAGE, "idx"])

    bodies = of("body")
    captions = match_by_index(bodies, of("caption"), f"{kind}_caption")
    footnotes = match_by_index(bodies, of("footnote"), f"{kind}_footnote")
    if kind in ("image", "table"):
        captions = contiguous_parts(captions, True).where("kept").drop("kept")
        footnotes = rehome_footnotes(footnotes, bodies).where(F.col("body_idx").isNotNull())
        footnotes = contiguous_parts(footnotes, False).where("kept").drop("kept")
    members = bodies.select(*PAGE, "idx", F.lit("body").alias("part"), F.col("idx").alias("body_idx"))
    for part, rows in (("caption", captions), ("footnote", footnotes)):
        members = members.unionByName(rows.select(*PAGE, "idx", F.lit(part).alias("part"), "body_idx"))
    return members


def plain_leftovers(blocks: DataFrame, members: DataFrame, kind: str) -> DataFrame:
    """SE4: blocks of the kind that joined no group, as text."""
    own = blocks.where(F.col("type").startswith(f"{kind}_"))
    return without(own, members, [*PAGE, "idx"]).withColumn("type", F.lit("text"))


def assemble_groups(members: DataFrame, blocks: DataFrame) -> DataFrame:
    """AG10: one row per group: body box, parts in order, median index."""
    rows = members.join(blocks.select(*PAGE, "idx", *BOX_COLS), [*PAGE, "idx"])
    body = F.max_by(F.struct(*BOX_COLS), F.when(F.col("part") == "body", 1).otherwise(0)).alias("body")
    parts = F.array_sort(F.collect_list(F.struct("idx", "part"))).alias("parts")
    return rows.groupBy(*PAGE, "body_idx").agg(body, parts, F.percentile("idx", 0.5).alias("index"))
