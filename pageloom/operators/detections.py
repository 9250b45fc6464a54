"""Detections of a page: coordinates, confidence filters, de-duplication, caption matching."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import geom as g
from . import growth, settle
from .pairs import PAGE, meeting_pairs, without

A, B = g.box("a"), g.box("b")
ID = [*PAGE, "det_id"]
BOX_COLS = ["x0", "y0", "x1", "y1"]
PAIRS = "array<struct<body_id:bigint,part_id:bigint>>"

LAYOUT_CATEGORIES = [
    S.TITLE, S.TEXT, S.IMAGE_BODY, S.IMAGE_CAPTION, S.TABLE_BODY, S.TABLE_CAPTION, S.TABLE_FOOTNOTE,
    S.EQUATION_LAYOUT, S.EQUATION_NUMBER,
]


def truncate(value: Column) -> Column:
    """Towards zero."""
    return value.cast("bigint")


def _ids(side: str, name: str = "det_id") -> list[Column]:
    return [F.col(f"{side}.{k}").alias(k) for k in PAGE] + [F.col(f"{side}.{name}").alias(name)]


# ---- projections and filters


def poly_to_page_box(dets: DataFrame, scale: float) -> DataFrame:
    """PF1: corners 1 and 3 of the polygon in page points; boxes without extent go."""
    corners = {"x0": 0, "y0": 1, "x1": 4, "y1": 5}
    boxes = dets.withColumns({c: truncate(F.col("poly")[i] / F.lit(float(scale))) for c, i in corners.items()})
    return boxes.where((F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0"))).drop("poly")


def unit_to_page_box(blocks: DataFrame, page_w: Column, page_h: Column) -> DataFrame:
    """PF2: 0..1 box in page points, corners put in order."""
    ax, bx = truncate(F.col("x0") * page_w), truncate(F.col("x1") * page_w)
    ay, by = truncate(F.col("y0") * page_h), truncate(F.col("y1") * page_h)
    return blocks.withColumns({"x0": F.least(ax, bx), "y0": F.least(ay, by), "x1": F.greatest(ax, bx), "y1": F.greatest(ay, by)})


def poly_to_unit_box(dets: DataFrame, page_w: Column, page_h: Column) -> DataFrame:
    """PF3: polygon in 0..1, clamped, three decimals."""
    def unit(i: int, size: Column) -> Column:
        return g.round_exact(F.least(F.greatest(F.col("poly")[i] / size, F.lit(0.0)), F.lit(1.0)), 3)

    return dets.withColumns({"x0": unit(0, page_w), "y0": unit(1, page_h), "x1": unit(4, page_w), "y1": unit(5, page_h)}).drop("poly")


def per_mille_box(df: DataFrame, page_w: Column, page_h: Column) -> DataFrame:
    """PF4: page points in 0..1000."""
    sizes = {"x0": page_w, "y0": page_h, "x1": page_w, "y1": page_h}
    return df.withColumns({c: truncate(F.col(c) * 1000 / size) for c, size in sizes.items()})


def drop_low_confidence(dets: DataFrame, least: float = 0.05) -> DataFrame:
    """PF5."""
    return dets.where(F.col("score") > least)


def grade_recognised_text(dets: DataFrame) -> DataFrame:
    """PF6: boxes under 3 wide go; weak text and known noise on upright thin boxes become low-score text."""
    noise = F.col("text").isin(S.NOISE_TEXTS) & (F.col("score") < 0.8) & (g.width(g.box()) < g.height(g.box()))
    return dets.where(g.width(g.box()) >= 3).withColumn(
        "category_id", F.when((F.col("score") < 0.5) | noise, S.LOW_SCORE_TEXT).otherwise(F.col("category_id")))


def accept_late_text(spans: DataFrame) -> DataFrame:
    """PF7: text recognised late is kept above 0.5, else blanked with score 0."""
    good = F.col("score") > 0.5
    return spans.withColumns({
        "content": F.when(good, F.col("content")).otherwise(F.lit("")),
        "score": F.when(good, g.round_exact(F.col("score"), 3)).otherwise(F.lit(0.0)),
    })


def with_types(dets: DataFrame) -> DataFrame:
    """PF9: block and span type of each detection, from the code table."""
    types = dets.sparkSession.createDataFrame(
        [(k, b, s) for k, (b, s) in S.CATEGORY_TYPES.items()], "category_id bigint, block_type string, span_type string")
    return dets.join(F.broadcast(types), "category_id", "left")


def with_model_types(blocks: DataFrame) -> DataFrame:
    """PF9 for language-model blocks; blocks of unknown type go."""
    types = blocks.sparkSession.createDataFrame(
        [(k, b, s) for k, (b, s) in S.MODEL_BLOCK_TYPES.items()], "type string, block_type string, span_type string")
    return blocks.join(F.broadcast(types), "type")


def into_crop(formulas: DataFrame, crop: g.Box, paste: int, crop_w: Column, crop_h: Column) -> DataFrame:
    """PF13: formula boxes in the frame of a pasted crop; those outside it go."""
    moved = formulas.withColumns({
        "x0": F.col("x0") - crop.x0 + paste, "y0": F.col("y0") - crop.y0 + paste,
        "x1": F.col("x1") - crop.x0 + paste, "y1": F.col("y1") - crop.y0 + paste})
    return moved.where((F.col("x1") >= 0) & (F.col("y1") >= 0) & (F.col("x0") <= crop_w) & (F.col("y0") <= crop_h))


def out_of_crop(boxes: DataFrame, crop: g.Box, paste: int) -> DataFrame:
    """PF13: back to the frame of the page."""
    return boxes.withColumns({
        "x0": F.col("x0") - paste + crop.x0, "y0": F.col("y0") - paste + crop.y0,
        "x1": F.col("x1") - paste + crop.x0, "y1": F.col("y1") - paste + crop.y0})


def _corner(points: Column, i: int, axis: str) -> Column:
    return points[i][axis]


def is_skewed(points: Column) -> Column:
    """PF14: the diagonal's rise differs from the mean side height by more than a fifth."""
    rise = _corner(points, 2, "y") - _corner(points, 0, "y")
    mean = ((_corner(points, 3, "y") - _corner(points, 0, "y")) + (_corner(points, 2, "y") - _corner(points, 1, "y"))) / 2.0
    return ~((rise >= mean * 0.8) & (rise <= mean * 1.2))


def squared_up(points: Column) -> Column:
    """PF14: upright box of the same width and mean height around the centre."""
    cx = sum((_corner(points, i, "x") for i in range(1, 4)), _corner(points, 0, "x")) / 4.0
    cy = sum((_corner(points, i, "y") for i in range(1, 4)), _corner(points, 0, "y")) / 4.0
    h = ((_corner(points, 3, "y") - _corner(points, 0, "y")) + (_corner(points, 2, "y") - _corner(points, 1, "y"))) / 2.0
    w = _corner(points, 2, "x") - _corner(points, 0, "x")
    return box_to_points(g.Box(cx - w / 2.0, cy - h / 2.0, cx + w / 2.0, cy + h / 2.0))


def box_to_points(b: g.Box) -> Column:
    """PF15: four corners, clockwise from the top left."""
    def pt(x, y):
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    return F.array(pt(b.x0, b.y0), pt(b.x1, b.y0), pt(b.x1, b.y1), pt(b.x0, b.y1))


def points_to_box(points: Column) -> g.Box:
    """PF15: bounds of any number of corners."""
    xs, ys = points["x"], points["y"]
    return g.Box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed a single time, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def clockwise(points: Column) -> Column:
    """PF26: top left, top right, bottom right, bottom left."""
    def upper(p, q):
        return F.when(p["y"] <= q["y"], p).otherwise(q)

    def lower(p, q):
        return F.when(p["y"] <= q["y"], q).otherwise(p)

    def dealt(by_x):
        l0, l1, r0, r1 = (by_x[i] for i in range(4))
        return F.array(upper(l0, l1), upper(r0, r1), lower(r0, r1), lower(l0, l1))

    return _once(F.array_sort(points), dealt)


def clip_and_filter_points(df: DataFrame, img_w: Column, img_h: Column) -> DataFrame:
    """PF26: corners ordered and clipped to the image; sides of 3 or less go."""
    def clip(v: Column, size: Column) -> Column:
        return truncate(F.least(F.greatest(v, F.lit(0.0)), (size - 1).cast("double"))).cast("double")

    inside = F.transform(clockwise(F.col("points")), lambda p: F.struct(clip(p["x"], img_w).alias("x"), clip(p["y"], img_h).alias("y")))

    def long_sides(points: Column) -> Column:
        def side(i: int, j: int) -> Column:
            p, q = points[i], points[j]
            return F.floor(F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"])))

        return (side(0, 1) > 3) & (side(0, 3) > 3)

    return df.withColumn("points", inside).where(_once(F.col("points"), long_sides))


def padded_bounds(points: Column, img_w: Column, img_h: Column) -> g.Box:
    """PF27: bounds widened by one pixel, within the image."""
    b = points_to_box(points)
    return g.Box(F.greatest(b.x0 - 1, F.lit(0.0)), F.greatest(b.y0 - 1, F.lit(0.0)),
                 F.least(b.x1 + 1, img_w.cast("double")), F.least(b.y1 + 1, img_h.cast("double")))


def rescale_structure_boxes(df: DataFrame, img_w: Column, img_h: Column, canvas: int = 488) -> DataFrame:
    """PF27: cell boxes predicted on a padded square canvas, back in the proportions of the image."""
    ratio = F.least(canvas / img_h, canvas / img_w)
    fx, fy = canvas / (img_w * ratio), canvas / (img_h * ratio)
    return df.withColumns({"x0": F.col("x0") * fx, "x1": F.col("x1") * fx, "y0": F.col("y0") * fy, "y1": F.col("y1") * fy})


def size_bucket(size: Column, stride: int = 64) -> Column:
    """PF19: rounded up to a multiple of the stride."""
    return F.ceil(size / stride) * stride


def orientation_bucket(size: Column, stride: int = 128) -> Column:
    """PF19, orientation form: the next multiple above, also for exact multiples."""
    return (F.floor(size / stride) + 1) * stride


def layout_grid_box(df: DataFrame, page_w: Column, page_h: Column) -> DataFrame:
    """PF20: boxes clamped to the page on the side where they leave it, in 0..1000, half to even."""
    def scaled(v: Column, size: Column) -> Column:
        return F.bround(v * (F.lit(1000.0) / size)).cast("bigint")

    out = df.withColumns({
        "x0": scaled(F.greatest("x0", F.lit(0)), page_w), "y0": scaled(F.greatest("y0", F.lit(0)), page_h),
        "x1": scaled(F.least("x1", page_w), page_w), "y1": scaled(F.least("y1", page_h), page_h)})
    valid = F.lit(True)
    for lo, hi in (("x0", "x1"), ("y0", "y1")):
        valid = valid & (F.col(lo) >= 0) & (F.col(hi) >= F.col(lo)) & (F.col(hi) <= 1000)
    return out.withColumn("valid", valid)


# ---- pair rules


def drop_high_iou(dets: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Of any two layout boxes above the IoU, the lower score goes (equal: the later one).

    Every pair is judged on the input, so the losers are one set and no order is needed.
    """
    layout = dets.where(F.col("category_id").isin(LAYOUT_CATEGORIES)).select(*ID, *BOX_COLS, "score")
    pairs = meeting_pairs(layout, layout, (F.col("a.det_id") < F.col("b.det_id")) & (g.iou(A, B) > threshold), centred=threshold > 0.5)
    loser = F.when(F.col("a.score") < F.col("b.score"), F.col("a.det_id")).otherwise(F.col("b.det_id"))
    return without(dets, pairs.select(*(F.col(f"a.{k}").alias(k) for k in PAGE), loser.alias("det_id")), ID)


def absorb_overlapping_bodies(dets: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Image bodies among themselves and table bodies among themselves; of two that overlap the larger takes both areas."""
    body = F.col("category_id").isin(S.IMAGE_BODY, S.TABLE_BODY)
    grown = growth.settled(dets.where(body), "det_id", growth.absorbing(threshold), threshold, threshold, [*PAGE, "category_id"])
    return dets.where(~body).unionByName(grown.drop("_key"))


def band_pairs(left: DataFrame, right: DataFrame, axis: str, size: int = 64, centred: bool = False) -> DataFrame:
    """Pairs of a page whose ranges on one axis meet, joined by band of that axis, each once; with ``centred`` at least those where
    the right range holds the centre of the left one, which is then in one band only."""
    lo, hi = f"{axis}0", f"{axis}1"

    def banded(df: DataFrame, name: str) -> DataFrame:
        first = F.floor(F.col(lo) / size)
        return df.withColumn("band", F.explode(F.sequence(first, F.greatest(first, F.floor(F.col(hi) / size))))).alias(name)

    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in (*PAGE, "band")]
    on += [F.col(f"a.{lo}") <= F.col(f"b.{hi}"), F.col(f"b.{lo}") <= F.col(f"a.{hi}")]
    if centred:
        return left.withColumn("band", F.floor((F.col(lo) + F.col(hi)) / 2.0 / size)).alias("a").join(banded(right, "b"), on)
    on.append(F.col("a.band") == F.floor(F.greatest(F.col(f"a.{lo}"), F.col(f"b.{lo}")) / size))
    return banded(left, "a").join(banded(right, "b"), on)


def retype_footnotes(dets: DataFrame) -> DataFrame:
    """A table footnote nearer to a figure than to any table becomes an image footnote.

    Only bodies beside, above or below count, i.e. those sharing a row or column band with the
    footnote; a footnote more than 30 % longer than the body along the shared side counts as infinitely far.
    """
    notes = dets.where(F.col("category_id") == S.TABLE_FOOTNOTE).select(*ID, *BOX_COLS)
    bodies = dets.where(F.col("category_id").isin(S.IMAGE_BODY, S.TABLE_BODY)).select(*ID, "category_id", *BOX_COLS)
    side = g.relative_position(B, A)
    beside = side.left | side.right
    body_len = F.when(beside, g.height(B)).otherwise(g.width(B))
    note_len = F.when(beside, g.height(A)).otherwise(g.width(A))
    mismatch = (note_len > body_len) & ((note_len - body_len) / body_len > 0.3)
    dist = F.when(mismatch, F.lit(float("inf"))).otherwise(g.edge_distance(A, B))
    near = None
    for axis in ("x", "y"):
        found = band_pairs(notes, bodies, axis).select(*_ids("a"), F.col("b.category_id").alias("body"), dist.alias("dist"))
        near = found if near is None else near.unionByName(found)
    best = near.groupBy(*ID).agg(
        F.min(F.when(F.col("body") == S.IMAGE_BODY, F.col("dist"))).alias("to_figure"),
        F.min(F.when(F.col("body") == S.TABLE_BODY, F.col("dist"))).alias("to_table"))
    figure_wins = best.where(F.coalesce("to_table", F.lit(float("inf"))) > F.col("to_figure")).select(*ID, F.lit(True).alias("figure"))
    return (
        dets.join(figure_wins, ID, "left")
        .withColumn("category_id", F.when(F.col("figure"), F.lit(S.IMAGE_FOOTNOTE)).otherwise(F.col("category_id")))
        .drop("figure")
    )


def drop_contained(boxes: DataFrame, extra_keys: list[str] = ()) -> DataFrame:
    """Any box inside another one of its kind goes; equal boxes remove each other."""
    same = F.lit(True)
    for k in extra_keys:
        same = same & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    slim = boxes.select(*ID, *extra_keys, *BOX_COLS)
    pairs = meeting_pairs(slim, slim, same & (F.col("a.det_id") != F.col("b.det_id")) & g.contains(A, B))
    return without(boxes, pairs.select(*_ids("a")), ID)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _gap2(a: Column, b: Column) -> Column:
    """Squared distance of two boxes."""
    dx = F.greatest(a.x0 - b.x1, b.x0 - a.x1, F.lit(0))
    dy = F.greatest(a.y0 - b.y1, b.y0 - a.y1, F.lit(0))
    return dx * dx + dy * dy


def match_captions(dets: DataFrame, body_category: int, part_category: int) -> DataFrame:
    """(page, body_id, part_id) of captions or footnotes to bodies, by distance; bodies without parts have a null part.

    A step starts from the free box nearest the top-left corner of all free boxes and takes its nearest free partner of the other kind,
    unless that is three times as far as the body nearest to the part; then the body is put aside. Parts left over go to their nearest
    body. Each step uses up a body, and depends on all before it, so a page's bodies and parts are one row.
    """
    chosen = dets.where(F.col("category_id").isin(body_category, part_category)).withColumn(
        "kind", F.when(F.col("category_id") == body_category, 0).otherwise(1))
    chosen = drop_contained(chosen, ["kind"])
    one = F.struct("kind", (F.col("x0") * F.col("x0") + F.col("y0") * F.col("y0")).alias("d"), F.col("det_id").cast("long").alias("id"), *BOX_COLS)
    whole = chosen.groupBy(*PAGE).agg(F.array_sort(F.collect_list(one)).alias("boxes"))
    whole = whole.withColumn("bodies", F.filter("boxes", lambda b: b.kind == 0))

    def step(found: Column, _: Column) -> Column:
        free = F.filter("boxes", lambda b: ~F.array_contains(found.used, b.id))

        def near_corner(free: Column) -> Column:
            x, y = F.array_min(F.transform(free, lambda b: b.x0)), F.array_min(F.transform(free, lambda b: b.y0))
            return _let(F.struct(x.alias("x"), y.alias("y")), lambda c: F.array_sort(F.transform(
                free, lambda b: F.struct(((b.x0 - c.x) * (b.x0 - c.x) + (b.y0 - c.y) * (b.y0 - c.y)).alias("c"), b.kind.alias("kind"), b.d.alias("d"), b.alias("b")))))

        def partner(ranked: Column) -> Column:
            first = F.get(ranked, F.lit(0))["b"]
            others = F.filter(ranked, lambda r: r.kind != first.kind)
            nearest = F.array_min(F.transform(others, lambda r, k: F.struct(_gap2(first, r.b).alias("g"), k.alias("k"), r.b.alias("b"))))
            pair = F.when(first.kind == 0, F.struct(first.alias("body"), nearest.b.alias("part"), nearest.g.alias("g"))).otherwise(
                F.struct(nearest.b.alias("body"), first.alias("part"), nearest.g.alias("g")))
            return F.when(F.size(others) > 0, pair)

        def take(pair: Column) -> Column:
            far = pair.g >= 9 * F.array_min(F.transform("bodies", lambda b: _gap2(b, pair.part)))
            used = F.when(far, F.array(pair.body.id)).otherwise(F.array(pair.body.id, pair.part.id))
            mine = F.when(far, F.array().cast(PAIRS)).otherwise(F.array(F.struct(pair.body.id.alias("body_id"), pair.part.id.alias("part_id"))))
            return F.when(pair.isNull(), found).otherwise(F.struct(F.concat(found.used, used).alias("used"), F.concat(found.pairs, mine).alias("pairs")))

        return _let(_let(_let(free, near_corner), partner), take)

    none = F.struct(F.array().cast("array<bigint>").alias("used"), F.array().cast(PAIRS).alias("pairs"))
    settled = whole.withColumn("found", F.aggregate("bodies", none, step))

    def nearest_body(p: Column) -> Column:
        return F.array_min(F.transform("bodies", lambda b, k: F.struct(_gap2(p, b).alias("g"), k.alias("k"), b.id.alias("id"))))["id"]

    left = F.filter("boxes", lambda b: (b.kind == 1) & ~F.array_contains("found.used", b.id))
    pairs = F.concat("found.pairs", F.when(F.size("bodies") > 0, F.transform(
        left, lambda b: F.struct(nearest_body(b).alias("body_id"), b.id.alias("part_id")))).otherwise(F.array().cast(PAIRS)))
    settled = settled.withColumn("pairs", pairs)
    alone = F.transform(F.filter("bodies", lambda b: ~F.exists("pairs", lambda p: p.body_id == b.id)),
                        lambda b: F.struct(b.id.alias("body_id"), F.lit(None).cast("bigint").alias("part_id")))
    return settled.select(*PAGE, F.explode(F.concat("pairs", alone)).alias("p")).select(*PAGE, "p.body_id", "p.part_id")


# ---- layout regions before recognition


def split_regions(dets: DataFrame) -> DataFrame:
    """PF25, first step: the region each detection belongs to."""
    c = F.col("category_id")
    return dets.withColumn(
        "region",
        F.when(c.isin(S.INLINE_EQUATION, S.EQUATION_DETECTED), "formula")
        .when(c.isin(S.TITLE, S.ABANDON, S.IMAGE_CAPTION, S.TABLE_CAPTION, S.TABLE_FOOTNOTE, S.IMAGE_BODY), "ocr")
        .when(c == S.TABLE_BODY, "table").when(c == S.TEXT, "text"))


def merge_alike_tables(tables: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Tables that are alike become one. Adds ``ord``, the place in the page's list that later steps follow: merged tables come
    last, in the order of their merges."""
    merged = growth.settled(tables, "det_id", growth.merging(threshold), threshold, threshold)
    place = F.coalesce("_key", F.array(F.col("det_id").cast("bigint")))
    along = Window.partitionBy(*PAGE).orderBy(place)
    return merged.withColumn("ord", (F.row_number().over(along) - 1).cast("bigint")).drop("_key")


def drop_tables_of_tables(tables: DataFrame, share: float = 0.8, filled: float = 0.8) -> DataFrame:
    """A table holding at least three others, none overlapping, that fill 80 % of it goes."""
    slim = tables.select(*ID, *BOX_COLS)
    held = meeting_pairs(slim, slim, (F.col("a.det_id") != F.col("b.det_id")) & g.mostly_inside(B, A, share)).select(
        *(F.col(f"a.{k}").alias(k) for k in PAGE), F.col("a.det_id").alias("big"), g.area(A).alias("big_area"),
        F.col("b.det_id").alias("det_id"), *(F.col(f"b.{c}").alias(c) for c in BOX_COLS))
    crossing = meeting_pairs(held, held, (F.col("a.det_id") < F.col("b.det_id")) & g.overlaps(A, B), [*PAGE, "big"])
    crossing = crossing.select(*(F.col(f"a.{k}").alias(k) for k in (*PAGE, "big"))).distinct()
    full = held.groupBy(*PAGE, "big").agg(
        F.count("*").alias("n"), F.sum(g.area(g.box())).alias("inner"), F.first("big_area").alias("outer"))
    full = full.where((F.col("n") >= 3) & (F.col("inner").cast("double") > F.col("outer") * F.lit(filled)))
    out = full.join(crossing, [*PAGE, "big"], "left_anti").select(*PAGE, F.col("big").alias("det_id"))
    return without(tables, out, ID)


def absorb_by_score(boxes: DataFrame, threshold: float = 0.8, order: str = "det_id") -> DataFrame:
    """Of two boxes that overlap the smaller goes and the larger grows, unless the smaller has the better score: then the larger goes."""
    return growth.settled(boxes, order, growth.absorbing(threshold, by_score=True), threshold, threshold).drop("_key")


def big_against_inner(boxes: DataFrame, share: float = 0.8, order: str = "det_id") -> DataFrame:
    """A box with two or more others inside takes them over or goes, by score."""
    return growth.settled(boxes, order, growth.outvoting(share), share, None).drop("_key")


def layout_regions(dets: DataFrame) -> DataFrame:
    """PF25: regions after J25, J26 and J12 on tables, J12 on text, J27 on all but formulas."""
    parts = split_regions(dets).where(F.col("region").isNotNull())

    def of(*names: str) -> DataFrame:
        return parts.where(F.col("region").isin(*names))

    tables = absorb_by_score(drop_tables_of_tables(merge_alike_tables(of("table"))), order="ord")
    text = absorb_by_score(of("text")).withColumn("ord", F.col("det_id").cast("bigint"))
    other = of("ocr").withColumn("ord", F.col("det_id").cast("bigint"))
    # List position in the joint pass: other regions, then text, then tables.
    rank = {"ocr": 0, "text": 1, "table": 2}
    joint = None
    for df, name in ((other, "ocr"), (text, "text"), (tables, "table")):
        df = df.withColumn("ord", F.col("ord") + F.lit(rank[name] << 42))
        joint = df if joint is None else joint.unionByName(df)
    kept = big_against_inner(joint, order="ord").drop("ord")
    return kept.unionByName(of("formula"))


# ---- formulas


def keep_confident_formulas(formulas: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Ordered elimination by IoU, the higher score stays, ties keep the earlier."""
    pairs = meeting_pairs(formulas.select(*ID, *BOX_COLS, "score"), formulas.select(*ID, *BOX_COLS, "score"),
                          (F.col("a.det_id") < F.col("b.det_id")) & (g.iou(A, B) > threshold))
    edges = settle.conflict_edges(pairs, F.col("a.det_id"), F.col("b.det_id"), F.col("a.score") < F.col("b.score"))
    return without(formulas, settle.eliminate(edges).withColumnRenamed("loser", "det_id"), ID)


def equation_sources(dets: DataFrame, formulas_on: bool) -> tuple[DataFrame, DataFrame]:
    """PF24: (equation blocks, extra spans).

    With formula recognition on, detected equations are the blocks; off, layout equations are, and
    each adds an empty equation span.
    """
    category = S.EQUATION_DETECTED if formulas_on else S.EQUATION_LAYOUT
    blocks = dets.where(F.col("category_id") == category).withColumn("block_type", F.lit("interline_equation"))
    spans = blocks.where(F.lit(not formulas_on)).withColumns({"type": F.lit("interline_equation"), "content": F.lit("")})
    return blocks, spans.drop("block_type")


def distinct_spans(spans: DataFrame, order: str, value_cols: list[str]) -> DataFrame:
    """SE1: of spans equal in every value column the first stays."""
    firsts = spans.groupBy(*PAGE, *value_cols).agg(F.min(order).alias(order))
    return spans.join(firsts.select(*PAGE, order), [*PAGE, order], "left_semi")
