"""Pair joins inside a page, kept away from page-sized cross products by a grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE = ["doc_id", "page_idx"]
CELL_W, CELL_H = 320, 160  # a box in more cells is shuffled more often, a fuller cell compares more pairs


def _cell_range(lo: Column, hi: Column, size: int) -> Column:
    first = F.floor(lo / size)
    return F.sequence(first, F.greatest(first, F.floor(hi / size)))


def on_grid(df: DataFrame, cell_w: int, cell_h: int) -> DataFrame:
    """Rows copied to each grid cell (gx, gy) that their box covers."""
    return (
        df.withColumn("gx", F.explode(_cell_range(F.col("x0"), F.col("x1"), cell_w)))
        .withColumn("gy", F.explode(_cell_range(F.col("y0"), F.col("y1"), cell_h)))
    )


def meeting_pairs(
    left: DataFrame, right: DataFrame, condition: Column | None = None, keys: list[str] = PAGE,
    cell_w: int = CELL_W, cell_h: int = CELL_H, how: str = "inner", centred: bool = False, spread: bool = False,
) -> DataFrame:
    """All (left, right) rows of one page whose boxes meet, touching included, each pair once.

    Both sides are copied to the grid cells they cover and equi-joined on page *and* cell, so the
    join key is finer than the page and one crowded page spreads over many tasks. A pair is reported
    only from the cell of the top-left corner of its common area, so no ``distinct`` is needed.
    Columns are reachable through the aliases ``a`` and ``b``. Any predicate that is false for boxes
    that do not meet may be passed as ``condition``. If it is also false unless the right box holds the
    centre of the left one, as where it asks for over half of the left one, ``centred`` puts left rows
    into one cell only. With ``spread`` the cells are dealt over all shuffle partitions: where boxes lie
    on each other, small rows make many pairs, and joined by size they would be one task.
    """
    col = F.col
    if centred:
        a = left.withColumns({"gx": F.floor((col("x0") + col("x1")) / 2.0 / cell_w), "gy": F.floor((col("y0") + col("y1")) / 2.0 / cell_h)}).alias("a")
    else:
        a = on_grid(left, cell_w, cell_h).alias("a")
    b = on_grid(right, cell_w, cell_h).alias("b")
    if spread:
        parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        a, b = (side.repartition(parts, *keys, "gx", "gy").alias(name) for side, name in ((a, "a"), (b, "b")))
    on = [col(f"a.{k}") == col(f"b.{k}") for k in (*keys, "gx", "gy")]
    on += [
        col("a.x0") <= col("b.x1"), col("b.x0") <= col("a.x1"),
        col("a.y0") <= col("b.y1"), col("b.y0") <= col("a.y1"),
    ]
    on += [] if centred else [
        col("a.gx") == F.floor(F.greatest(col("a.x0"), col("b.x0")) / cell_w),
        col("a.gy") == F.floor(F.greatest(col("a.y0"), col("b.y0")) / cell_h),
    ]
    if condition is not None:
        on.append(condition)
    return a.join(b, on, how)


def without(df: DataFrame, losers: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose keys are not among ``losers``."""
    return df.join(losers.select(*keys).distinct(), keys, "left_anti")


def only(df: DataFrame, winners: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(winners.select(*keys).distinct(), keys, "left_semi")
