"""Texts of cells in one pass, where rows may be counted in place of repeated."""

import random

from pyspark.sql import functions as F

from pageloom.catalog import tables as queries
from pageloom.operators import grids
from pageloom.operators import tables as T

SCHEMA = "table_id bigint, cell_no bigint, text_id bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint, text string"
CELL = ["table_id", "cell_no", "text_id", "x0", "y0", "x1", "y1", "text"]


def read(df):
    return sorted((r.table_id, r.cell_no, r.pos, r.text) for r in df.collect())


def pieces(cells, most, seed):
    """Pieces on some rows, some with their ends swapped, all of them told apart by their text."""
    rnd = random.Random(seed)
    for c in range(cells):
        for k in range(rnd.randrange(1, most)):
            x, y = rnd.randrange(0, 90), rnd.randrange(0, 60)
            yield 0, c, k, x, y, x + rnd.choice([-8, 4, 20, 45]), y + rnd.choice([-3, 0, 8, 12, 20]), f"t{k}", rnd.choice([1, 1, 2, 5])


def test_counted_rows_are_repeated_rows(spark):
    df = spark.createDataFrame(list(pieces(80, 12, 5)), SCHEMA + ", copies bigint")
    repeated = df.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*CELL)
    want = read(grids.gather_cell_texts(repeated))
    assert read(grids.gather_cell_texts(df, copies="copies")) == want and len(want) > 80
    assert want != read(grids.gather_cell_texts(df))


def test_a_full_cell_is_read_once(spark):
    """Thousands of pieces of one row: no expression that copies all of them for each one."""
    n = 6_000
    df = spark.range(n).selectExpr("1L table_id", "0L cell_no", "id text_id", "id * 30 x0", "id % 3 y0", "id * 30 + 10 x1", "id % 3 + 12 y1", "concat('p', id) text")
    got = grids.gather_cell_texts(df)
    assert "aggregate(" not in got._jdf.queryExecution().optimizedPlan().toString()
    out = got.collect()
    assert [r.pos for r in out] == [0] and out[0].text.split() == [f"p{k}" for k in range(n)] and out[0].text.startswith("p0  p1  p2")


def test_tables_that_share_an_id(spark, monkeypatch):
    """Pairs of a text and a cell that are the same pair by their numbers are one row, and the texts are as from all of them."""
    cells = spark.range(4 * 6).selectExpr("id % 2 table_id", "id div 2 % 3 cell_no", "id div 2 % 3 * 100 cx0", "0L cy0", "id div 2 % 3 * 100 + 100 cx1", "20L cy1",
                                          "id div 2 % 3 * 100 + 5 + id ox0", "2 + id % 4 oy0", "id div 2 % 3 * 100 + 40 + id ox1", "16 + id % 4 oy1", "concat('t', id) otext")

    class Tables:
        cells_ocr = cells

    texts = queries._texts(Tables)
    plain = texts.join(T.match_text_to_ruled_cells(texts, queries._cells(Tables)), ["table_id", "text_id"])
    assert plain.count() == 6 * 4 ** 3
    seen = []
    whole = T.gather_cell_texts
    monkeypatch.setattr(T, "gather_cell_texts", lambda df, **k: (seen.append(df), whole(df, **k))[1])
    assert read(queries.w13(Tables)) == read(whole(plain))
    assert seen[0].count() == 6 * 4


def test_texts_meet_the_cells_near_them(spark):
    """J19 in a tall table: a text is held against cells about its own place, not against all within 160 points."""
    c = spark.range(200).selectExpr("1L table_id", "id cell_no", "0L x0", "id * 20 y0", "100L x1", "id * 20 + 20 y1")
    t = c.selectExpr("table_id", "cell_no text_id", "x0 + 5 x0", "y0 + 2 y0", "x1 - 5 x1", "y1 - 2 y1")
    found = T.match_text_to_ruled_cells(t, c)
    assert {(r.text_id, r.cell_no) for r in found.collect()} == {(k, k) for k in range(200)}
    assert T.CELL_H < 160 and f"/ {T.CELL_H}" in found._jdf.queryExecution().optimizedPlan().toString().replace(".0", "")
