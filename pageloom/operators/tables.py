"""Tables: cells from text boxes, grids, HTML, and tables that run over pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geom as g
from ..functions import html_tables as H
from ..functions import text as tx
from . import folds
from .grids import gather_cell_texts, logical_boxes, structure_boxes  # noqa: F401  W13, W15, W16
from .pairs import meeting_pairs

A, B = g.box("a"), g.box("b")
BOX_COLS = ["x0", "y0", "x1", "y1"]
TABLE = ["table_id"]
CELL_W, CELL_H = 128, 32  # about a table cell: in wider ones every text of a table meets most of its cells

# How a caption says that its table continues.
CONTINUED_ENDINGS = ["(续)", "(续表)", "(续上表)", "(continued)", "(cont.)", "(cont’d)", "(…continued)", "续表"]
CONTINUED_ANYWHERE = ["(continued)"]


# ---- text boxes to cells


def match_text_to_predicted_cells(texts: DataFrame, cells: DataFrame) -> DataFrame:
    """(table_id, text_id, cell_no): the cell of best IoU, then least corner distance, then order.

    Texts wholly above the first cell row are left out, and the IoU must be positive, so only cells
    that meet the text are joined.
    """
    top = cells.groupBy(*TABLE).agg(F.min("y0").alias("top"))
    below = texts.join(top, TABLE).where(F.col("y1") >= F.col("top")).drop("top")
    pairs = meeting_pairs(below.select(*TABLE, "text_id", *BOX_COLS), cells.select(*TABLE, "cell_no", *BOX_COLS),
                          F.lit(1.0) - g.structure_iou(A, B) < F.lit(1.0) - F.lit(0.1 ** 8), TABLE, spread=True)
    rank = F.struct((F.lit(1.0) - g.structure_iou(A, B)).alias("miss"), g.structure_distance(A, B).alias("dist"), F.col("b.cell_no").alias("cell_no"))
    return (
        pairs.groupBy(F.col("a.table_id").alias("table_id"), F.col("a.text_id").alias("text_id")).agg(F.min(rank).alias("best"))
        .select("table_id", "text_id", "best.cell_no"))


def match_text_to_ruled_cells(texts: DataFrame, cells: DataFrame) -> DataFrame:
    """(table_id, text_id, cell_no): texts nearly inside a cell (less than 0.6 outside) or with
    IoU above 0.8; a text may go to several cells."""
    fits = (g.box_contained(A, B, 0.6) == 1) | (g.table_iou(A, B) > 0.8)
    pairs = meeting_pairs(texts.select(*TABLE, "text_id", *BOX_COLS), cells.select(*TABLE, "cell_no", *BOX_COLS),
                          F.coalesce(fits, F.lit(False)), TABLE, CELL_W, CELL_H, spread=True)
    return pairs.select(F.col("a.table_id").alias("table_id"), F.col("a.text_id").alias("text_id"), F.col("b.cell_no").alias("cell_no"))


# ---- grids


def cell_rows(cells: DataFrame, step: int = 10) -> DataFrame:
    """Adds ``row_no``; a cell whose top is over ``step`` away from the one before opens a row."""
    along = Window.partitionBy(*TABLE).orderBy("cell_no")
    opens = F.coalesce(F.abs(F.col("y0") - F.lag("y0").over(along)) > step, F.lit(False)).cast("int")
    return cells.withColumn("opens", opens).withColumn("row_no", F.sum("opens").over(along)).drop("opens")


HTML_CELL = "row_no int, cell_no int, tag string, r0 int, r1 int, c0 int, c1 int, text string"


def cells_from_html(tables: DataFrame, keys: list[str], html_col: str = "html") -> DataFrame:
    """UF3: cells of table HTML, by a table function used laterally."""
    from pyspark.sql.functions import udtf

    class HtmlCells:
        def eval(self, source: str):
            yield from H.html_cells(source)

    read = udtf(HtmlCells, returnType=HTML_CELL)
    return tables.select(*keys, html_col).lateralJoin(read(F.col(html_col).outer())).drop(html_col)


def table_shape(cells: DataFrame, keys: list[str] = TABLE) -> DataFrame:
    """AG12: total columns of each table."""
    return cells.groupBy(*keys).agg((F.max("c1") + 1).alias("columns"), (F.max("r0") + 1).alias("rows"))


def row_shapes(cells: DataFrame, keys: list[str] = TABLE) -> DataFrame:
    """AG12: of each row the columns reached (cells from above count), the sum of spans and the cells."""
    spread = cells.select(*keys, F.explode(F.sequence("r0", "r1")).alias("row_no"), "c1")
    reached = spread.groupBy(*keys, "row_no").agg((F.max("c1") + 1).alias("reached"))
    own = cells.groupBy(*keys, F.col("r0").alias("row_no")).agg(
        F.sum(F.col("c1") - F.col("c0") + 1).alias("span_sum"), F.count("*").alias("n_cells"))
    return own.join(reached, [*keys, "row_no"])


def header_rows(first: DataFrame, second: DataFrame, keys: list[str] = TABLE) -> DataFrame:
    """Leading rows that two tables of one key share: alike in cells, spans, columns reached and
    squeezed text; if none, alike in columns reached and text."""

    def rows(cells: DataFrame, name: str) -> DataFrame:
        squeezed = F.regexp_replace(tx.full_to_half(F.col("text")), tx.BLANK, "")
        content = cells.groupBy(*keys, F.col("r0").alias("row_no")).agg(
            F.array_sort(F.collect_list(F.struct("c0", (F.col("r1") - F.col("r0")).alias("down"), (F.col("c1") - F.col("c0")).alias("right"), squeezed.alias("t")))).alias("cs"))
        shapes = row_shapes(cells, keys).select(*keys, "row_no", "reached")
        return content.join(shapes, [*keys, "row_no"]).select(
            *keys, "row_no", F.col("reached").alias(f"{name}_reached"), F.transform("cs", lambda c: F.struct(c["down"], c["right"], c["t"])).alias(f"{name}_cells"),
            F.col("cs")["t"].alias(f"{name}_texts"))

    both = rows(first, "p").join(rows(second, "q"), [*keys, "row_no"])
    same_text = (F.col("p_reached") == F.col("q_reached")) & (F.col("p_texts") == F.col("q_texts"))
    exact = (F.col("p_reached") == F.col("q_reached")) & (F.col("p_cells") == F.col("q_cells"))
    along = Window.partitionBy(*keys).orderBy("row_no")
    # A leading row also has every row before it present in both tables.
    dense = F.col("row_no") == F.row_number().over(along) - 1
    flagged = both.withColumns({"exact": (exact & dense).cast("int"), "loose": (same_text & dense).cast("int")})
    led = flagged.withColumns({"exact": F.min("exact").over(along), "loose": F.min("loose").over(along)})
    n = led.groupBy(*keys).agg(F.sum("exact").alias("exact"), F.sum("loose").alias("loose"))
    count = F.when(F.col("exact") > 0, F.col("exact")).otherwise(F.col("loose"))
    pairs = first.select(*keys).distinct().join(second.select(*keys).distinct(), keys)
    return pairs.join(n.select(*keys, count.alias("n_header")), keys, "left").withColumn("n_header", F.coalesce("n_header", F.lit(0)))


# ---- structure tokens of the OTSL form

OTSL_TOKENS = ["nl", "fcel", "ecel", "lcel", "ucel", "xcel"]
_ANY = "<(?:" + "|".join(OTSL_TOKENS) + ")>"


def otsl_tokens(tables: DataFrame, keys: list[str], otsl_col: str = "otsl") -> DataFrame:
    """(keys, r, c, tok, text) of each place of the grid; short rows end in empty cells."""
    pairs = F.arrays_zip(
        F.regexp_extract_all(otsl_col, F.lit(f"({_ANY})"), F.lit(1)).alias("tok"),
        F.regexp_extract_all(otsl_col, F.lit(f"(?s){_ANY}((?:(?!{_ANY}).)*)"), F.lit(1)).alias("text"))
    rows = tables.select(*keys, F.posexplode(pairs).alias("pos", "z")).select(*keys, "pos", "z.tok", "z.text")
    along = Window.partitionBy(*keys).orderBy("pos")
    ends = (F.col("tok") == "<nl>").cast("int")
    cells = rows.withColumns({"ends": F.sum(ends).over(along)}).where("tok <> '<nl>'")
    # Line ends without cells in between make no row.
    cells = cells.withColumn("r", F.dense_rank().over(Window.partitionBy(*keys).orderBy("ends")) - 1)
    cells = cells.withColumn("c", F.row_number().over(Window.partitionBy(*keys, "ends").orderBy("pos")) - 1)
    grid = (
        cells.groupBy(*keys).agg(F.max("r").alias("rows"), F.max("c").alias("columns"))
        .withColumn("r", F.explode(F.sequence(F.lit(0), "rows"))).withColumn("c", F.explode(F.sequence(F.lit(0), "columns")))
        .select(*keys, "r", "c"))
    return grid.join(cells.select(*keys, "r", "c", "tok", "text"), [*keys, "r", "c"], "left").withColumns({
        "tok": F.coalesce("tok", F.lit("<ecel>")), "text": tx.strip(F.coalesce("text", F.lit("")))})


def otsl_cells(grid: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, r0, r1, c0, c1, text). A cell goes on over <lcel>/<xcel> to its right and
    <ucel>/<xcel> below, i.e. up to the next place that is no such token."""
    col_stop = F.when(~F.col("tok").isin("<lcel>", "<xcel>"), F.col("c"))
    row_stop = F.when(~F.col("tok").isin("<ucel>", "<xcel>"), F.col("r"))
    leftwards = Window.partitionBy(*keys, "r").orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, -1)
    upwards = Window.partitionBy(*keys, "c").orderBy(F.desc("r")).rowsBetween(Window.unboundedPreceding, -1)
    size = Window.partitionBy(*keys)
    marked = grid.withColumns({"n_rows": F.max("r").over(size) + 1, "n_cols": F.max("c").over(size) + 1}).withColumns({
        "c1": F.coalesce(F.last(col_stop, ignorenulls=True).over(leftwards), "n_cols") - 1,
        "r1": F.coalesce(F.last(row_stop, ignorenulls=True).over(upwards), "n_rows") - 1})
    cells = marked.where(F.col("tok").isin("<fcel>", "<ecel>"))
    text = F.when(F.col("tok") == "<fcel>", F.col("text")).otherwise(F.lit(""))
    return cells.select(*keys, F.col("r").alias("r0"), "r1", F.col("c").alias("c0"), "c1", text.alias("text"))


def _concat_rows(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, r, c, td) to one ``body`` per key: cells to rows, then rows to tables."""
    rows = pieces.groupBy(*keys, "r").agg(F.array_join(F.array_sort(F.collect_list(F.struct("c", "td")))["td"], "").alias("tds"))
    ordered = F.array_sort(F.collect_list(F.struct("r", F.concat(F.lit("<tr>"), "tds", F.lit("</tr>")).alias("tr"))))
    return rows.groupBy(*keys).agg(F.array_join(ordered["tr"], "").alias("body"))


def cells_to_html(cells: DataFrame, grid: DataFrame, keys: list[str]) -> DataFrame:
    """W18, OTSL form: (keys, html); places that no cell covers are empty cells."""
    covered = cells.select(*keys, F.explode(F.sequence("r0", "r1")).alias("r"), "c0", "c1").select(*keys, "r", F.explode(F.sequence("c0", "c1")).alias("c"))
    bare = grid.select(*keys, "r", "c").join(covered.distinct(), [*keys, "r", "c"], "left_anti").withColumn("td", F.lit("<td></td>"))
    down, right = F.col("r1") - F.col("r0") + 1, F.col("c1") - F.col("c0") + 1
    td = F.concat(
        F.lit("<td"), F.when(down > 1, F.concat(F.lit(' rowspan="'), down, F.lit('"'))).otherwise(F.lit("")),
        F.when(right > 1, F.concat(F.lit(' colspan="'), right, F.lit('"'))).otherwise(F.lit("")), F.lit(">"),
        tx.escape_html(tx.strip(F.col("text"))), F.lit("</td>"))
    pieces = cells.select(*keys, F.col("r0").alias("r"), F.col("c0").alias("c"), td.alias("td")).unionByName(bare)
    return _concat_rows(pieces, keys).select(*keys, F.concat(F.lit("<table>"), "body", F.lit("</table>")).alias("html"))


def logical_cells_to_html(cells: DataFrame, keys: list[str]) -> DataFrame:
    """W18, grid form: leading blank rows and the blank columns on either side are left out."""
    filled = F.col("text") != ""
    bounds = cells.groupBy(*keys).agg(
        F.min(F.when(filled, F.col("r0"))).alias("top"), F.min(F.when(filled, F.col("c0"))).alias("left"),
        F.max(F.when(filled, F.col("c1"))).alias("right"), F.max("r1").alias("last_row"), F.max("c1").alias("last_col"))
    covered = cells.select(*keys, F.explode(F.sequence("r0", "r1")).alias("r"), "c0", "c1").select(*keys, "r", F.explode(F.sequence("c0", "c1")).alias("c"))
    grid = bounds.select(*keys, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last_row").cast("bigint"))).alias("r"), "last_col").select(
        *keys, "r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last_col").cast("bigint"))).alias("c"))
    bare = grid.join(covered.distinct(), [*keys, "r", "c"], "left_anti").withColumn("td", F.lit("<td></td>"))
    td = F.concat(F.lit("<td rowspan="), F.col("r1") - F.col("r0") + 1, F.lit(" colspan="), F.col("c1") - F.col("c0") + 1, F.lit(">"), "text", F.lit("</td>"))
    pieces = cells.select(*keys, F.col("r0").alias("r"), F.col("c0").alias("c"), td.alias("td")).unionByName(bare)
    # Rows without a cell of their own stay as empty rows.
    empty = grid.select(*keys, "r").distinct().select(*keys, "r", F.lit(-1).cast("bigint").alias("c"), F.lit("").alias("td"))
    inside = (F.col("r") >= F.col("top")) & ((F.col("c") == -1) | ((F.col("c") >= F.col("left")) & (F.col("c") <= F.col("right"))))
    shown = pieces.unionByName(empty).join(bounds, keys).where(inside).select(*keys, "r", "c", "td")
    body = _concat_rows(shown, keys)
    html = F.concat(F.lit("<html><body><table>"), F.coalesce("body", F.lit("")), F.lit("</table></body></html>")).alias("html")
    return bounds.select(*keys).join(body, keys, "left").select(*keys, html)


def fill_structure(tokens: DataFrame, contents: DataFrame) -> DataFrame:
    """W18, predicted form: structure tokens (table_id, pos, token) with the texts of each cell
    (table_id, cell_no, text_id, text) put in; head and body tags are left out.

    Several texts of a cell are joined by blanks, with their own bold tags taken off and one pair put
    around all if the first was bold.
    """
    along = Window.partitionBy(*TABLE).orderBy("pos")
    closes = F.col("token").contains("</td>")
    numbered = tokens.withColumn("cell_no", F.when(closes, F.sum(closes.cast("bigint")).over(along) - 1))
    texts = contents.groupBy(*TABLE, "cell_no").agg(F.array_sort(F.collect_list(F.struct("text_id", "text")))["text"].alias("ts"))
    many = F.size("ts") > 1

    def cleaned(t: Column, i: Column) -> Column:
        t = F.regexp_replace(t, "^ ", "")
        t = F.when(t.contains("<b>"), F.substring(t, F.lit(4), F.length(t))).otherwise(t)
        t = F.when(t.contains("</b>"), F.substring(t, F.lit(1), F.greatest(F.length(t) - 4, F.lit(0)))).otherwise(t)
        return F.when((t != "") & (i != F.size("ts") - 1) & ~t.endswith(" "), F.concat(t, F.lit(" "))).otherwise(t)

    joined = F.array_join(F.transform("ts", cleaned), "")
    bold = F.col("ts")[0].contains("<b>")
    text = F.when(many, F.when(bold, F.concat(F.lit("<b>"), joined, F.lit("</b>"))).otherwise(joined)).otherwise(F.col("ts")[0])
    filled = numbered.join(texts.select(*TABLE, "cell_no", text.alias("inner")), [*TABLE, "cell_no"], "left")
    inner = F.coalesce("inner", F.lit(""))
    piece = (
        F.when(F.col("token") == "<td></td>", F.concat(F.lit("<td>"), inner, F.lit("</td>")))
        .when(closes, F.concat(inner, "token")).otherwise(F.col("token")))
    shown = filled.where(~F.col("token").isin("<thead>", "</thead>", "<tbody>", "</tbody>")).select(*TABLE, "pos", piece.alias("piece"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "piece")))
    return shown.groupBy(*TABLE).agg(F.array_join(ordered["piece"], "").alias("html"))


def otsl_in_markdown(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """FN26: paragraphs that hold <fcel> or <ecel> become HTML tables, the rest stays."""
    pieces = texts.select(*keys, F.posexplode(F.split(text_col, "\n\n")).alias("para", "piece"))
    is_table = F.col("piece").contains("<fcel>") | F.col("piece").contains("<ecel>")
    pk = [*keys, "para"]
    grid = otsl_tokens(pieces.where(is_table).withColumnRenamed("piece", "otsl"), pk)
    html = cells_to_html(otsl_cells(grid, pk), grid, pk)
    done = pieces.join(html, pk, "left").withColumn("piece", F.coalesce("html", "piece"))
    ordered = F.array_sort(F.collect_list(F.struct("para", "piece")))
    return done.groupBy(*keys).agg(F.array_join(ordered["piece"], "\n\n").alias(text_col))


# ---- choosing between two readings of a table


def choose_table(tables: DataFrame, texts: DataFrame) -> DataFrame:
    """AG13: the ruled or the unruled reading, by cell counts, blank cells and the texts they hold.

    ``tables``: table_id, wired, wireless; a missing ruled reading leaves the unruled one.
    """
    hits = texts.join(tables, TABLE).groupBy(*TABLE).agg(
        F.count_if(F.col("wireless").contains(F.col("text"))).alias("in_wireless"),
        F.count_if(F.col("wired").contains(F.col("text"))).alias("in_wired"))

    def cells(name: str) -> Column:
        return F.coalesce(F.regexp_count(F.lower(name), F.lit("<t[dh]")), F.lit(0))

    def blank(name: str) -> Column:
        return F.coalesce(F.regexp_count(F.col(name), F.lit(r"(?i)<t[dh](?:\s[^>]*)?>\s*</t[dh]>")), F.lit(0))

    df = tables.join(hits, TABLE, "left").withColumns({
        "n_wired": cells("wired"), "n_wireless": cells("wireless"), "b_wired": blank("wired"), "b_wireless": blank("wireless"),
        "in_wired": F.coalesce("in_wired", F.lit(0)), "in_wireless": F.coalesce("in_wireless", F.lit(0))})
    wired, wireless = F.col("n_wired") - F.col("b_wired"), F.col("n_wireless") - F.col("b_wireless")
    side = F.bround(F.sqrt(wired.cast("double")))
    fuller = (wireless > wired) & (wireless + 3 >= F.greatest(wired + side * 2, side * (side + 2)))
    gap = F.col("n_wireless") - F.col("n_wired")
    unruled = (
        fuller | ((gap >= 0) & (gap <= 5) & (F.col("n_wired") <= F.bround(F.col("n_wireless") * F.lit(0.75))))
        | ((gap == 0) & (F.col("n_wired") <= 4))
        | ((F.col("in_wired") <= F.col("in_wireless") * F.lit(0.6)) & (F.col("in_wireless") >= 10)))
    choice = F.when(F.col("wired").isNull() | unruled, "wireless").otherwise("wired")
    return df.select(*TABLE, choice.alias("choice"), F.when(choice == "wireless", F.col("wireless")).otherwise(F.col("wired")).alias("html"))


def turned_tables(tables: DataFrame, texts: DataFrame) -> DataFrame:
    """AG14: tables over 1.2 times as high as wide where at least three and 0.28 of the text boxes are
    upright (under 0.8 as wide as high)."""
    tall = tables.where(F.when(F.col("width") > 0, F.col("height") / F.col("width")).otherwise(F.lit(1.0)) > 1.2)
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    upright = F.when(h > 0, w / h).otherwise(F.lit(1.0)) < 0.8
    votes = texts.groupBy(*TABLE).agg(F.count_if(upright).alias("upright"), F.count("*").alias("n"))
    return tall.join(votes, TABLE).where((F.col("upright") >= 3) & (F.col("upright") >= F.col("n") * F.lit(0.28))).select(*TABLE)


# ---- tables over page breaks


def says_continued(caption: Column) -> Column:
    """PF22: caption of a table that goes on from the page before."""
    text = F.lower(tx.full_to_half(tx.strip(caption)))
    found = F.lit(False)
    for mark in CONTINUED_ENDINGS:
        found = found | text.endswith(mark.lower())
    for mark in CONTINUED_ANYWHERE:
        found = found | text.contains(mark)
    return found


def adjacent_tables(blocks: DataFrame) -> DataFrame:
    """(doc_id, page_idx, block_id, prev_block_id) where a page opens with a table and the page
    before closes with one. Only first and last blocks of pages are joined."""
    ends = blocks.groupBy("doc_id", "page_idx").agg(
        F.min_by(F.struct("block_id", "type"), "block_id").alias("first"), F.max_by(F.struct("block_id", "type"), "block_id").alias("last"))
    firsts = ends.where("first.type = 'table'").select("doc_id", "page_idx", F.col("first.block_id").alias("block_id"))
    lasts = ends.where("last.type = 'table'").select("doc_id", (F.col("page_idx") + 1).alias("page_idx"), F.col("last.block_id").alias("prev_block_id"))
    return firsts.join(lasts, ["doc_id", "page_idx"])


MERGED = (
    "doc_id bigint, page_idx bigint, block_id bigint, html string, footnotes array<string>, foreign_footnotes boolean, merged_away boolean")


def merge_tables_over_pages(tables: DataFrame, links: DataFrame) -> DataFrame:
    """Tables (doc_id, page_idx, block_id, x0, x1, html, captions, footnotes) after joining those
    that go on over a page break.

    Linked tables form runs; a run is folded from its last pair to its first, because a joined table
    enters the next test. Tables outside runs do not reach the fold.
    """
    block = ["doc_id", "page_idx", "block_id"]
    cur = tables.join(links.select(*block, F.lit(True).alias("linked")), block, "left")
    leads = links.select("doc_id", (F.col("page_idx") - 1).alias("page_idx"), F.col("prev_block_id").alias("block_id"), F.lit(True).alias("leads"))
    cur = cur.join(leads, block, "left")
    plain = ["doc_id", "page_idx", "block_id", "html", "footnotes"]
    alone = cur.where(F.col("linked").isNull() & F.col("leads").isNull()).select(
        *plain, F.lit(False).alias("foreign_footnotes"), F.lit(False).alias("merged_away"))
    chained = cur.where(F.col("linked").isNotNull() | F.col("leads").isNotNull())
    along = Window.partitionBy("doc_id").orderBy("page_idx", "block_id")
    run = F.sum(F.col("linked").isNull().cast("bigint")).over(along)
    continued = F.exists("captions", says_continued)
    rows = chained.select(*plain, "x0", "x1", F.size("captions").alias("n_captions"), continued.alias("continued"), run.alias("run"))
    return alone.unionByName(folds.fold_groups(rows, ["doc_id", "run"], folds.merge_run, MERGED))
