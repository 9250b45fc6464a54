"""Documents from the text layer of pages: characters and lines fill the boxes, a recogniser reads the rest."""

import math

import pytest
from pyspark.sql import functions as F

from pageloom.operators import spans as SP
from pageloom.plans.markdown import layout_content_list, layout_markdown, layout_middle
from pageloom.plans.pages import TextLayer, page_layout
from pageloom.sources import files, sinks
from test_layout_markdown import FORMULA, IMAGE, IMAGE_CAPTION, SCHEMA, TABLE, TEXT, TITLE, WORDS

ABANDON = 2
CHARS = "doc_id bigint, page_idx bigint, char_id bigint, i bigint, ch string, x0 double, y0 double, x1 double, y1 double, rotation double"
LINES = "doc_id bigint, page_idx bigint, line_id bigint, text string, x0 double, y0 double, x1 double, y1 double, rotation double"
W, H = 600, 800


class Pages:
    """Boxes, characters and lines written down row by row."""

    def __init__(self):
        self.dets, self.chars, self.lines = [], [], []

    def box(self, category, x0, y0, x1, y1, page=0, latex=None, html=None, path=None):
        self.dets.append((1, page, len(self.dets) + 1, category, x0, y0, x1, y1, 0.9, None, latex, html, path))

    def words(self, text, x0, y0, page=0, turned=0.0, width=8, box=True):
        """A line of characters ``width`` wide and 12 high, with a box of a detector around it."""
        if box:
            self.box(WORDS, x0, y0, x0 + width * len(text), y0 + 14, page)
        for k, ch in enumerate(text):
            self.chars.append((1, page, len(self.chars), len(self.chars), ch, x0 + k * width + 0.5, y0 + 1.0, x0 + (k + 1) * width - 0.5, y0 + 13.0, turned))
        self.lines.append((1, page, len(self.lines), text, float(x0), float(y0), float(x0 + width * len(text)), y0 + 14.0, turned))

    def frames(self, spark):
        return spark.createDataFrame(self.dets, SCHEMA), spark.createDataFrame(self.chars, CHARS), spark.createDataFrame(self.lines, LINES)


@pytest.fixture(scope="module")
def document():
    p = Pages()
    p.box(TITLE, 40, 20, 400, 50)
    p.words("The ﬁrst head", 50, 25)
    p.box(TEXT, 40, 100, 450, 140)
    p.words("A line that goes on", 50, 105)
    p.words("and ends (here).", 50, 123)
    p.words("skewed", 300, 123, turned=math.radians(30), box=False)
    p.box(IMAGE, 40, 200, 300, 300, path="a.jpg")
    p.box(IMAGE_CAPTION, 40, 310, 300, 340)
    p.words("Figure 1", 50, 315)
    p.box(TABLE, 40, 400, 400, 460, html="<table></table>")
    p.box(FORMULA, 40, 500, 300, 540, latex="x=1")
    # a box without characters, for the recogniser; another that it is not sure of
    p.box(TEXT, 40, 600, 450, 640)
    p.box(WORDS, 50, 605, 400, 619)
    p.box(TEXT, 40, 680, 450, 710)
    p.box(WORDS, 50, 685, 400, 699)
    p.box(ABANDON, 40, 750, 450, 775)
    p.words("page 7", 50, 755)
    # an upright box, filled by lines; the text goes on over the page
    p.box(TEXT, 40, 100, 90, 300, page=1)
    p.box(WORDS, 50, 105, 64, 290, page=1)
    for k, word in enumerate(("up", "right")):
        p.lines.append((1, 1, 100 + k, word, 51.0, 110.0 + 80 * k, 63.0, 180.0 + 80 * k, math.pi / 2))
    for k in range(3):
        p.box(TEXT, 140, 400 + 100 * k, 450, 430 + 100 * k, page=1)
        p.words(f"Block number {k}", 150, 405 + 100 * k, page=1)
    return p


def recogniser(seen):
    def read(late):
        seen.extend(late.select("page_idx", "y0").collect())
        return late.select("doc_id", "page_idx", "span_id", F.lit("read later").alias("text"), F.when(F.col("y0") < 650, 0.87654).otherwise(0.5).alias("score"))

    return read


@pytest.fixture(scope="module")
def layout(spark, document):
    dets, chars, lines = document.frames(spark)
    seen = []
    out = page_layout(dets, F.lit(W), F.lit(H), ocr_on=False, text_layer=TextLayer(chars, lines, recogniser(seen)))
    assert sorted((r.page_idx, r.y0) for r in seen) == [(0, 605), (0, 685)]
    return out


def test_markdown_from_the_text_layer(layout):
    row, = layout_markdown(layout, F.lit(W)).collect()
    assert row.md == ("# The first head\n\nA line that goes on and ends (here).\n\n![](images/a.jpg)  \nFigure 1\n\n<table></table>\n\n$$\nx=1\n$$\n\n"
                      "read later\n\nupright\n\nBlock number 0\n\nBlock number 1\n\nBlock number 2")


def test_content_list_of_a_layout(layout):
    got = [r for r in layout_content_list(layout, F.lit(W), F.lit(H)).orderBy("page_idx", "block_id").collect()]
    first = [(r.record.type, (r.record.text or "").strip(), r.record.bbox) for r in got if r.page_idx == 0]
    assert [(kind, text) for kind, text, _ in first] == [
        ("text", "The first head"), ("text", "A line that goes on and ends (here)."), ("image", ""), ("table", ""), ("equation", "$$\nx=1\n$$"),
        ("text", "read later"), ("text", ""), ("discarded", "page 7")]
    assert first[2][2] == [66, 250, 500, 375] and first[-1][2] == [66, 937, 750, 968]
    image, table, formula = (r.record for r in got[2:5])
    assert got[0].record.text_level == 1 and image.img_path == "images/a.jpg" and image.image_caption == ["Figure 1"]
    assert table.table_body == "<table></table>" and formula.text_format == "latex"
    assert [r.record.text.strip() for r in got if r.page_idx == 1] == ["upright", "Block number 0", "Block number 1", "Block number 2"]


def test_middle_form_of_a_layout(spark, layout, tmp_path):
    empty = spark.createDataFrame([(1, 0), (1, 1), (1, 2)], "doc_id bigint, page_idx bigint")
    folder = str(tmp_path / "middle")
    sinks.write_middle(sinks.middle_documents(layout_middle(layout, F.lit(W), F.lit(H), empty), "pipeline", "1"), folder)
    doc, = files.read_middle(spark, folder).collect()
    one, two, three = doc.pdf_info
    assert [b.type for b in one.preproc_blocks] == ["title", "text", "image", "table", "interline_equation", "text", "text"]
    words = lambda b: [s.content for line in b.lines for s in line.spans]
    assert words(one.para_blocks[1]) == ["A line that goes on", "and ends (here)."] and one.para_blocks[1].bbox == [40.0, 100.0, 450.0, 140.0]
    image = one.para_blocks[2]
    assert [b.type for b in image.blocks] == ["image_body", "image_caption"] and words(image.blocks[1]) == ["Figure 1"] and image.bbox == [40.0, 200.0, 300.0, 300.0]
    assert [words(b) for b in one.discarded_blocks] == [["page 7"]] and one.page_size == [600.0, 800.0]
    assert [s.score for s in one.para_blocks[5].lines[0].spans] == [0.877] and [words(b) for b in two.para_blocks][0] == ["upright"]
    assert (three.page_idx, three.preproc_blocks, three.para_blocks, three.discarded_blocks) == (2, [], [], [])


def test_words_over_a_page_break_are_marked(spark):
    p = Pages()
    p.box(TEXT, 48, 600, 352, 680)
    for k in range(4):
        p.words("a line that has forty characters in it,a"[:38], 50, 602 + 18 * k)
    p.box(TEXT, 48, 100, 352, 180, page=1)
    for k in range(4):
        p.words("and then goes on over the page break a"[:38], 50, 102 + 18 * k, page=1)
    dets, chars, lines = p.frames(spark)
    layout = page_layout(dets, F.lit(W), F.lit(H), ocr_on=False, text_layer=TextLayer(chars, lines))
    pages = {r.page_idx: r.page for r in layout_middle(layout, F.lit(W), F.lit(H)).collect()}
    moved = [[s.cross_page for s in line.spans] for line in pages[0].para_blocks[0].lines]
    assert moved == [[None]] * 4 + [[True]] * 4
    assert not pages[1].para_blocks[0].lines and len(pages[1].preproc_blocks[0].lines) == 4
    texts = {(r.page_idx, r.record.text) for r in layout_content_list(layout, F.lit(W), F.lit(H)).collect()}
    assert (1, "") in texts and len(texts) == 2


def test_spans_outside_text_pass_and_unread_upright_ones_go(spark):
    spans = spark.createDataFrame(
        [(1, 0, 1, "text", 0, 0, 100, 10, 0.9, "mine"), (1, 0, 2, "text", 300, 0, 310, 200, 0.9, "x"), (1, 0, 3, "image", 0, 300, 100, 400, 0.9, ""),
         (1, 0, 4, "text", 10, 310, 90, 320, 0.9, "in a picture"), (1, 0, 5, "text", 0, 500, 100, 510, 0.9, "y")],
        "doc_id int, page_idx int, span_id int, type string, x0 int, y0 int, x1 int, y1 int, score double, content string")
    blocks = spark.createDataFrame([(1, 0, "text", 290, 0, 320, 210), (1, 0, "image_body", 0, 300, 100, 400), (1, 0, "text", 0, 490, 200, 520)],
                                   "doc_id int, page_idx int, type string, x0 int, y0 int, x1 int, y1 int")
    chars, lines = spark.createDataFrame([], CHARS), spark.createDataFrame([], LINES)
    out = SP.fill_text_layer(spans, chars, lines, blocks, blocks.limit(0))
    assert {(r.span_id, r.content, r.late, r.score) for r in out.collect()} == {
        (1, "mine", False, 0.9), (3, "", False, 0.9), (4, "in a picture", False, 0.9), (5, "", True, 1.0)}
    none = spans.limit(0)
    assert SP.fill_text_layer(none, chars, lines, blocks, blocks).count() == 0
    read = SP.apply_recognition(out, out.limit(0).withColumn("text", F.lit("z")))
    assert {(r.span_id, r.content, r.score) for r in read.where("late").collect()} == {(5, "", 0.0)}


def test_the_text_layer_must_be_given(spark, document):
    with pytest.raises(ValueError, match="text_layer"):
        page_layout(document.frames(spark)[0], F.lit(W), F.lit(H), ocr_on=False)
