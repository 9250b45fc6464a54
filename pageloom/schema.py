"""Row shapes and code tables.

Input rows carry surrogate ids; nothing is compared by value.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Detection categories.
TITLE, TEXT, ABANDON, IMAGE_BODY, IMAGE_CAPTION = 0, 1, 2, 3, 4
TABLE_BODY, TABLE_CAPTION, TABLE_FOOTNOTE = 5, 6, 7
EQUATION_LAYOUT, EQUATION_NUMBER = 8, 9
INLINE_EQUATION, EQUATION_DETECTED, OCR_TEXT, LOW_SCORE_TEXT = 13, 14, 15, 16
IMAGE_FOOTNOTE = 101

# Category -> (block type, span type).
CATEGORY_TYPES = {
    0: ("title", None),
    1: ("text", None),
    2: ("discarded", None),
    3: ("image_body", "image"),
    4: ("image_caption", None),
    5: ("table_body", "table"),
    6: ("table_caption", None),
    7: ("table_footnote", None),
    8: ("interline_equation", None),
    13: (None, "inline_equation"),
    14: ("interline_equation", "interline_equation"),
    15: (None, "text"),
    101: ("image_footnote", None),
}

# Which blocks may take which spans.
SPAN_FITS = {
    "text": ["text", "title", "image_caption", "image_footnote", "table_caption", "table_footnote", "discarded"],
    "inline_equation": [
        "text", "title", "image_caption", "image_footnote", "table_caption", "table_footnote", "discarded"],
    "interline_equation": ["interline_equation", "text"],
    "image": ["image_body"],
    "table": ["table_body"],
}

TEXT_LIKE_BLOCKS = ["text", "title", "image_caption", "image_footnote", "table_caption", "table_footnote"]
BODY_BLOCKS = ["image_body", "table_body", "interline_equation"]

# Block type of a language-model block -> (block type, span type).
MODEL_BLOCK_TYPES = {
    "text": ("text", "text"),
    "title": ("title", "text"),
    "image_caption": ("image_caption", "text"),
    "image_footnote": ("image_footnote", "text"),
    "table_caption": ("table_caption", "text"),
    "table_footnote": ("table_footnote", "text"),
    "code_caption": ("code_caption", "text"),
    "ref_text": ("ref_text", "text"),
    "phonetic": ("phonetic", "text"),
    "header": ("header", "text"),
    "footer": ("footer", "text"),
    "page_number": ("page_number", "text"),
    "aside_text": ("aside_text", "text"),
    "page_footnote": ("page_footnote", "text"),
    "list": ("list", "text"),
    "image": ("image_body", "image"),
    "table": ("table_body", "table"),
    "code": ("code_body", "text"),
    "algorithm": ("code_body", "text"),
    "equation": ("interline_equation", "interline_equation"),
}

# Noise strings that recognisers emit on thin boxes.
NOISE_TEXTS = [
    "（204号", "（20", "（2", "（2号", "（20号", "号", "（204",
    "(cid:)", "(ci:)", "(cd:1)", "cd:)", "c)", "(cd:)", "c", "id:)",
    ":)", "√:)", "√i:)", "−i:)", "−:", "i:)",
]

POLY = T.ArrayType(T.DoubleType())

DETECTION = T.StructType([
    T.StructField("category_id", T.IntegerType()),
    T.StructField("poly", POLY),
    T.StructField("score", T.DoubleType()),
    T.StructField("latex", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("text", T.StringType()),
])

PAGE_INFO = T.StructType([
    T.StructField("page_no", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
])

PAGE_RESULT = T.StructType([
    T.StructField("layout_dets", T.ArrayType(DETECTION)),
    T.StructField("page_info", PAGE_INFO),
])

MODEL_BLOCK = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("bbox", T.ArrayType(T.DoubleType())),
    T.StructField("angle", T.IntegerType()),
    T.StructField("content", T.StringType()),
])

BBOX = T.ArrayType(T.DoubleType())

SPAN = T.StructType([
    T.StructField("bbox", BBOX),
    T.StructField("type", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("latex", T.StringType()),
    T.StructField("image_path", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("cross_page", T.BooleanType()),
])

LINE = T.StructType([
    T.StructField("bbox", BBOX),
    T.StructField("spans", T.ArrayType(SPAN)),
    T.StructField("index", T.DoubleType()),
])

INNER_BLOCK = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("bbox", BBOX),
    T.StructField("index", T.DoubleType()),
    T.StructField("lines", T.ArrayType(LINE)),
])

BLOCK = T.StructType([
    *INNER_BLOCK.fields,
    T.StructField("blocks", T.ArrayType(INNER_BLOCK)),
])

PAGE = T.StructType([
    T.StructField("preproc_blocks", T.ArrayType(BLOCK)),
    T.StructField("para_blocks", T.ArrayType(BLOCK)),
    T.StructField("discarded_blocks", T.ArrayType(BLOCK)),
    T.StructField("page_idx", T.LongType()),
    T.StructField("page_size", T.ArrayType(T.DoubleType())),
])

MIDDLE = T.StructType([
    T.StructField("pdf_info", T.ArrayType(PAGE)),
    T.StructField("_backend", T.StringType()),
    T.StructField("_version_name", T.StringType()),
])
