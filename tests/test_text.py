"""Text and formula clean-up, boundary cases."""

from pyspark.sql import functions as F

from pageloom.functions import latex as L
from pageloom.functions import text as X

FORMULAS = [
    (r"\frac{a}{b", r"\frac{a}b"),
    (r"} x {y}", r" x {y}"),
    (r"\left( x \right)", r"\left( x \right)"),
    (r"\left\{ x \right\}", r"\left\{ x \right\}"),
    (r"\leftarrow x", " x"),
    (r"{\left( x} \right)", r"{\left( x\right)} "),
    (r"\begin{array}{cc} a & b", r"\begin{array}{cc} a & b \end{array}"),
    (r"a \end{array}", r"\begin{array}{c} a \end{array}"),
    (r"\upalpha \uparrow \upsilon", r"\alpha \uparrow \upsilon"),
    (r"\emph{x} \Bar y", r"{x} \hat y"),
    (r"\1 \x \\x \, \ab", r"\ 1 \ x \\x \ , \ab"),
    (r"x\qquad y", r"x\qquad y"),
    (r"x\qquadz", r"x\qquad z"),
    ("x\\\\", "x"),
    (None, None),
]


def test_formulas(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(FORMULAS)], "k int, tex string")
    got = {r.k: r.clean for r in L.clean_formulas(df).collect()}
    assert [got[k] for k in range(len(FORMULAS))] == [w for _, w in FORMULAS]


def one(spark, fn, *values):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r.o for r in df.select("k", fn(F.col("v")).alias("o")).orderBy("k").collect()]


def test_code_fences(spark):
    assert one(spark, X.strip_code_fence, "```py\na\n```", "a\n```", "```\na", "a", "```", None) == ["a", "a", "a", "a", "", ""]


def test_inline_formulas(spark):
    got = one(spark, X.split_inline_formulas, r"a \(x\) b", r"\(x\)", r"a \(x", "", r"\(a\)\(b\) ")
    assert [[tuple(s) for s in g] for g in got] == [
        [("text", "a "), ("inline_equation", "x"), ("text", " b")], [("inline_equation", "x")], [("text", r"a \(x")], [("text", "")],
        [("inline_equation", "a"), ("inline_equation", "b")]]


def test_words_and_directions(spark):
    assert [[tuple(w) for w in g] for g in one(spark, X.word_runs, "你好 VGG-16, 1.5.")] == [[("你好", "cn"), ("VGG-16", "en&num"), ("1.5", "en&num")]]
    assert one(spark, X.right_to_left, "אב 12 ג") == ["ג 12 בא"]


def test_names(spark):
    assert one(spark, X.safe_file_name, "../a/b?.pdf", "...", ".x", "報告 1.pdf") == ["ab_.pdf", "unnamed", "_x", "報告_1.pdf"]
    assert one(spark, X.safe_stem, "/in/my-file 2.tar.gz", "x") == ["my_file_2.tar", "x"]
    assert one(spark, X.parse_list, "a, 'b'\n\"c\" ,, d") == [["a", "b", "c", "d"]]


def test_cjk(spark):
    assert one(spark, X.is_cjk, "hello", "漢字かな", "", "漢 abcdefghij") == [False, True, False, False]


ODD = ["", " ", "a", "1", " 1a2 ", "a1\n", "a1\r\n", "1\r\n\n", "\u0660x\u0661", "\u00a0a\u00a0", "a\u00a0 ", " \u3000漢字かなカナ한글ᄀ\u3000", "\U00020000\U0001F600\u2e80", "Ａｂ１！ｚ",
       "\tA\x0b\x0c b\x1c", "\x1fé ", "éa", "É", "\U0001D400x", "\U0001D41Ax", "ﾊﾝ ﾡ\u10ff\u1100", "é\u2028", "1\u2028", "a\x851\x85", None]


def test_short_ways_equal_the_patterns(spark):
    """Texts are first looked at in cheap ways; what comes out is what the patterns say of the whole text."""
    from pageloom.operators.paragraphs import line_marks, span_marks

    df = spark.createDataFrame([(k, t) for k, t in enumerate(ODD)], "k int, txt string")
    t, trimmed = F.col("txt"), F.trim("txt")
    cjk = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]"
    letters = "".join(c for c in map(chr, range(0x21, 0x7F)) if c.isalnum())
    pairs = {
        "strip": (X.strip(t), F.regexp_replace(t, r"(?U)^\s+|\s+\z", "")),
        "half": (X.full_to_half_letters(t), F.translate(t, "".join(chr(ord(c) + X.FULL_WIDTH_OFFSET) for c in letters), letters)),
        "cjk": (X.count_cjk(t), F.regexp_count(t, F.lit(cjk))),
        "solid": (X.count_solid(t), F.length(F.regexp_replace(t, X.BLANK, ""))),
        "digit_first": (F.col("marks.digit_first"), trimmed.rlike(r"^\p{Nd}")),
        "digit_last": (F.col("marks.digit_last"), trimmed.rlike(r"\p{Nd}$")),
        "opens_new": (F.col("marks.opens_new"), t.rlike(r"^[\p{Nd}\p{Lu}]")),
        "lower": (F.col("marks.lower"), F.coalesce(t.rlike(r"^\p{Ll}"), F.lit(False))),
        "span_lower": (span_marks(F.lit("text"), t)["lower"], F.coalesce(t.rlike(r"^\p{Ll}"), F.lit(False))),
    }
    for r in line_marks(df).select("txt", *(F.array(a, b).alias(k) for k, (a, b) in pairs.items())).collect():
        for k in pairs:
            assert r[k][0] == r[k][1], (k, r.txt, r[k])
