"""Text clean-up as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Full-width forms sit at one offset from their ASCII twins.
FULL_WIDTH_OFFSET = 0xFEE0
_ALL_MARKS = "".join(chr(c) for c in range(0x21, 0x7F))
_LETTERS_DIGITS = "".join(c for c in _ALL_MARKS if c.isalnum())

# Ligatures and their letters.
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "ft", "ﬆ": "st"}

# Marks that end a sentence or an item.
STOP_MARKS = [".", "!", "?", "。", "！", "？", ")", "）", '"', "”", ":", "：", ";", "；"]
ITEM_END_MARKS = [".", "。", ";", "；"]

# None of these scripts is below U+1100, and the range is tested before scripts are looked up.
CJK = r"[\x{1100}-\x{10FFFF}&&[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]]"


def _narrow(text: Column, chars: str) -> Column:
    return F.translate(text, "".join(chr(ord(c) + FULL_WIDTH_OFFSET) for c in chars), chars)


def full_to_half(text: Column) -> Column:
    """FN1: full-width letters, digits and marks to ASCII."""
    return _narrow(text, _ALL_MARKS)


def _is_ascii(text: Column) -> Column:
    """Most text is, and then needs no pattern of Unicode."""
    return F.octet_length(text) == F.length(text)


def full_to_half_letters(text: Column) -> Column:
    """FN2: letters and digits only."""
    return F.when(_is_ascii(text) | ~text.rlike(r"[\uFF10-\uFF5A]"), text).otherwise(_narrow(text, _LETTERS_DIGITS))


def count_cjk(text: Column) -> Column:
    """Han, Kana and Hangul characters."""
    return F.when(_is_ascii(text), 0).otherwise(F.regexp_count(text, F.lit(CJK)))


def ends_with_hyphen(text: Column) -> Column:
    """FN3: letters and a hyphen at the end."""
    return text.rlike(r"[A-Za-z]+-\s*$")


def expand_ligatures(text: Column) -> Column:
    """FN4."""
    for glyph, letters in LIGATURES.items():
        text = F.replace(text, F.lit(glyph), F.lit(letters))
    return text


def drop_control_marks(text: Column) -> Column:
    """FN5: no CR LF, and U+0002 is a soft hyphen."""
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("")), F.lit("\u0002"), F.lit("-"))


def escape_markdown(text: Column) -> Column:
    """FN6: backslash before * ` ~ $."""
    return F.regexp_replace(text, r"([*`~$])", r"\\$1")


BLANK = r"(?U)\s"  # any white space of Unicode, no-break and ideographic spaces too; the one definition of all operators


def strip(text: Column) -> Column:
    """White space off both ends, line breaks included."""
    plain = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    more = F.left(plain, F.lit(1)).rlike(BLANK) | F.right(plain, F.lit(1)).rlike(BLANK)
    return F.when(_is_ascii(text) | ~more, plain).otherwise(F.regexp_replace(text, r"(?U)^\s+|\s+\z", ""))


def count_solid(text: Column) -> Column:
    """Characters that are not blank."""
    ascii_only = text
    for blank in " \t\n\x0b\f\r":
        ascii_only = F.replace(ascii_only, F.lit(blank), F.lit(""))
    return F.length(F.when(_is_ascii(text), ascii_only).otherwise(F.regexp_replace(text, BLANK, "")))


def wrap_formula(tex: Column, display: bool = False, left: str | None = None, right: str | None = None) -> Column:
    """FN7: formula between delimiters, dollars by default; display form on lines of its own."""
    mark = "$$" if display else "$"
    left, right = left or mark, right or mark
    return F.concat(F.lit(f"\n{left}\n"), tex, F.lit(f"\n{right}\n")) if display else F.concat(F.lit(left), tex, F.lit(right))


def is_cjk(text: Column, share: float = 0.3) -> Column:
    """FN14: enough Han, Kana or Hangul among the characters that are not blank."""
    solid = F.length(F.regexp_replace(text, BLANK, ""))
    return F.coalesce(F.try_divide(F.regexp_count(text, F.lit(CJK)).cast("double"), solid.cast("double")) >= share, F.lit(False))


def strip_display_marks(tex: Column) -> Column:
    r"""FN8: no \[ at the start, no \] at the end."""
    return strip(F.regexp_replace(F.regexp_replace(tex, r"^\\\[", ""), r"\\\]\z", ""))


def strip_code_fence(code: Column) -> Column:
    """FN9: opening fence line and closing fence go."""
    body = F.regexp_replace(F.coalesce(code, F.lit("")), r"^```[^\r\n]*(\r?\n|$)", "")
    return strip(F.regexp_replace(body, r"(^|\r?\n)[ \t]*```[ \t]*(\r?\n)?$", ""))


def _count(text: Column, token: str) -> Column:
    return F.regexp_count(text, F.lit(token))


def unbracket(text: Column) -> Column:
    r"""FN10: \[x\] becomes [x], only where such marks balance."""
    opens, closes = _count(text, r"\\\["), _count(text, r"\\\]")
    return F.when((opens == closes) & (opens > 0), F.regexp_replace(text, r"\\\[(.*?)\\\]", r"[$1]")).otherwise(text)


def has_inline_formulas(text: Column) -> Column:
    r"""FN11: \( and \) balance and occur."""
    opens, closes = _count(text, r"\\\("), _count(text, r"\\\)")
    return (opens == closes) & (opens > 0)


INLINE = r"\\\((.+?)\\\)"


def split_inline_formulas(text: Column) -> Column:
    r"""FN11: array of (type, content): text pieces and the formulas between \( and \), in order.

    Blank text pieces are left out; text without balanced marks is one piece.
    """
    pieces, formulas = F.split(text, INLINE), F.regexp_extract_all(text, F.lit(INLINE), F.lit(1))

    def item(kind: str, content: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), content.alias("content"))

    woven = F.flatten(F.transform(
        F.arrays_zip(pieces.alias("p"), formulas.alias("f")),
        lambda z: F.array(item("text", z["p"]), item("inline_equation", strip(z["f"])))))
    kept = F.filter(woven, lambda s: s["content"].isNotNull() & ((s["type"] != "text") | (strip(s["content"]) != "")))
    return F.when(has_inline_formulas(text), kept).otherwise(F.array(item("text", text)))


def code_kind(kind: Column, text: Column) -> Column:
    """FN11: code that holds inline formulas is an algorithm."""
    return F.when((kind == "code") & has_inline_formulas(text), "algorithm").otherwise(kind)


def escape_html(text: Column) -> Column:
    """FN19: & first, then < and >, quotes included."""
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def trim_to_table(html: Column) -> Column:
    """FN17: first <table> to last </table>; anything else unchanged."""
    return F.when(html.contains("<table>") & html.contains("</table>"),
                  F.regexp_extract(html, r"(?s)(<table>.*</table>)", 1)).otherwise(html)


def safe_file_name(name: Column) -> Column:
    """FN16: path marks and runs of dots go, odd characters become _, never hidden or empty."""
    clean = F.regexp_replace(F.regexp_replace(name, r"[/\\.]{2,}|[/\\]", ""), r"[^\p{L}\p{N}_.\-]", "_")
    clean = F.regexp_replace(clean, r"^\.", "_")
    return F.when(clean == "", F.lit("unnamed")).otherwise(clean)


def safe_stem(path: Column) -> Column:
    """FN16, short form: last path part without its suffix, odd characters as _."""
    last = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.regexp_replace(F.regexp_replace(last, r"(?<=.)\.[^.]*$", ""), r"[^\p{L}\p{N}_.]", "_")


def parse_list(text: Column) -> Column:
    """FN18: items between commas and white space, one pair of quotes taken off, empty ones dropped."""
    bare = F.transform(F.split(text, r"[,\s]+"), lambda x: F.regexp_replace(
        x, r"""^"(.*)"$|^'(.*)'$""", "$1$2"))
    return F.filter(bare, lambda x: x != "")


LATIN_RUN = r"[a-zA-Z0-9 :*./%+\-]+|[^a-zA-Z0-9 :*./%+\-]"


def right_to_left(text: Column) -> Column:
    """FN20: characters reversed, runs of Latin letters, digits and common marks kept as they are."""
    return F.array_join(F.reverse(F.regexp_extract_all(text, F.lit(LATIN_RUN), F.lit(0))), "")


def word_runs(text: Column) -> Column:
    """FN21: Han runs and alphanumeric runs (decimal points and inner hyphens belong), in order."""
    words = F.regexp_extract_all(text, F.lit(r"[\x{4e00}-\x{9fff}]+|[a-zA-Z0-9](?:[a-zA-Z0-9\-]|\.[0-9])*"), F.lit(0))
    return F.transform(words, lambda w: F.struct(
        w.alias("word"), F.when(w.rlike(r"^[\x{4e00}-\x{9fff}]"), "cn").otherwise("en&num").alias("kind")))


def md5_upper(data: Column) -> Column:
    """FN15: MD5 of bytes in capitals."""
    return F.upper(F.md5(data))


def canonical_md5(record: Column, keys: list[str]) -> Column:
    """FN15: MD5 of a record as JSON with sorted keys and blanks after separators."""
    pairs = [F.concat(F.lit(f'"{k}": '), F.to_json(F.array(record[k])).substr(F.lit(2), F.length(F.to_json(F.array(record[k]))) - 2))
             for k in sorted(keys)]
    return F.md5(F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}")))
