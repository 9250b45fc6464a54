r"""LaTeX clean-up: regular steps as Column expressions, brace and \left/\right matching by Arrow UDF."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Delimiters that may follow \left and \right.
DELIMITERS = [
    "(", ")", "[", "]", "{", "}", "/", "|", r"\{", r"\}", r"\lceil", r"\rceil", r"\lfloor", r"\rfloor",
    r"\backslash", r"\uparrow", r"\downarrow", r"\Uparrow", r"\Downarrow", r"\|", r"\.",
]
# Environments that are balanced.
ENVIRONMENTS = [
    "array", "matrix", "pmatrix", "bmatrix", "vmatrix", "Bmatrix", "Vmatrix", "cases", "aligned", "gathered", "align", "align*",
]
# Words that keep their \up prefix.
UP_WORDS = ["arrow", "downarrow", "lus", "silon"]
# Commands without support, removed.
UNSUPPORTED = [
    "lefteqn", "boldmath", "ensuremath", "centering", "textsubscript", "sides", "textsl", "textcent", "emph", "protect", "null",
]
# Commands and what replaces them.
REPLACED = [
    (r"\underbar", r"\underline"), (r"\Bar", r"\hat"), (r"\Hat", r"\hat"), (r"\Tilde", r"\tilde"), (r"\slash", "/"),
    (r"\textperthousand", "‰"), (r"\sun", "☉"), (r"\textunderscore", r"\_"), (r"\fint", "⨏"), (r"\up ", r"\ "),
    (r"\vline = ", r"\models "), (r"\vDash ", r"\models "), (r"\sq \sqcup ", r"\square "), (r"\copyright", "©"),
]
# Characters before which a backslash stands alone.
PLAIN_AFTER_BACKSLASH = "#$%&~_^|\\{} \t\n\r\v\f"

# An escape is one unit, so a brace behind an odd number of backslashes never shows up alone.
_UNITS = re.compile(r"\\left(?=.)|\\right(?=.)|\\.|[{}]", re.DOTALL)


def _loose_braces(tex: str) -> str:
    """Braces without a partner taken out."""
    opened, loose = [], []
    for m in re.finditer(r"\\.|[{}]", tex, re.DOTALL):
        if m.group() == "{":
            opened.append(m.start())
        elif m.group() == "}":
            if opened:
                opened.pop()
            else:
                loose.append(m.start())
    drop = set(loose + opened)
    return "".join(c for k, c in enumerate(tex) if k not in drop) if drop else tex


def _group_end(tex: str, start: int) -> int:
    """Where the brace group around ``start`` closes, or -1."""
    level = 0
    for m in re.finditer(r"\\.|[{}]", tex[start:], re.DOTALL):
        level += {"{": 1, "}": -1}.get(m.group(), 0)
        if level < 0:
            return start + m.start()
    return -1


def _pairs_in_one_group(tex: str) -> str:
    r"""Each \right in another brace depth than its \left moves to the end of the \left's group."""
    depth, lefts, moves, at = 0, [], [], 0
    while (m := _UNITS.search(tex, at)) is not None:
        unit, at = m.group(), m.end()
        if unit == "{":
            depth += 1
        elif unit == "}":
            depth = max(depth - 1, 0)
        elif unit == r"\left":
            lefts.append((m.start(), depth))
            at += 2 if tex[at] == "\\" else 1
        elif unit == r"\right":
            if lefts:
                left, left_depth = lefts.pop()
                target = _group_end(tex, left) if left_depth != depth else -1
                if target != -1:
                    moves.append((m.start(), m.end() + 1, target))
            at += 2 if tex[at] == "\\" else 1
    if not moves:
        return tex
    units = list(tex)
    for start, end, target in reversed(moves):
        moved = "".join(units[start:end])
        del units[start:end]
        units.insert(target, moved)
    return "".join(units)


def _each(fn, tex: Column) -> Column:
    """``fn`` over a column, in Arrow batches; nulls stay."""

    def batch(values: pd.Series) -> pd.Series:
        return values.map(fn, na_action="ignore")

    return F.pandas_udf(batch, "string")(tex)


def _count(tex: Column, pattern: str) -> Column:
    return F.regexp_count(tex, F.lit(pattern))


def drop_loose_braces(tex: Column) -> Column:
    """UF4: braces without a partner go."""
    return _each(_loose_braces, tex)


def valid_delimiters(tex: Column) -> Column:
    r"""A dot in place of whatever follows \left or \right, unless that is a delimiter."""
    allowed = "|".join(re.escape(d) for d in sorted(DELIMITERS, key=len, reverse=True))
    for command in ("left", "right"):
        tex = F.regexp_replace(tex, rf"\\{command}(?!(?:{allowed})(?:\s|\z))\S*", rf"\\{command}.")
    return tex


def balance_left_right(tex: Column) -> Column:
    r"""UF4: as many \left as \right are put into one brace group each, else all are taken off."""
    same = _count(tex, r"\\left(?![a-zA-Z])") == _count(tex, r"\\right(?![a-zA-Z])")
    return F.when(same, _each(_pairs_in_one_group, tex)).otherwise(F.regexp_replace(tex, r"\\left\.?|\\right\.?", ""))


def balance_environments(tex: Column) -> Column:
    r"""Missing \begin before, missing \end behind; an array's column format is kept, else {c}.

    What one environment lacks does not depend on the others, so all are counted on the same text. The
    starred name acts as a pattern (any number of final n) that plain ``align`` has balanced already.
    """
    before, after = [], []
    for name in ENVIRONMENTS:
        pattern = "alig(?:n{2,})?" if name == "align*" else name
        begins, ends = _count(tex, rf"\\begin\{{{pattern}\}}"), _count(tex, rf"\\end\{{{pattern}\}}")
        found = F.regexp_extract(tex, rf"\\begin\{{{pattern}\}}(\{{[^}}]*\}})", 1)
        form = F.when(found != "", found).otherwise(F.lit("{c}" if name == "array" else ""))
        before.insert(0, F.repeat(F.concat(F.lit(f"\\begin{{{name}}}"), form, F.lit(" ")), F.greatest(ends - begins, F.lit(0))))
        after.append(F.repeat(F.lit(f" \\end{{{name}}}"), F.greatest(begins - ends, F.lit(0))))
    marked = tex.contains("\\begin{") | tex.contains("\\end{")
    return F.when(marked, F.concat(*before, tex, *after)).otherwise(tex)


def drop_up_prefix(tex: Column) -> Column:
    r"""\upalpha becomes \alpha; the words that need their prefix keep it."""
    kept = "|".join(UP_WORDS)
    return F.regexp_replace(tex, rf"\\up(?!(?:{kept})(?![a-zA-Z]))([a-zA-Z]+)", r"\\$1")


def drop_unsupported(tex: Column) -> Column:
    return F.regexp_replace(tex, r"\\(?:" + "|".join(UNSUPPORTED) + ")", "")


def replace_commands(tex: Column) -> Column:
    for old, new in REPLACED:
        tex = F.replace(tex, F.lit(old), F.lit(new))
    return tex


def space_backslashes(tex: Column) -> Column:
    r"""A backslash before a lone letter, digit or other mark gets a blank; \qquad is followed by one."""
    plain = re.escape(PLAIN_AFTER_BACKSLASH)
    return F.regexp_replace(tex, rf"(?<!\\)((?:\\\\)*)\\(?![{plain}])(?![a-zA-Z][a-zA-Z])(?=.)", r"$1\\ ")


def _through(df: DataFrame, source: str, out: str, *steps) -> DataFrame:
    """Steps as successive columns, so that none is expanded inside the next."""
    df = df.withColumn(out, F.col(source))
    for step in steps:
        df = df.withColumn(out, step(F.col(out)))
    return df


def clean_formulas(df: DataFrame, source: str = "tex", out: str = "clean") -> DataFrame:
    """FN12: all steps in order."""
    return _through(
        df, source, out, drop_loose_braces, valid_delimiters, balance_left_right, balance_environments,
        lambda t: replace_commands(drop_unsupported(drop_up_prefix(t))),
        lambda t: F.regexp_replace(F.regexp_replace(space_backslashes(t), r"\\qquad(?!\s)", r"\\qquad "), r"\\+\z", ""))


def clean_recognised_formulas(df: DataFrame, source: str = "tex", out: str = "clean") -> DataFrame:
    r"""FN13: \text around Han characters unwrapped, quotes dropped, then the short chain."""
    return _through(
        df, source, out,
        lambda t: F.replace(F.regexp_replace(t, r"\\text\s*\{\s*([^}]*?[\x{4e00}-\x{9fff}]+[^}]*?)\s*\}", "$1"), F.lit('"'), F.lit("")),
        balance_left_right, balance_environments, lambda t: drop_unsupported(drop_up_prefix(t)))
