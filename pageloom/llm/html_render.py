"""HTML extraction by layout-aware rendering: all visible text of a page, spaced as a reader would see it.

A small tree builder closes tags that HTML lets authors leave out, visibility rules drop what is not shown, and a renderer lays
out the rest: paragraphs and headings are set apart by an empty line, other blocks start a new line, list items get a bullet or
number and are indented, and table cells are padded to columns. Each page is one row and one call; pages share nothing.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import decoded

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
BLANKS = re.compile(r"[ \t\n\r\f]+")
MOST_DEPTH = 256  # elements nested deeper hang on the one at this depth, as browsers do; no text is lost

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template iframe noembed noframes title datalist object audio video canvas svg math".split())
BLOCK = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                   "h6 header hgroup html legend li main menu nav ol optgroup option p pre search section summary table ul").split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul menu".split())
ENDS_P = BLOCK - frozenset("body html li dd dt option optgroup legend".split()) | frozenset(["hr"])
CELLS, ROWS = frozenset(["td", "th"]), frozenset(["thead", "tbody", "tfoot"])
# a start tag closes the open elements named, unless one of the bounds is nearer
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")), "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)), "tr": (("tr", "td", "th"), ("table",)),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (("thead", "tbody", "tfoot", "tr", "td", "th", "caption"), ("table",))),
    **dict.fromkeys((f"h{k}" for k in range(1, 7)), (tuple(f"h{k}" for k in range(1, 7)), ("div", "section", "article", "td", "th", "li", "body"))),
    "body": (("head",), ()),
}
P_BOUNDS = frozenset("button caption html marquee object table td th template".split())


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []


def attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def build(source: str) -> tuple[Node, list[str]]:
    """Tree of the page and the contents of its style elements."""
    root = Node("html", {})
    stack, styles, at = [root], [], 0

    def close(names, bounds=()) -> bool:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                del stack[k:]
                return True
            if stack[k].tag in bounds:
                return False
        return False

    def say(text: str) -> None:
        if text:
            if stack[-1].tag == "head" and text.strip():
                stack.pop()
            stack[-1].kids.append(html.unescape(text) if "&" in text else text)

    while at < len(source):
        m = TOKEN.search(source, at)
        if not m:
            say(source[at:])
            break
        say(source[at:m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if name == "p" and not close(("p",), P_BOUNDS):
                stack[-1].kids.append(Node("p", {}))
            elif name == "br":
                stack[-1].kids.append(Node("br", {}))
            elif name not in ("p", "html", "body"):
                close((name,), () if name in ("table", "div") else ("table",) if name in CELLS | ROWS | {"tr", "li"}
                      else CELLS if name in BLOCK else BLOCK | CELLS)  # a block that is still open outlives the inline element around it
            continue
        raw = m[3] if m[2] else m[6]
        if name in ("html", "body"):
            close(("head",))
            target = root if name == "html" else Node(name, {})
            for key, value in attributes(raw).items():
                root.attrs.setdefault(key, value) if name == "body" else target.attrs.setdefault(key, value)
            continue
        if stack[-1].tag == "head" and name not in ("title", "meta", "link", "base", "style", "script", "noscript", "template"):
            stack.pop()
        if name in ENDS_P:
            close(("p",), P_BOUNDS)
        if name in CLOSES:
            names, bounds = CLOSES[name]
            while close(names, bounds):
                pass
        node = Node(name, attributes(raw) if raw.strip() else {})
        stack[-1].kids.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
            inner = source[at:end.start() if end else len(source)]
            at = end.end() if end else len(source)
            if name == "style":
                styles.append(inner)
            elif name in ("textarea", "xmp"):
                node.kids.append(html.unescape(inner) if name == "textarea" else inner)
        elif name not in VOID and not (raw.endswith("/") and name not in BLOCK and name in ("path", "use", "g")) and len(stack) < MOST_DEPTH:
            stack.append(node)
    return root, styles


Rank = tuple[bool, int, int]  # important, specificity, place
#: part of a selector -> (rank, tag, classes, id, property, value) of the declarations under it
Rules = dict[str, list[tuple[Rank, str, frozenset[str], str, str, str]]]
COMPOUND = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+)*)")
LOOKED_AT = ("display", "visibility")
INLINE = 1 << 20  # specificity of a style attribute


def declarations(body: str) -> Iterator[tuple[str, bool, str]]:
    """(property, important, value) of display and visibility, in order."""
    for part in body.split(";"):
        name, _, value = part.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        if name in LOOKED_AT:
            value, bang, _ = value.partition("!")
            if re.fullmatch(r"[a-z -]+", value.strip()):
                yield name, bool(bang), value.strip()


def for_screen(query: str) -> bool:
    """A media list that holds for a screen of any size."""
    return any(re.fullmatch(r"\s*(only\s+)?(all|screen)\s*", q) for q in query.lower().split(",")) or not query.strip()


def style_rules(sheet: str) -> Iterator[tuple[str, str]]:
    """(selectors, body) of a style sheet, those inside at-rules that hold for a screen too; other at-rules are left out."""
    at = 0
    while at < len(sheet):
        m = re.compile(r"[{;}]").search(sheet, at)
        if not m:
            return
        prelude, at = sheet[at:m.start()].strip(), m.end()
        if m[0] != "{":
            continue
        depth, start = 1, at
        for b in re.compile(r"[{}]").finditer(sheet, at):
            depth += 1 if b[0] == "{" else -1
            if not depth:
                break
        end = b.start() if not depth else len(sheet)
        body, at = sheet[start:end], end + 1
        if not prelude.startswith("@"):
            yield prelude, body
        else:
            name, _, query = prelude[1:].partition(" ")
            if name.lower() in ("layer", "supports") or name.lower().partition("(")[0] == "media" and for_screen(prelude[6:]):
                yield from style_rules(body)


def read_rules(styles: list[str]) -> Rules:
    """Declarations of display and visibility under selectors of a tag, classes and an id; others (descendants, states) are left out."""
    found: Rules = {}
    place = 0
    for sheet in styles:
        if "display" not in sheet and "visibility" not in sheet:
            continue
        for selectors, body in style_rules(re.sub(r"/\*.*?(\*/|\Z)|<!--|-->", "", sheet, flags=re.S)):
            declared = list(declarations(body))
            for selector in selectors.split(",") if declared else ():
                m = COMPOUND.fullmatch(selector.strip())
                if not m or not selector.strip():
                    continue
                parts = re.findall(r"[.#][\w-]+", m[2])
                tag = "" if m[1] in (None, "*") else m[1].lower()
                classes = frozenset(x[1:] for x in parts if x[0] == ".")
                ids = [x[1:] for x in parts if x[0] == "#"]
                weight = 10_000 * len(ids) + 100 * len(classes) + bool(tag)
                key = "#" + ids[0] if ids else "." + min(classes) if classes else tag or "*"
                for name, important, value in declared:
                    place += 1
                    found.setdefault(key, []).append(((important, weight, place), tag, classes, ids[0] if ids else "", name, value))
    return found


def styled(node: Node, rules: Rules) -> dict[str, str]:
    """Declared display and visibility of an element: the important one, then the most specific, then the last wins."""
    best: dict[str, tuple[Rank, str]] = {}
    a = node.attrs
    if rules:
        classes = frozenset(a.get("class", "").split())
        for key in ("*", node.tag, "#" + a.get("id", ""), *("." + c for c in classes)):
            for rank, tag, wanted, id_, name, value in rules.get(key, ()):
                if tag in ("", node.tag) and wanted <= classes and id_ in ("", a.get("id")) and (name not in best or rank > best[name][0]):
                    best[name] = rank, value
    if "style" in a:
        for place, (name, important, value) in enumerate(declarations(a["style"])):
            rank = (important, INLINE, place)
            if name not in best or rank > best[name][0]:
                best[name] = rank, value
    return {name: value for name, (_, value) in best.items()}


def visible(node: Node, rules: Rules, seen: bool = True) -> tuple[bool, bool]:
    """(there at all, its own text is seen). A hidden element has no place; one that is not seen may have children that are."""
    if node.tag in UNSEEN:
        return False, False
    a = node.attrs
    style = styled(node, rules) if rules or "style" in a else {}
    display, visibility = style.get("display"), style.get("visibility")
    if display == "none" or (display is None and ("hidden" in a or (node.tag == "dialog" and "open" not in a))):
        return False, False
    if visibility in ("hidden", "collapse"):
        seen = False
    elif visibility in ("visible", "initial"):
        seen = True
    return True, seen


class Lines:
    """Text in the making: finished lines and the open one. Blank lines are kept one at a time, never first."""

    def __init__(self):
        self.done: list[str] = []
        self.open: list[str] = []
        self.gap = self.blank = False

    def add(self, text: str) -> None:
        """Inline text; runs of white space become one space, none at the start of a line."""
        flat = BLANKS.sub(" ", text)
        if not self.open:
            flat = flat.lstrip(" ")
        elif self.blank and flat[:1] == " ":
            flat = flat[1:]
        if flat:
            self._begin()
            self.open.append(flat)
            self.blank = flat[-1] == " "

    def keep(self, text: str) -> None:
        """Preformatted text."""
        for k, part in enumerate(text.replace("\r\n", "\n").split("\n")):
            if k:
                self.end(force=True)
            if part:
                self._begin()
                self.open.append(part)
                self.blank = False

    def _begin(self) -> None:
        if self.gap and not self.open and self.done:
            self.done.append("")
        self.gap = False

    def end(self, force: bool = False) -> None:
        if self.open or force:
            self.done.append("".join(self.open).rstrip())
            self.open, self.blank = [], False

    def space(self) -> None:
        self.end()
        self.gap = True

    def block(self, lines: list[str]) -> None:
        self.end()
        if lines:
            self._begin()
            self.done += lines


def lay_out(node: Node, out: Lines, rules: Rules, seen: bool, pre: bool = False, depth: int = 0) -> None:
    number = _first_number(node)
    folded = node.tag == "details" and "open" not in node.attrs
    for kid in node.kids:
        if isinstance(kid, str):
            if seen and not folded:
                out.keep(kid) if pre else out.add(kid)
            continue
        tag = kid.tag
        there, own = visible(kid, rules, seen)
        if not there or (folded and tag != "summary"):
            continue
        if tag == "br":
            out.end(force=True)
        elif tag == "hr":
            out.space()
        elif tag == "table":
            out.space()
            out.block(table(kid, rules, own, depth + 1))
            out.space()
        elif tag == "li":
            if number is not None:
                number = _whole(kid.attrs.get("value"), number)
                mark, number = f"{number}. ", number + 1
            else:
                mark = "* "
            inner = rendered(kid, rules, own, pre, depth + 1)
            mark = mark if own else " " * len(mark)
            out.block([(mark if k == 0 else " " * len(mark)) + x if x else x for k, x in enumerate(inner or [""])] if inner else [])
        elif tag == "blockquote" or tag == "dd":
            if tag in SPACED:
                out.space()
            out.block(["  " + x if x else x for x in rendered(kid, rules, own, pre, depth + 1)])
            if tag in SPACED:
                out.space()
        elif tag in BLOCK:
            far = tag in SPACED and not (tag in ("ul", "ol", "menu") and node.tag == "li")
            out.space() if far else out.end()
            lay_out(kid, out, rules, own, pre or tag == "pre", depth + 1)
            out.space() if far else out.end()
        elif tag in CELLS:  # outside a table
            lay_out(kid, out, rules, own, pre, depth + 1)
            out.add(" ")
        elif tag == "tr" or tag in ROWS or tag == "caption":
            out.end()
            lay_out(kid, out, rules, own, pre, depth + 1)
            out.end()
        else:
            lay_out(kid, out, rules, own, pre or tag in ("textarea", "xmp"), depth + 1)


def _whole(value: str | None, other: int) -> int:
    return int(value) if value and re.fullmatch(r"-?\d{1,9}", value.strip()) else other


def _first_number(node: Node) -> int | None:
    return _whole(node.attrs.get("start"), 1) if node.tag == "ol" else None


def rendered(node: Node, rules: Rules, seen: bool, pre: bool = False, depth: int = 0) -> list[str]:
    out = Lines()
    lay_out(node, out, rules, seen, pre, depth)
    out.end()
    while out.done and not out.done[-1]:
        out.done.pop()
    return out.done


Row = list[tuple[Node, bool]]  # cells, and whether their own text is seen


def table_rows(node: Node, rules: Rules, seen: bool) -> tuple[list[list[Row]], Node]:
    """Rows of a table by section, as shown: heads, bodies, feet; and all else that stands in the table."""
    rest, sections = Node("div", {}), {"thead": [], "tbody": [], "tfoot": []}
    own: list[Row] = []  # rows without a section of their own

    def read(here: Node, into: list[Row], seen: bool) -> None:
        nonlocal own
        for kid in here.kids:
            if isinstance(kid, str):
                if kid.strip():
                    rest.kids.append(kid)
                continue
            there, shown = visible(kid, rules, seen)
            if not there:
                continue
            if kid.tag in ROWS:
                section: list[Row] = []
                sections[kid.tag].append(section)
                read(kid, section, shown)
                own = []
            elif kid.tag == "tr" or kid.tag in CELLS:
                if here is node:
                    if not own:
                        sections["tbody"].append(own)
                    into = own
                if kid.tag in CELLS:
                    into.append([(kid, shown)])
                    continue
                cells = [(c, *visible(c, rules, shown)) for c in kid.kids if not isinstance(c, str) and c.tag in CELLS]
                into.append([(c, x) for c, there, x in cells if there])
                rest.kids.extend(c for c in kid.kids if (c.strip() if isinstance(c, str) else c.tag not in CELLS))
            elif kid.tag not in ("col", "colgroup"):
                rest.kids.append(kid)

    read(node, own, seen)
    return sections["thead"] + sections["tbody"] + sections["tfoot"], rest


def table(node: Node, rules: Rules, seen: bool, depth: int) -> list[str]:
    """Rows with cells padded to the widest of their column, two spaces between columns; other content of the table comes first.

    A cell stands in the first column that no cell from above reaches; spans end with their section.
    """
    sections, rest = table_rows(node, rules, seen)
    grid: list[dict[int, list[str]]] = []
    for rows in sections:
        held: dict[int, int] = {}  # column -> row of the section from which it is free
        for r, row in enumerate(rows):
            at, placed = 0, {}
            for cell, shown in row:
                while held.get(at, 0) > r:
                    at += 1
                placed[at] = rendered(cell, rules, shown, False, depth + 1)
                down = _whole(cell.attrs.get("rowspan"), 1) or len(rows)
                for _ in range(min(max(_whole(cell.attrs.get("colspan"), 1), 1), 1000)):
                    held[at] = max(held.get(at, 0), r + max(down, 1))
                    at += 1
            grid.append(placed)
    widths = [0] * (max((k for cells in grid for k in cells), default=-1) + 1)
    for cells in grid:
        for k, lines in cells.items():
            widths[k] = max([widths[k], *map(len, lines)])
    out = rendered(rest, rules, seen, False, depth + 1)
    for cells in grid:
        for k in range(max(map(len, cells.values()), default=0)):
            out.append("  ".join((cells[j][k] if j in cells and k < len(cells[j]) else "").ljust(w) for j, w in enumerate(widths)).rstrip())
    return out


def page_text(source: str | None) -> str | None:
    """Visible text; "" for a page without any, null for null."""
    if source is None:
        return None
    root, styles = build(source)
    rules = read_rules(styles)
    there, seen = visible(root, rules)
    return "\n".join(rendered(root, rules, seen)) if there else ""


def render(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` plus ``text``; a column of that name is replaced. A null page gives null, an empty one an empty text."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([page_text(x) for x in decoded(batch)], pa.string())

    return pages.withColumn("text", run(F.col(column)))
