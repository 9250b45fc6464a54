"""Reading and editing of table HTML, one table at a time (used inside tasks)."""

from __future__ import annotations

import html
import re

_TAG = re.compile(r"<(/?)(tr|td|th)\b([^>]*)>", re.IGNORECASE)
_ANY_TAG = re.compile(r"<[^>]*>")


def _attr(attrs: str, name: str) -> int:
    found = re.search(rf"\b{name}\s*=\s*[\"']?(\d+)", attrs, re.IGNORECASE)
    return int(found.group(1)) if found else 1


def read_rows(source: str) -> list[dict]:
    """Rows in order: ``start``/``end`` offsets and ``cells`` (offsets of the opening tag, spans, tag, text)."""
    rows, cell = [], None

    def close_cell(at: int) -> None:
        nonlocal cell
        if cell is not None:
            cell["text"] = html.unescape(_ANY_TAG.sub("", source[cell["tag_end"]:at]))
            cell = None

    def close_row(at: int) -> None:
        if rows and rows[-1]["end"] is None:
            rows[-1]["end"] = at

    for m in _TAG.finditer(source):
        closing, name = bool(m.group(1)), m.group(2).lower()
        if name == "tr":
            close_cell(m.start())
            if closing:
                close_row(m.end())
            else:
                close_row(m.start())
                rows.append({"start": m.start(), "end": None, "cells": []})
        else:
            close_cell(m.start())
            if not closing and rows and rows[-1]["end"] is None:
                cell = {"tag_start": m.start(), "tag_end": m.end(), "tag": name, "text": "",
                        "rowspan": _attr(m.group(3), "rowspan"), "colspan": _attr(m.group(3), "colspan")}
                rows[-1]["cells"].append(cell)
    close_cell(len(source))
    close_row(len(source))
    return rows


def place(rows: list[list[tuple[int, int]]]) -> tuple[list[list[int]], list[int]]:
    """Columns of cells given as (rowspan, colspan) per row, and the width reached in each row.

    A cell takes the first column that no cell from above holds.
    """
    held: dict[int, set[int]] = {}
    columns = []
    for r, row in enumerate(rows):
        at, placed = 0, []
        for rowspan, colspan in row:
            while at in held.get(r, ()):
                at += 1
            placed.append(at)
            for rr in range(r, r + rowspan):
                held.setdefault(rr, set()).update(range(at, at + colspan))
            at += colspan
        columns.append(placed)
    return columns, [max(held.get(r, {-1})) + 1 for r in range(len(rows))]


def html_cells(source: str | None):
    """(row_no, cell_no, tag, r0, r1, c0, c1, text) of each cell of a table."""
    rows = read_rows(source or "")
    columns, _ = place([[(c["rowspan"], c["colspan"]) for c in row["cells"]] for row in rows])
    for r, (row, at) in enumerate(zip(rows, columns)):
        for k, (cell, c0) in enumerate(zip(row["cells"], at)):
            yield r, k, cell["tag"], r, r + cell["rowspan"] - 1, c0, c0 + cell["colspan"] - 1, cell["text"]


# ---- tables that go on over a page break

# Full-width forms and their ASCII twins, for comparing texts.
_NARROW = {c + 0xFEE0: c for c in range(0x21, 0x7F)}


def _squeezed(text: str) -> str:
    return "".join(text.translate(_NARROW).split())


class Table:
    """A parsed table: source, rows, width reached per row, total columns."""

    def __init__(self, source: str):
        self.source = source
        self.rows = read_rows(source)
        spans = [[(c["rowspan"], c["colspan"]) for c in row["cells"]] for row in self.rows]
        columns, self.widths = place(spans)
        self.columns = max((c + s[1] for at, row in zip(columns, spans) for c, s in zip(at, row)), default=0)

    def cells(self, r: int) -> list[dict]:
        return self.rows[r]["cells"]

    def span_sum(self, r: int) -> int:
        return sum(c["colspan"] for c in self.cells(r))

    def with_colspans(self, wanted: dict[tuple[int, int], int]) -> "Table":
        """The table with new colspans for cells (row, cell)."""
        source = self.source
        for (r, k), span in sorted(wanted.items(), reverse=True):
            cell = self.cells(r)[k]
            tag = source[cell["tag_start"]:cell["tag_end"]]
            if re.search(r"\bcolspan\b", tag, re.IGNORECASE):
                tag = re.sub(r"(\bcolspan\s*=\s*)(\"[^\"]*\"|'[^']*'|[^\s>]+)", rf'\g<1>"{span}"', tag, flags=re.IGNORECASE)
            else:
                tag = f'{tag[:-1]} colspan="{span}">'
            source = source[:cell["tag_start"]] + tag + source[cell["tag_end"]:]
        return Table(source)


def common_header_rows(a: Table, b: Table) -> int:
    """Leading rows alike in width reached, spans and squeezed text; if none, in
    width and text only."""

    def alike(r: int, spans: bool) -> bool:
        if a.widths[r] != b.widths[r] or len(a.cells(r)) != len(b.cells(r)):
            return False
        return all(
            _squeezed(p["text"]) == _squeezed(q["text"])
            and (not spans or (p["rowspan"], p["colspan"]) == (q["rowspan"], q["colspan"]))
            for p, q in zip(a.cells(r), b.cells(r)))

    limit = min(len(a.rows), len(b.rows))
    for spans in (True, False):
        n = next((r for r in range(limit) if not alike(r, spans)), limit)
        if n:
            return n
    return 0


def rows_fit(a: Table, b: Table) -> bool:
    """a's last row with cells and b's first row past the header agree in width reached, sum of
    spans or number of cells."""
    last = next((r for r in range(len(a.rows) - 1, -1, -1) if a.cells(r)), None)
    first = common_header_rows(a, b)
    if last is None or first >= len(b.rows):
        return False
    return (a.widths[last] == b.widths[first] or a.span_sum(last) == b.span_sum(first)
            or len(a.cells(last)) == len(b.cells(first)))


def _widened(table: Table, rows: range, model: Table, model_row: int, other_row: list[dict], target: int) -> Table:
    """Rows narrower than ``target``: those built like ``other_row`` take the model row's spans, others
    stretch their last cell."""
    spans = [c["colspan"] for c in model.cells(model_row)]
    wanted = {}
    for r in rows:
        cells = table.cells(r)
        if not cells or table.widths[r] >= target or table.span_sum(r) >= target:
            continue
        if len(cells) == len(spans) and [c["colspan"] for c in cells] == [c["colspan"] for c in other_row]:
            wanted.update({(r, k): s for k, s in enumerate(spans) if s > 1})
        else:
            wanted[r, len(cells) - 1] = cells[-1]["colspan"] + target - table.widths[r]
    return table.with_colspans(wanted) if wanted else table


def append_rows(first: str, second: str) -> str:
    """The second table's rows past the common header at the end of the first table's body."""
    a, b = Table(first), Table(second)
    header = common_header_rows(a, b)
    if a.rows and b.rows and header < len(b.rows):
        last = len(a.rows) - 1
        if a.columns >= b.columns:
            b = _widened(b, range(header, len(b.rows)), a, last, b.cells(header), a.columns)
        else:
            a = _widened(a, range(len(a.rows)), b, header, a.cells(last), b.columns)
    tail = "".join(b.source[row["start"]:row["end"]] for row in b.rows[header:])
    low = a.source.lower()
    at = low.find("</tbody>") if "<tbody" in low else low.find("</table>")
    return a.source if at < 0 else a.source[:at] + tail + a.source[at:]
