"""Tables that go on over a page break, and table HTML."""

from pageloom.functions import html_tables as H
from pageloom.operators import folds

HEAD = "<tr><td>a</td><td>b</td></tr>"


def page(no, html, captions=0, continued=False, notes=(), x1=100):
    return {"doc_id": 1, "page_idx": no, "block_id": no, "html": html, "footnotes": list(notes), "x0": 0, "x1": x1,
            "n_captions": captions, "continued": continued, "run": 1}


def table(*rows):
    return "<table>" + "".join(rows) + "</table>"


def merged(*pages):
    return [(r["html"], r["footnotes"], r["merged_away"]) for r in folds.merge_run(list(pages))]


def test_three_pages_become_one_table():
    r = ["<tr><td>1</td><td>2</td></tr>", "<tr><td>3</td><td>4</td></tr>", "<tr><td>5</td><td>6</td></tr>"]
    got = merged(page(0, table(HEAD, r[0])), page(1, table(HEAD, r[1])), page(2, table(HEAD, r[2]), notes=["n"]))
    assert got[0] == (table(HEAD, *r), ["n"], False)
    assert [g[2] for g in got] == [False, True, True]


def test_rows_add_up():
    a, b = table(HEAD, "<tr><td>1</td><td>2</td></tr>"), table(HEAD, "<tr><td>3</td><td>4</td></tr>", "<tr><td>5</td><td>6</td></tr>")
    n = len(H.read_rows(a)) + len(H.read_rows(b)) - H.common_header_rows(H.Table(a), H.Table(b))
    assert len(H.read_rows(H.append_rows(a, b))) == n


def test_foreign_caption_and_notes_keep_tables_apart():
    a, b = table(HEAD, "<tr><td>1</td><td>2</td></tr>"), table(HEAD, "<tr><td>3</td><td>4</td></tr>")
    assert not merged(page(0, a), page(1, b, captions=1))[1][2]
    assert merged(page(0, a), page(1, b, captions=1, continued=True))[1][2]
    assert not merged(page(0, a, notes=["x"]), page(1, b))[1][2]
    assert merged(page(0, a, notes=["x"]), page(1, b, captions=1, continued=True))[0][1] == []
    assert not merged(page(0, a, notes=["x", "y"]), page(1, b, captions=1, continued=True))[1][2]
    assert not merged(page(0, a), page(1, b, x1=80))[1][2]


def test_narrow_rows_stretch():
    a = table("<tr><td>1</td><td>2</td><td>3</td></tr>")
    b = table("<tr><td>4</td><td>5</td></tr>", "<tr><td>6</td><td>7</td><td>8</td></tr>")
    got = H.append_rows(a, b)
    assert '<tr><td>4</td><td colspan="2">5</td></tr>' in got


def test_rowspan_over_the_page_break():
    a = table(HEAD, '<tr><td rowspan="2">1</td><td>2</td></tr>')
    b = table(HEAD, "<tr><td>3</td><td>4</td></tr>")
    joined = H.Table(H.append_rows(a, b))
    assert joined.columns == 3 and len(joined.rows) == 3


def test_body_tag_and_attributes_survive():
    a = '<table border="1"><tbody><tr><td COLSPAN=\'2\'>x</td></tr></tbody></table>'
    got = H.append_rows(a, table("<tr><td>1</td><td>2</td></tr>"))
    assert got.endswith("<tr><td>1</td><td>2</td></tr></tbody></table>") and got.startswith('<table border="1">')


def test_cells_of_html():
    html = '<table><thead><tr><th>A &amp; B</th><th rowspan=2>c</th></tr></thead><tr><td><b>d</b></td></tr></table>'
    assert [(c[0], c[2], c[3], c[4], c[5], c[7]) for c in H.html_cells(html)] == [
        (0, "th", 0, 0, 0, "A & B"), (0, "th", 0, 1, 1, "c"), (1, "td", 1, 1, 0, "d")]
    assert list(H.html_cells(None)) == [] and list(H.html_cells("no table")) == []
