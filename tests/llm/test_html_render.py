import random
from html.parser import HTMLParser

import pytest

from pageloom.llm.html_render import page_text, render

CASES = {
    "": "",
    "<p>a<p>b<br>c": "a\n\nb\nc",
    "<div>a</div>b<div>c</div>": "a\nb\nc",
    "<ul><li>one<li>two<ol start=3><li>x<li value=7>y</ol><li>three</ul>": "* one\n* two\n  3. x\n  7. y\n* three",
    "<table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3</table>end": "Name       Qty\nApple pie  3\n\nend",
    "<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>": "a        b\n\nin  ner",
    "<style>.x{display:none} #q , em.z{visibility:hidden}</style><div class='a x'>no</div><i id=q>no</i>yes": "yes",
    "a <span hidden>no</span><b style='display: none'>no</b>b": "a b",
    "<title>t</title><script>var s='</p>';</script><!-- c --><noscript>n</noscript>": "n",
    "<pre>  a\n   b</pre>x &amp; y &lt;z&gt;&copy": "  a\n   b\n\nx & y <z>©",
    "1 < 2 <a title='x>y'>link</a> <a title=\"open>z": "1 < 2 link z",
    "<details><summary>S</summary>folded <p>too</details><details open>x</details>": "S\nx",
    "<h1>H<p>t</h1><blockquote>q<p>r</blockquote>": "H\n\nt\n\n  q\n\n  r",
    "<b>bold<div>in</b> out": "bold\nin out",
    "  lead <b> and </b>  gaps  ": "lead and gaps",
    "<table><tr><td>a<br>b<td>c<tr><td colspan=2>wide one<td>d</table>": "a         c\nb\nwide one     d",
    "<table><tr><td rowspan=2>A<td>B<tr><td>C<tr><td>D<td>E</table>": "A  B\n   C\nD  E",
    "<table><tr><td>a<td rowspan=3 colspan=2>wide<td>b<tr><td>c<td>d<tr><td>e<td>f</table>": "a  wide    b\nc          d\ne          f",
    "<table><tbody><tr><td rowspan=9>a<td>b</tbody><tbody><tr><td>c<td>d</table>": "a  b\nc  d",
    "<table><tfoot><tr><td>sum<tbody><tr><td>1<tbody><tr><td>2<thead><tr><td>n</table>": "n\n1\n2\nsum",
    "<style>@media print{.x{display:none}} @media (max-width:9px){.y{display:none}}</style><p class=x>a<p class=y>b": "a\n\nb",
    "<style>@media screen , print{.x{display:none}} @supports (x:y){.y{display:none}} .z{color:red}</style><p class=x>a<p class=y>b<p class=z>c": "c",
    "<style>@import 'x'; @font-face{src:y} .x{display:none}</style><p class=x>a<p>b": "b",
    "<style>.a{display:none} .a{display:block} .b{display:block} .b{display:none}</style><p class=a>a<p class=b>b": "a",
    "<style>.a{display:none} p{display:block} #i{display:none!important}</style><p class=a>a<p class=a style='display:block'>b<p id=i style='display:block'>c": "b",
    "<style>p.a.b{display:none} .a{display:block}</style><p class='b a'>a<p class=a>b<div class='a b'>c</div>": "b\n\nc",
    "<p style='display:none;display:block'>a<p style='display:block;display:none'>b<p hidden style='display:block'>c": "a\n\nc",
    "<div style='visibility:hidden'>a <span style='visibility:visible'>b</span> c <i>d</i></div>e": "b\ne",
    "<style>.v{visibility:hidden}</style><table><tr><td class=v>long<td>b<tr><td>c<td>d</table>": "   b\nc  d",
    "<style>div p{display:none} a:hover{display:none}</style><div><p>x</p></div><a>y</a>": "x\n\ny",
    "<style>/* .a{display:none} */ <!-- .b{display:none} --></style><p class=a>a<p class=b>b": "a",
    "</p>x</div></li>": "x",
    "<textarea>a &amp;\n b</textarea>": "a &\n b",
}


@pytest.mark.parametrize("source", list(CASES))
def test_layout(source):
    assert page_text(source) == CASES[source]


def test_any_markup_is_survived_and_text_is_whole():
    assert page_text(None) is None
    assert page_text("<div>" * 20_000 + "deep") == "deep"
    assert page_text("word " * 200_000).split() == ["word"] * 200_000
    page_text("<a '" * 20_000)
    r = random.Random(1)
    tags = "p div b table tr td li ul ol br span h1 pre details dd".split()
    for _ in range(200):
        words = [f"w{k}" for k in range(40)]
        source = "".join(r.choice([f"<{r.choice(tags)}>", f"</{r.choice(tags[:-2])}>", ""]) + f" {w} " for w in words)
        if "details" not in source:
            assert sorted(x for x in page_text(source).split() if x[0] == "w") == sorted(words), source


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title")
        self.out.append("" if tag in ("b", "a") else " ")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title")
        self.out.append("" if tag in ("b", "a") else " ")

    def handle_data(self, data):
        self.out.append("" if self.skip else data)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_words_of_the_given_pages(spark, sf):
    for r in render(spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")).collect():
        parser = Plain()
        parser.feed(r.html)
        parser.close()
        assert [w for w in r.text.split() if w != "*"] == [w for w in "".join(parser.out).split() if w != "*"]


def test_odd_rows(spark, clashing):
    pages = clashing(spark.createDataFrame([(1, None), (1, ""), (None, "<p>x"), (2, "<p>x"), (2, "<p>x")], "page_id long, html string"))
    assert sorted((r.page_id or 0, r.text or "") for r in render(pages).collect()) == [(0, "x"), (1, ""), (1, ""), (2, "x"), (2, "x")]
    assert render(pages.limit(0)).count() == 0
