"""How characters get to Python: no size check a row, narrow strips, one look at each text, ids that come with the span."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pageloom import fixtures
from pageloom.catalog import spans as queries
from pageloom.operators import spans, strips

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BOX = "x0 bigint, y0 bigint, x1 bigint, y1 bigint"


@pytest.fixture
def page(spark):
    """Two lines that overlap, each with its characters; ids far from their place."""
    sp = spark.createDataFrame([(1, 0, 900, 0, 0, 60, 12), (1, 0, 7, 0, 8, 60, 20), (1, 0, -3, 0, 600, 60, 612)], "doc_id bigint, page_idx bigint, span_id bigint, " + BOX)
    ch = spark.createDataFrame([(1, 0, y * 10 + k, k, c, k * 6, y + 1, k * 6 + 5, y + 11) for y in (0, 8, 600) for k, c in enumerate("ab. d")],
                               "doc_id bigint, page_idx bigint, char_id bigint, i bigint, ch string, " + BOX)
    return sp, ch


def test_characters_are_sent_without_a_size_check(spark, page, monkeypatch):
    """Only the job that sends characters has no limit; what reads strips has the one that was set."""
    seen = []
    plain = strips.materialize
    monkeypatch.setattr(strips, "materialize", lambda df, name: (seen.append((name, spark.conf.get(LIMIT))), plain(df, name))[1])
    before = spark.conf.get(LIMIT)
    sp, ch = page
    got = spans.span_texts(ch, spans.rank_spans(sp))
    assert seen == [("strips", str(2**31 - 1))] and spark.conf.get(LIMIT) == before
    assert {r.content for r in got.collect()} == {"ab. d"}


def test_ids_come_with_the_first_span(page, rows):
    sp, ch = page
    ranked = spans.rank_spans(sp)
    keys = spans.SPAN_ORD
    for plain, found in ((spans.fill_chars(ch, ranked), spans.fill_chars(ch, ranked, ["span_id"])),
                         (spans.span_texts(ch, ranked), spans.span_texts(ch, ranked, ["span_id"]))):
        want = plain.join(ranked.select(*keys, "span_id"), keys)
        assert rows(found) == rows(want) and found.count() == want.count() > 0
        assert {c: t for c, t in found.dtypes} == {c: t for c, t in want.dtypes}


def test_spans_are_ranked_once(spark):
    class Tables:
        spans = spark.createDataFrame([(1, 0, 5, 0, 0, 60, 12)], "doc_id bigint, page_idx bigint, span_id bigint, " + BOX)
        chars = spark.createDataFrame([(1, 0, 0, k, "x", k * 6, 1, k * 6 + 5, 11) for k in range(9)], "doc_id bigint, page_idx bigint, line_no bigint, i bigint, ch string, " + BOX)

    for run in (queries.j17, queries.w19, queries.ag4):
        found = run(Tables)
        assert found._jdf.queryExecution().optimizedPlan().toString().count("row_number") == 1
        assert [r.span_id for r in found.collect()] == [5]


@pytest.mark.parametrize("kind", ["q", "d"])
def test_strips_hold_any_values(kind):
    """Steps of all widths, the largest and smallest values, nulls and empty texts come back as they were."""
    top = np.iinfo(np.int64)
    whole = [np.array(v, np.int64) for v in ([1, 2, 3, 4, 5], [0, 300, -300, 70_000, 1 << 40], [top.max, top.min, strips.NULL, 0, -1])]
    text = pa.array(["a", None, "", "𝄞é", "ab"])
    starts = np.array([0, 2])
    counts, sizes, packed = strips._packed(starts, whole, text)
    values, texts = strips._unpacked(np.array(counts), np.array(sizes), packed, kind * 3)
    assert texts.to_pylist() == text.to_pylist() and counts == [2, 3]
    assert all((v.view(np.int64) == w).all() for v, w in zip(values, whole))


def test_steps_take_as_few_bytes_as_they_need():
    n = 10_000
    _, sizes, _ = strips._packed(np.array([0]), [np.arange(n) * 6 + (1 << 40), np.arange(n) // 80 * 1000], pa.array(["x"] * n))
    assert sizes[0] < n * 5.1  # 1 and 2 bytes of steps, 1 of a length, 1 of a text


def test_characters_of_odd_lines(spark):
    """The same rows as when each character is looked up by its place."""
    lines = ["plain", "é𝄞 ﬁ​", "a\r\tb", "\\", " ", "🇩🇪é", "日本語。"]
    spark.createDataFrame([(1, 0, 0, 0, k, 50, 60, 500, 72, x) for k, x in enumerate([*lines, "", None])],
                          "doc_id bigint, page_idx bigint, para_no bigint, col_no bigint, line_no bigint, " + BOX + ", txt string").createOrReplaceTempView("lines")
    sql = fixtures.FIXTURES["chars"][1]
    got = spark.sql(sql)
    want = spark.sql(fixtures._CHARS_HEAD + "lines LATERAL VIEW explode(sequence(0,length(txt)-1)) e AS i WHERE txt<>''")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.dtypes == want.dtypes
    assert got.count() == sum(map(len, lines)) and "substring" not in sql
