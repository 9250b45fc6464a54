"""Texts and boxes are dealt as seldom as the steps allow, with the rows that the plain steps give."""

import random

import pytest
from pyspark.sql import functions as F

from pageloom.functions import geom as g
from pageloom.operators import blocks, detections, spans
from pageloom.operators.pairs import PAGE

BOX = ["x0", "y0", "x1", "y1"]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_distinct_spans_without_a_join(spark, rows):
    """Equal values with nulls among them: the first stays, and texts are read once."""
    rnd = random.Random(3)
    pick = lambda *v: rnd.choice(v)
    data = [(pick(1, 2), pick(0, 1), k, pick("text", "table", None), pick(0.0, -0.0, 5.0), 1.0, pick(9.0, None), 4.0, pick(0.5, None), pick("a", "b", None), pick("<t>", None), f"p{k}")
            for k in rnd.sample(range(400), 300)]
    df = spark.createDataFrame(data, "doc_id bigint, page_idx bigint, span_id bigint, type string, x0 double, y0 double, x1 double, y1 double, score double, content string, html string, image_path string")
    firsts = df.groupBy(*PAGE, "type", *BOX, "score", "content", "html").agg(F.min("span_id").alias("span_id"))
    want = df.join(firsts.select(*PAGE, "span_id"), [*PAGE, "span_id"], "left_semi")
    got = spans.distinct_by_value(df)
    assert rows(got) == rows(want) and 0 < got.count() == want.count() < 300
    assert got.columns == df.columns and "Join" not in plan(got)


@pytest.fixture
def crowd(spark):
    """Near copies over several grid cells, at negative places too, and boxes without area."""
    rnd = random.Random(11)
    data = []
    for k in range(400):
        x, y, w, h = rnd.randrange(-700, 900), rnd.randrange(-700, 900), rnd.choice([0, 40, 700]), rnd.choice([0, 12, 330])
        for d in (0, 1, 2):
            data.append((1, k % 3, 3 * k + d, rnd.choice([0, 1]), x + d, y, x + d + w, y + h, rnd.choice([0.3, 0.6, 0.9])))
    return spark.createDataFrame(data, "doc_id bigint, page_idx bigint, det_id bigint, category_id bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint, score double")


def pairs_above(df, name, limit):
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in PAGE] + [F.col(f"a.{name}") < F.col(f"b.{name}"), g.iou(g.box("a"), g.box("b")) > limit]
    return df.alias("a").join(df.alias("b"), on)


def test_near_copies_lie_in_the_cell_of_their_centre(crowd, rows):
    """The first box of a pair is in one cell; only the second is copied along x and along y."""
    pairs = pairs_above(crowd, "det_id", 0.9)
    loser = F.when(F.col("a.score") < F.col("b.score"), F.col("a.det_id")).otherwise(F.col("b.det_id"))
    gone = pairs.select(*(F.col(f"a.{k}").alias(k) for k in PAGE), loser.alias("det_id")).distinct()
    got = detections.drop_high_iou(crowd)
    assert rows(got) == rows(crowd.join(gone, [*PAGE, "det_id"], "left_anti")) and 0 < got.count() < crowd.count()
    assert plan(got).count("Generate explode") == 2


def test_conflicting_spans_lie_in_the_cell_of_their_centre(crowd, monkeypatch):
    """All conflicting pairs are found, from one cell each."""
    seen = []
    monkeypatch.setattr(spans.settle, "eliminate", lambda edges: (seen.append(edges), edges.select(*PAGE, "loser").where("false"))[1])
    sp = crowd.withColumnRenamed("det_id", "span_id")
    assert spans.drop_low_score_overlaps(sp).count() == sp.count()
    assert seen[0].count() == pairs_above(sp, "span_id", 0.9).count() > 100
    assert plan(seen[0]).count("Generate explode") == 2


def test_spans_of_the_text_layer_are_dealt_once(spark, monkeypatch):
    seen = []
    plain = spans.by_page
    monkeypatch.setattr(spans, "by_page", lambda df, name: (seen.append((name, df)), plain(df, name))[1])
    sp = spark.createDataFrame([(1, 0, k, "text", 0, 20 * k, 60, 20 * k + 12, 0.7, "old") for k in range(3)],
                               "doc_id bigint, page_idx bigint, span_id bigint, type string, x0 bigint, y0 bigint, x1 bigint, y1 bigint, score double, content string")
    ch = spark.createDataFrame([(1, 0, k, k, "x", k * 6, 1, k * 6 + 5, 11) for k in range(9)],
                               "doc_id bigint, page_idx bigint, char_id bigint, i bigint, ch string, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    lines = ch.select(*PAGE, F.col("char_id").alias("line_id"), F.col("ch").alias("text"), *BOX)
    box = spark.createDataFrame([(1, 0, "text", 0, 0, 80, 30)], "doc_id bigint, page_idx bigint, type string, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    found = {r.span_id: (r.content, r.late) for r in spans.fill_text_layer(sp, ch, lines, box, box.where("false")).collect()}
    assert found == {0: ("xxxxxxxxx", False), 1: ("", True), 2: ("old", False)}
    assert [name for name, _ in seen] == ["spans", "text-spans"]
    assert all("content" not in df.columns for _, df in seen)
    # of the second table only the keys of spans in a block are shuffled, beside the copies that meet in a cell
    assert seen[1][1]._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(doc_id#") <= 3
