"""Shape of the plans: no pair products in a page, no Python where expressions do, filters at the scan."""

import io
from contextlib import redirect_stdout

import pytest

from pageloom import catalog
from pageloom.operators import documents

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


PAGE_JOINS = ["J1_", "J3_", "J4_", "J7_title", "J8_", "J9_", "J10_", "J13_", "J16_", "J20_", "J21_", "J22_", "J24_", "G6_", "G15_"]


@pytest.mark.parametrize("prefix", PAGE_JOINS)
def test_page_joins_are_equi_joins(spark, prefix):
    q = next(q for n, q in catalog.load().items() if n.startswith(prefix))
    text = plan(q.run(catalog.Tables(spark, SF)))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "ArrowEvalPython" not in text


@pytest.mark.parametrize("name", ["W1_spans_to_lines", "AG7_list_and_index_blocks", "W9_caption_contiguity", "FN22_block_markdown", "W17_otsl_cells", "AG1_text_or_scanned"])
def test_no_python_in_expression_plans(spark, name):
    text = plan(catalog.load()[name].run(catalog.Tables(spark, SF)))
    assert "Python" not in text and "InArrow" not in text and "InPandas" not in text


def test_page_range_reaches_the_scan(spark):
    text = plan(documents.page_range(catalog.Tables(spark, SF).lines, 1, 2).select("doc_id", "txt"))
    assert "GreaterThanOrEqual(page_idx,1)" in text and "LessThanOrEqual(page_idx,2)" in text
    schema = text.split("ReadSchema:")[1].splitlines()[0]
    assert "doc_id" in schema and "txt" in schema and "x0" not in schema


def test_lines_of_a_block_need_one_exchange(spark):
    text = plan(catalog.load()["AG7_list_and_index_blocks"].run(catalog.Tables(spark, SF)))
    assert text.split("===")[0].count("Exchange") <= 2


def test_lines_of_a_block_are_sorted_once(spark):
    text = plan(catalog.load()["AG7_list_and_index_blocks"].run(catalog.Tables(spark, SF)))
    assert text.split("\n\n")[0].count("Sort") == 1


def test_lines_meet_their_texts_once(spark):
    """Paragraphs that reach over pages come of the same pass as all others."""
    text = plan(catalog.load()["W20_line_join"].run(catalog.Tables(spark, SF)))
    tree = text.split("\n\n")[0]
    assert "Union" not in tree and tree.count("Generate") == 1


def test_texts_of_a_document_are_shuffled_once(spark):
    """By page as lines and by document as paragraphs; what pages and paragraphs ask of lines goes without texts."""
    tree = plan(catalog.load()["AG19_document_markdown"].run(catalog.Tables(spark, SF))).split("\n\n")[0]
    top = tree[:tree.index("Join")]
    assert top.count("Exchange") == 1


def test_compressed_tables_are_not_broadcast_by_the_size_of_their_files(spark):
    from pyspark.sql import functions as F

    from pageloom.session import materialize, tune

    tune(spark)
    rows = materialize(spark.range(300_000).select("id", *(F.floor(F.col("id") / 40).alias(c) for c in "abcdefgh")), "rows")
    plan = rows.join(rows.select("id", F.col("a").alias("z")), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_lists_and_paragraphs_shuffle_no_text(spark):
    from pageloom.catalog import Tables
    from pageloom.catalog.paragraphs import tagged
    from pageloom.operators import paragraphs as P

    t = Tables(spark, SF)
    facts = P.block_facts(tagged(t))
    held, seen = [facts._jdf.queryExecution().executedPlan().initialPlan()], 0
    while held:
        node = held.pop()
        if node.nodeName() == "Exchange":
            seen += 1
            assert "txt" not in [node.output().apply(k).name() for k in range(node.output().size())]
        held += [node.children().apply(k) for k in range(node.children().size())]
    assert seen


def test_steps_of_a_page_are_joined_where_they_lie(spark):
    from pyspark.sql import functions as F

    from pageloom.operators.pairs import meeting_pairs
    from pageloom.session import by_page, settings

    boxes = by_page(spark.range(2000).select(
        (F.col("id") % 7).alias("doc_id"), (F.col("id") % 5).alias("page_idx"), "id", F.col("id").alias("x0"), F.col("id").alias("y0"),
        (F.col("id") + 3).alias("x1"), (F.col("id") + 3).alias("y1")), "boxes")
    with settings(spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        pairs = meeting_pairs(boxes, boxes, F.col("a.id") < F.col("b.id"))
        kept = boxes.join(pairs.select("a.doc_id", "a.page_idx", "a.id").distinct(), ["doc_id", "page_idx", "id"], "left_anti")
        assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
        assert kept.count() == 2000


def test_middle_documents_shuffle_lines_once(spark, monkeypatch):
    from pageloom.sources import sinks

    held, write = [], sinks.write_middle
    monkeypatch.setattr(sinks, "write_middle", lambda docs, folder: (held.append(docs), write(docs, folder)))
    catalog.load()["SC7_middle_json"].run(catalog.Tables(spark, SF))
    assert held[0]._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
