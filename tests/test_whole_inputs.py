"""Nothing is capped: all tasks asked for, all pages of a document, all header rows; white space is that of Unicode."""

from pyspark.sql import functions as F

from pageloom.functions import latex
from pageloom.functions import text as tx
from pageloom.functions.html_tables import Table, common_header_rows
from pageloom.operators import documents as D
from pageloom.operators import tables as T
from pageloom.operators import tasks


def test_as_many_tasks_as_asked_for(spark):
    df = spark.range(1500).selectExpr("id as task_id", "'failed' as status", "timestamp_seconds(id) as created_at")
    assert tasks.newest_tasks(df, "failed", 1200).count() == 1200


def test_all_pages_decide(spark):
    docs = spark.createDataFrame([(1, True), (2, True)], "doc_id long, extractable boolean")
    rows = [(1, p, "x" * (600 if p == 10 else 1), 0.0) for p in range(11)] + [(2, p, "x" * 49, 0.0) for p in range(11)]
    pages = spark.createDataFrame(rows, "doc_id long, page_idx long, text string, image_share double")
    assert {(r.doc_id, r.kind) for r in D.classify_documents(docs, pages).collect()} == {(1, "txt"), (2, "ocr")}


def test_blanks_of_any_script_do_not_count_as_text(spark):
    docs = spark.createDataFrame([(1, True)], "doc_id long, extractable boolean")
    pages = spark.createDataFrame([(1, 0, "　" * 60 + " " * 60, 0.0)], "doc_id long, page_idx long, text string, image_share double")
    assert D.classify_documents(docs, pages).first().kind == "ocr"
    df = spark.createDataFrame([("　  a　b \n ",)], "t string")
    assert df.select(tx.strip(F.col("t"))).first()[0] == "a　b"


def test_six_header_rows(spark):
    rows = [(0, k, k, c, c, f"h{k}{c}") for k in range(6) for c in range(2)]
    cols = "k long, r0 long, r1 long, c0 long, c1 long, text string"
    first = spark.createDataFrame(rows + [(0, 6, 6, 0, 0, "a"), (0, 6, 6, 1, 1, "b")], cols)
    second = spark.createDataFrame([(*r[:5], r[5][0] + "　" + r[5][1:]) for r in rows] + [(0, 6, 6, 0, 0, "c"), (0, 6, 6, 1, 1, "d")], cols)
    assert T.header_rows(first, second, ["k"]).first().n_header == 6
    html = ["<table>" + "".join(f"<tr><td>h{k}</td><td>x</td></tr>" for k in range(6)) + f"<tr><td>{last}</td><td>y</td></tr></table>" for last in "ab"]
    assert common_header_rows(Table(html[0]), Table(html[1])) == 6


def test_backslashes_before_a_last_line_break_stay(spark):
    df = spark.createDataFrame([("x\\\\",), ("x\\\\\n",)], "tex string")
    got = [r.clean for r in latex.clean_formulas(df).collect()]
    assert got[0] == "x" and got[1].startswith("x\\")
