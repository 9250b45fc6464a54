"""Derived tables: what needs no shuffle gets none, and Spark's text gives the rows of the check's."""

import duckdb
import pytest

from pageloom import catalog
from pageloom.fixtures import BASE_TABLES, VIEWS, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", ["lines", "doc_lines", "dets", "spans", "cells_ocr"])
def test_texts_of_both_engines_agree(spark, duck, name):
    df = catalog.Tables(spark, SF).fixture(name)
    want = duck.execute(oracle([name], f"SELECT {','.join(df.columns)} FROM {name}")).fetchall()
    assert sorted(tuple(r) for r in df.collect()) == sorted(want)


def test_odd_paragraphs(spark, tmp_path):
    texts = ["", "\n\n", "a" * 80, "b" * 81 + "\n" + "c" * 1000 + "\n" + "d" * 29, "é\r" * 300 + "\n😀" * 50, None, "\n".join("x" * (7 * k % 170) for k in range(120))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("lines", "doc_lines"):
        df = catalog.Tables(spark, str(tmp_path)).fixture(name)
        want = con.execute(oracle([name], f"SELECT {','.join(df.columns)} FROM {name}")).fetchall()
        assert want and sorted(tuple(r) for r in df.collect()) == sorted(want)


def test_lines_and_views_take_no_shuffle(spark, monkeypatch):
    monkeypatch.setattr(catalog, "_WRITTEN", {})
    plain = catalog.Tables(spark, SF, write=False)
    for name in ("lines", "doc_lines"):
        reads = plain.fixture(name)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in reads and "Window" not in reads and "Join" not in reads
    catalog._WRITTEN.clear()
    written = catalog.Tables(spark, SF)
    for name in sorted(VIEWS & {"spans", "noisy", "render_blocks", "blocks_idx"}):
        assert f"/{name}-" not in written.fixture(name)._jdf.queryExecution().executedPlan().toString()


def test_detections_are_shuffled_once_without_boxes(spark, monkeypatch):
    monkeypatch.setattr(catalog, "_WRITTEN", {})
    text = catalog.Tables(spark, SF, write=False).fixture("dets")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Union" not in text


def test_corners_are_sorted_once_or_twice_a_row(spark):
    text = catalog.load()["PF26_clip_points"].run(catalog.Tables(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= text.count("array_sort") <= 2
