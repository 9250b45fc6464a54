"""Registered queries against DuckDB on the smallest tables."""

import sys

import duckdb
import pytest

sys.path.insert(0, "/root/repo")
import __spark_entry__ as entry  # noqa: E402
from pageloom.fixtures import BASE_TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
CHECKED = [
    "G5_overlap_of_smaller", "PF1_fix_axis", "PF3_normalize_poly_to_bbox", "J1_remove_high_iou_low_score", "J3_retype_footnotes", "J6_image_captions_by_index",
    "J14_low_confidence_spans", "J16_fill_spans_in_blocks", "J18_text_to_predicted_cells", "J24_cut_text_at_formulas", "J26_filter_nested_tables", "J32_relink_images",
    "W1_spans_to_lines", "W7_paragraph_merge", "W9_footnote_contiguity", "W17_otsl_cells", "W18_otsl_to_html", "W22_common_header_rows", "W23_merge_tables_over_pages",
    "W25_heading_levels", "AG1_text_or_scanned", "AG7_list_and_index_blocks", "AG10_image_groups", "AG19_document_markdown", "AG20_one_array_per_page", "AG22_token_collapse",
    "J17_text_layer", "FN23_detections_to_content_list", "SC7_detections_to_middle",
    "FN12_clean_formulas", "FN23_content_list", "SC5_read_page_results", "ST4_reset_stale_tasks", "UF3_table_html_to_cells",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def norm(row):
    return tuple(round(v, 9) if isinstance(v, float) else v for v in row)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((norm(r[c] for c in cols) for r in df.collect()), key=repr)
    res = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted((norm(r[names.index(c)] for c in cols) for r in res.fetchall()), key=repr)
    assert got == want


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 200


def test_flagship(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"doc_id", "md"} and df.count() > 0
