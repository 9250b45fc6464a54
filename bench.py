"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Fixtures are derived from the base tables and written once before timing (reported as ``fixtures``);
each query then runs to completion into a ``noop`` sink.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pageloom import catalog  # noqa: E402
from pageloom.session import build_session  # noqa: E402

HEADLINE = [
    "G6_iou", "J1_remove_high_iou_low_score", "J3_retype_footnotes", "J6_table_captions_by_index", "J11_absorb_overlapping_blocks",
    "J12_absorb_by_score", "J14_low_confidence_spans", "J16_fill_spans_in_blocks", "J17_fill_chars_in_spans", "J24_cut_text_at_formulas",
    "W1_spans_to_lines", "W7_paragraph_merge", "W10_xy_cut_order", "W17_otsl_cells", "W19_chars_to_content", "W20_line_join",
    "W23_merge_tables_over_pages", "AG1_text_or_scanned", "AG7_list_and_index_blocks", "AG10_image_groups", "AG19_document_markdown",
    "FN12_clean_formulas", "FN22_block_markdown", "FN23_content_list", "J32_relink_images", "ST2_task_states",
]
FIXTURES = [
    "dets", "blocks_idx", "lines", "text_blocks", "doc_lines", "spans", "chars", "otsl", "trows", "page_tables", "page_text",
    "render_blocks", "md_refs", "formulas", "task_events",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "20g"})
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    registry = catalog.load()
    tables = catalog.Tables(spark, folder)
    start = time.time()
    for name in FIXTURES:
        tables.fixture(name)
    fixtures = time.time() - start
    pages = tables.dets.select("doc_id", "page_idx").distinct().count()
    times = {}
    for name in wanted:
        t0 = time.time()
        registry[name].run(catalog.Tables(spark, folder)).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    total = sum(times.values())
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(total, 3), "unit": "sec", "queries": times,
        "sf": Path(folder).name.removeprefix("sf"), "fixtures": round(fixtures, 3), "pages": pages,
        "pages_per_sec": {n: round(pages / s, 1) for n, s in times.items() if s}}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
