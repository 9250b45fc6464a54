"""Single-process loops of the same semantics, for comparison with bench.py: tools/yardstick.py [sf].

Times only the loops, on pages already in memory.
"""

import json
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import twins  # noqa: E402
from pageloom.fixtures import BASE_TABLES, oracle  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.1"
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf{sf}/{name}.parquet'")
    rows = con.execute(oracle(["dets"], "SELECT doc_id,page_idx,x0,y0,x1,y1,score_m FROM dets ORDER BY doc_id,page_idx,det_id")).fetchall()
    pages = {}
    for doc, page, *box, score in rows:
        boxes, scores = pages.setdefault((doc, page), ([], []))
        boxes.append(tuple(box))
        scores.append(score)

    def duplicates(boxes, scores):
        return {i if scores[i] < scores[j] else j for i in range(len(boxes)) for j in range(i + 1, len(boxes)) if twins.iou(boxes[i], boxes[j]) > 0.9}

    loops = {
        "J1_remove_high_iou_low_score": duplicates,
        "J11_absorb_overlapping_blocks": lambda b, s: twins.absorb(b, 0.8),
        "J12_absorb_by_score": lambda b, s: twins.absorb_scored(b, s, 0.8),
        "J14_low_confidence_spans": lambda b, s: twins.eliminate(
            [(i, j, i if s[i] < s[j] else j) for i in range(len(b)) for j in range(i + 1, len(b)) if twins.iou(b[i], b[j]) > 0.9]),
    }
    times = {}
    for name, loop in loops.items():
        start = time.time()
        for boxes, scores in pages.values():
            loop(boxes, scores)
        times[name] = round(time.time() - start, 2)
    print(json.dumps({"sf": sf, "pages": len(pages), "loop_seconds": times}))


main()
