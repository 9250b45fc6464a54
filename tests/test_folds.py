"""Order-dependent steps against plain loops on random pages."""

import random

import pytest

import twins
from pageloom.operators import detections as D
from pageloom.operators import blocks, grids, growth, ordering, settle, spans

PAGES = twins.random_pages(60, 14, seed=7)


@pytest.fixture(scope="module")
def boxes(spark):
    data = [
        (p // 5, p % 5, k, 5, *b, s)
        for p, (bs, ss) in enumerate(PAGES) for k, (b, s) in enumerate(zip(bs, ss))
    ]
    schema = "doc_id bigint, page_idx bigint, det_id bigint, category_id bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint, score double"
    return spark.createDataFrame(data, schema).cache()


def collected(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.doc_id * 5 + r.page_idx, {})[r.det_id] = (r.x0, r.y0, r.x1, r.y1)
    return got


def expected(fn):
    return {p: fn(bs, ss) for p, (bs, ss) in enumerate(PAGES) if fn(bs, ss)}


def test_absorb_smaller(boxes):
    want = expected(lambda b, s: twins.absorb(b, 0.8))
    assert collected(D.absorb_overlapping_bodies(boxes)) == want
    assert collected(blocks.absorb_overlapping_blocks(boxes.withColumnRenamed("det_id", "block_id")).withColumnRenamed("block_id", "det_id")) == want


def test_absorb_by_score(boxes):
    assert collected(D.absorb_by_score(boxes)) == expected(lambda b, s: twins.absorb_scored(b, s, 0.8))


def test_merge_alike(boxes):
    """Boxes and their places in the list."""
    got = D.merge_alike_tables(boxes)
    want = expected(lambda b, s: twins.merge_alike(b, 0.7))
    assert collected(got) == want
    order = {}
    for r in got.orderBy("ord").collect():
        order.setdefault(r.doc_id * 5 + r.page_idx, []).append(r.det_id)
    assert order == {p: list(v) for p, v in want.items()}


def test_merges_of_groups_apart_keep_the_order_of_the_page(spark):
    """Merges of one group wait for each other, those of another go on in between."""
    pages = [twins.random_clusters(6, 8, seed) for seed in range(12)]
    data = [(p, 0, k, 5, *b, 0.5) for p, bs in enumerate(pages) for k, b in enumerate(bs)]
    df = spark.createDataFrame(data, "doc_id bigint, page_idx bigint, det_id bigint, category_id bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint, score double")
    order = {}
    for r in D.merge_alike_tables(df, 0.55).orderBy("ord").collect():
        order.setdefault(r.doc_id, []).append((r.det_id, (r.x0, r.y0, r.x1, r.y1)))
    assert order == {p: list(twins.merge_alike(bs, 0.55).items()) for p, bs in enumerate(pages)}


def test_big_against_inner(boxes):
    assert collected(D.big_against_inner(boxes)) == expected(lambda b, s: twins.big_or_inner(b, s, 0.8))


def test_pages_in_batches_of_any_size():
    """Pages that reach over batches come out whole, once, and with the same result."""
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(8)
    rows = [(p // 5, p % 5 if p % 7 else None, *b) for p, (bs, _) in enumerate(PAGES) for b in bs]
    table = pa.table({c: pa.array([r[k] for r in rows], pa.int64()) for k, c in enumerate(["doc_id", "page_idx", "x0", "y0", "x1", "y1"])})
    want = [[tuple(r.values()) for r in t.to_pylist()] for t in growth.whole_groups(iter(table.to_batches(len(rows))), ["doc_id", "page_idx"])]
    assert [r for g in want for r in g] == rows
    for _ in range(20):
        cuts = sorted(rnd.randrange(len(rows) + 1) for _ in range(rnd.choice([1, 5, 60, 400])))
        batches = [b for a, z in zip([0, *cuts], [*cuts, len(rows)]) for b in (table.slice(a, z - a).to_batches() or [pa.RecordBatch.from_pylist([], schema=table.schema)])]
        got = [[tuple(r.values()) for r in t.to_pylist()] for t in growth.whole_groups(iter(batches), ["doc_id", "page_idx"])]
        assert [r for g in got for r in g] == rows
        ends = {(g[-1][:2], h[0][:2]) for g, h in zip(got, got[1:])}
        assert all(a != b for a, b in ends)
    assert list(growth.whole_groups(iter([]), ["doc_id"])) == []
    # all pages at once or one by one
    for threshold in (0.5, 0.8):
        xy = np.array([b for bs, _ in PAGES for b in bs], float)
        page = np.array([p for p, (bs, _) in enumerate(PAGES) for _ in bs])
        score, number = np.zeros(len(xy)), np.arange(len(xy))
        stay, now, _ = growth.settle(page, xy, score, number, growth.absorbing(threshold), threshold, threshold)
        for p in set(page.tolist()):
            own = page == p
            alone, boxes, _ = growth.settle(page[own], xy[own], score[own], number[own], growth.absorbing(threshold), threshold, threshold)
            assert (alone == stay[own]).all() and (boxes == now[own]).all()


def test_growth_of_chains(spark):
    """Stairs of boxes, each nearly inside the next one's hull: one long group."""
    boxes = [(3 * k, 0, 3 * k + 40, 20) for k in range(30)] + [(500, 0, 540, 20), (501, 0, 541, 20)]
    df = spark.createDataFrame([(0, 0, k, 5, *b, (k * 7 % 5) / 4) for k, b in enumerate(boxes)],
                               "doc_id bigint, page_idx bigint, det_id bigint, category_id bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint, score double")
    assert collected(D.absorb_overlapping_bodies(df)) == {0: twins.absorb(boxes, 0.8)}
    assert collected(D.absorb_by_score(df)) == {0: twins.absorb_scored(boxes, [(k * 7 % 5) / 4 for k in range(len(boxes))], 0.8)}
    assert collected(D.merge_alike_tables(df)) == {0: twins.merge_alike(boxes, 0.7)}


def conflicts(threshold, rule):
    out = {}
    for p, (bs, ss) in enumerate(PAGES):
        pairs = [(i, j, rule(i, j, bs, ss)) for i in range(len(bs)) for j in range(i + 1, len(bs)) if twins.iou(bs[i], bs[j]) > threshold]
        gone = twins.eliminate(pairs)
        out[p] = {k for k in range(len(bs)) if k not in gone}
    return {p: v for p, v in out.items() if v}


@pytest.mark.parametrize("limit", [settle.FOLD_LIMIT, 0])
def test_ordered_elimination(boxes, limit, monkeypatch):
    """Fold and rounds give the same survivors as the loop."""
    monkeypatch.setattr(settle, "eliminate", lambda e, f=settle.eliminate: f(e, limit))
    want = conflicts(0.5, lambda i, j, b, s: i if s[i] < s[j] else j)
    got = {}
    for r in D.keep_confident_formulas(boxes, 0.5).collect():
        got.setdefault(r.doc_id * 5 + r.page_idx, set()).add(r.det_id)
    assert got == want


def test_smaller_spans(boxes):
    rows = boxes.withColumnRenamed("det_id", "span_id")
    want = {}
    for p, (bs, _) in enumerate(PAGES):
        pairs = [(i, j, i if twins.area(bs[i]) <= twins.area(bs[j]) else j)
                 for i in range(len(bs)) for j in range(i + 1, len(bs)) if twins.of_smaller(bs[i], bs[j]) > 0.65]
        left = set(range(len(bs))) - twins.eliminate(pairs)
        if left:
            want[p] = left
    got = {}
    for r in spans.drop_smaller_overlaps(rows).collect():
        got.setdefault(r.doc_id * 5 + r.page_idx, set()).add(r.span_id)
    assert got == want


def test_elimination_is_idempotent(boxes):
    once = D.keep_confident_formulas(boxes).cache()
    assert D.keep_confident_formulas(once).count() == once.count()


def test_xy_cut(boxes):
    solid = boxes.where("x1 > x0").withColumnRenamed("det_id", "block_id")
    got = {}
    for r in ordering.xy_cut(solid).collect():
        got.setdefault(r.doc_id * 5 + r.page_idx, []).append((r["rank"], r.block_id))
    for p, (bs, _) in enumerate(PAGES):
        keep = [k for k, b in enumerate(bs) if b[2] > b[0]]
        assert [b for _, b in sorted(got.get(p, []))] == twins.xy_cut(bs, keep)


def test_row_tolerance(boxes):
    got = {}
    for r in ordering.sort_rows_with_tolerance(boxes).collect():
        got.setdefault(r.doc_id * 5 + r.page_idx, []).append((r["rank"], r.det_id))
    for p, (bs, _) in enumerate(PAGES):
        assert [b for _, b in sorted(got.get(p, []))] == twins.settle_rows(bs, 10)
    inside = {}
    for r in ordering.sort_table_boxes(boxes, ["doc_id", "page_idx"], "det_id").collect():
        inside.setdefault(r.doc_id * 5 + r.page_idx, []).append((r["rank"], r.det_id))
    for p, (bs, _) in enumerate(PAGES):
        assert [b for _, b in sorted(inside.get(p, []))] == twins.settle_rows(bs, 20, 0.2)


def test_pairing_by_distance(spark):
    schema = "doc_id bigint, page_idx bigint, det_id bigint, category_id bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint"

    def pairs(rows):
        got = {}
        for r in D.match_captions(spark.createDataFrame(rows, schema), 3, 4).collect():
            got.setdefault(r.doc_id, set()).add((r.body_id, r.part_id))
        return got

    two = [(1, 0, 1, 3, 0, 0, 100, 50), (1, 0, 2, 4, 0, 55, 100, 60), (1, 0, 3, 3, 0, 100, 100, 150), (1, 0, 4, 4, 0, 155, 100, 160)]
    # A part left over goes to its nearest body; a body without parts stays; parts alone give nothing.
    more = [(2, *r[1:]) for r in two] + [(2, 0, 5, 4, 0, 162, 100, 166), (2, 0, 6, 3, 300, 300, 400, 350), (3, 0, 2, 4, 0, 0, 1, 1)]
    got = pairs(two + more)
    assert got[1] == {(1, 2), (3, 4)} and got[2] == {(1, 2), (3, 4), (3, 5), (6, None)} and 3 not in got
    rnd = random.Random(6)
    rows, want = [], {}
    for p, (bs, _) in enumerate(twins.random_pages(60, 12, seed=11, size=400)):
        kinds = [rnd.randrange(2) for _ in bs]
        rows += [(p, 0, k, 3 + kind, *b) for k, (b, kind) in enumerate(zip(bs, kinds))]
        found = set(twins.pair_by_distance(bs, kinds))
        if found:
            want[p] = found
    assert pairs(rows) == want


def test_gather_rows(spark):
    def row(text_id, x0, y0, x1, y1, text, cell=0):
        return {"table_id": 1, "cell_no": cell, "text_id": text_id, "x0": x0, "y0": y0, "x1": x1, "y1": y1, "text": text}

    rows = [row(2, 60, 0, 90, 10, "b"), row(1, 0, 1, 30, 11, "a"), row(3, 0, 40, 30, 50, "c"), row(4, 0, 0, 5, 5, "z", 1)]
    got = grids.gather_cell_texts(spark.createDataFrame(rows, "table_id bigint, cell_no bigint, text_id bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint, text string"))
    assert sorted((r.cell_no, r.pos, r.text) for r in got.collect()) == [(0, 0, "a   b"), (0, 1, "c"), (1, 0, "z")]


def test_cell_texts_as_passes_over_the_pieces(spark):
    """One pass that keeps all rows open gives what a pass per row gives."""
    rnd = random.Random(9)
    data = [(0, c, k, x, y, x + rnd.choice([4, 20, 45]), y + rnd.choice([0, 8, 12, 20]), f"t{k}")
            for c in range(60) for k in range(rnd.randrange(1, 12)) for x, y in [(rnd.randrange(0, 90), rnd.randrange(0, 60))]]
    df = spark.createDataFrame(data, "table_id bigint, cell_no bigint, text_id bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint, text string")
    got = {}
    for r in grids.gather_cell_texts(df).collect():
        got.setdefault(r.cell_no, []).append((r.pos, r.text))
    want = {}
    for c in range(60):
        own = [d for d in data if d[1] == c]
        order = twins.settle_rows([d[3:7] for d in own], 20, 0.3)
        want[c] = list(enumerate(twins.gather([(own[k][3:7], own[k][7]) for k in order], 10, 0.3)))
    assert {c: sorted(v) for c, v in got.items()} == want


def test_structure_tokens_with_spans(spark):
    tokens = ["<tr>", "<td", ' rowspan="2"', ">", "</td>", "<td></td>", "</tr>", "<tr>", "<td></td>", "</tr>"]
    df = spark.createDataFrame([(1, k, x) for k, x in enumerate(tokens)], "table_id bigint, pos bigint, token string")
    got = [(r.r0, r.r1, r.c0, r.c1) for r in grids.structure_boxes(df).orderBy("cell_no").collect()]
    assert got == [(0, 1, 0, 0), (0, 0, 1, 1), (1, 1, 1, 1)]


def test_structure_tokens_of_random_tables(spark):
    from pageloom.functions.html_tables import place

    rnd = random.Random(4)
    data, want = [], {}
    for t in range(30):
        table = [[(rnd.choice([1, 1, 1, 2, 3]), rnd.choice([1, 1, 2, 4])) for _ in range(rnd.randrange(0, 6))] for _ in range(rnd.randrange(1, 7))]
        tokens = []
        for row in table:
            tokens.append("<tr>")
            for down, across in row:
                spans = [f' rowspan="{down}"'] * (down > 1) + [f" colspan='{across}'"] * (across > 1)
                tokens += ["<td", *spans, ">", "</td>"] if spans else ["<td></td>"]
            tokens.append("</tr>")
        data += [(t, k, x) for k, x in enumerate(tokens)]
        columns, _ = place(table)
        want[t] = [(r, r + d - 1, c, c + a - 1) for r, (row, at) in enumerate(zip(table, columns)) for (d, a), c in zip(row, at)]
    got = {t: [] for t in want}
    for r in grids.structure_boxes(spark.createDataFrame(data, "table_id bigint, pos bigint, token string")).orderBy("table_id", "cell_no").collect():
        got[r.table_id].append((r.r0, r.r1, r.c0, r.c1))
    assert got == want


def test_grid_of_boxes_with_merged_cells(spark):
    def cell(no, row, x0, y0, x1, y1):
        return {"table_id": 1, "cell_no": no, "row_no": row, "x0": x0, "y0": y0, "x1": x1, "y1": y1}

    rows = [cell(0, 0, 0, 0, 200, 20), cell(1, 0, 200, 0, 300, 20), cell(2, 1, 0, 20, 100, 60), cell(3, 1, 100, 20, 200, 40),
            cell(4, 1, 200, 20, 300, 40), cell(5, 2, 100, 40, 200, 60), cell(6, 2, 200, 40, 300, 60)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "table_id bigint, cell_no bigint, row_no bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    got = {r.cell_no: (r.r0, r.r1, r.c0, r.c1) for r in grids.logical_boxes(df).collect()}
    assert got == {0: (0, 0, 0, 1), 1: (0, 0, 2, 2), 2: (1, 2, 0, 0), 3: (1, 1, 1, 1), 4: (1, 1, 2, 2), 5: (2, 2, 1, 1), 6: (2, 2, 2, 2)}


def plain_grid(cells):
    """Columns and spans of a table by the stated rule, on lists. cells: (cell_no, row, x0, y0, x1, y1)."""
    rows = {}
    for c in sorted(cells):
        rows.setdefault(c[1], []).append(c)
    rows = [rows[k] for k in sorted(rows)]
    longest = max(rows, key=len)
    starts, high = [c[2] for c in longest], longest[-1][4]
    for row in rows:
        for c in row:
            for x, left in ((c[2], True), (c[4], False)):
                known = any(abs(x - s) <= 15 for s in starts)
                if not known and ((x > high and left) or (x <= high and x < starts[-1])):
                    starts = sorted([*starts, x])
                high = max(high, x)

    def spanned(first, borders, extent):
        reach = [b - borders[first] for b in borders[first + 1:]]
        for n, r in enumerate(reach, 1):
            if abs(r - extent) <= 10 or r > extent:
                close = n == 1 or abs(r - extent) <= 10 or abs(r - extent) < abs(reach[n - 2] - extent)
                return n if close else n - 1
        return len(reach)

    down = [row[0][3] for row in rows] + [rows[-1][0][3] + max(c[5] - c[3] for c in rows[-1])]
    out = {}
    for r0, row in enumerate(rows):
        taken = 0
        for c in row:
            c0 = max(taken, min(range(len(starts)), key=lambda k: abs(starts[k] - c[2])))
            n = spanned(c0, [*starts, high], c[4] - c[2])
            taken += n
            out[c[0]] = (r0, r0 + spanned(r0, down, c[5] - c[3]) - 1, c0, c0 + n - 1)
    return out


def test_grids_of_random_tables(spark):
    rnd = random.Random(5)
    tables = []
    for _ in range(40):
        cells, y = [], 0
        for row in range(rnd.randrange(1, 6)):
            x, h = rnd.choice([0, 0, 8, 30]), rnd.choice([20, 30])
            for _ in range(rnd.randrange(1, 6)):
                w = rnd.choice([12, 40, 50, 52, 80, 100, 130])
                cells.append((len(cells), row, x, y + rnd.randrange(3), x + w, y + rnd.choice([h, h, h + 25])))
                x += w + rnd.choice([0, 0, 3])
            y += h
        tables.append(cells)
    df = spark.createDataFrame([(t, *c) for t, cells in enumerate(tables) for c in cells],
                               "table_id bigint, cell_no bigint, row_no bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    got = {}
    for r in grids.logical_boxes(df).collect():
        got.setdefault(r.table_id, {})[r.cell_no] = (r.r0, r.r1, r.c0, r.c1)
    assert got == {t: plain_grid(cells) for t, cells in enumerate(tables)}


def test_characters_take_the_topmost_span(spark):
    """Marks over the border, overlapping spans, strays."""
    span_rows = [(1, 0, 1, 0, 100, 200, 112), (1, 0, 2, 0, 98, 200, 114), (1, 0, 3, 300, 100, 400, 112)]
    sp = spark.createDataFrame(span_rows, "doc_id bigint, page_idx bigint, span_id bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    chars = [(0, "a", 10, 15), (1, ".", 198, 206), (2, "a", 198, 206), (3, "(", 295, 303), (4, "x", 250, 255), (5, "z", 390, 395)]
    ch = spark.createDataFrame([(1, 0, k, k, c, x0, 101, x1, 111) for k, c, x0, x1 in chars],
                               "doc_id bigint, page_idx bigint, char_id bigint, i bigint, ch string, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    ranked = spans.rank_spans(sp)
    got = spans.fill_chars(ch, ranked).join(ranked.select("ord", "span_id"), "ord")
    assert {(r.char_id, r.span_id) for r in got.collect()} == {(0, 2), (1, 2), (3, 3), (5, 3)}
