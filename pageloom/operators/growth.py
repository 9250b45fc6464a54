"""Boxes that take over others they overlap, in list order.

The result depends on the order of the list, but only among boxes that can affect each other. Pages are dealt to tasks and lie there one
after the other; numpy looks at many pages at once, and other columns pass through as Arrow arrays. A sweep over bands finds the boxes
that overlap by enough; each group of linked boxes is settled on its own. Then the boxes that have grown are held against all others:
where one reaches a box of another group, the groups are one and are settled again. Most boxes are in no group and stay as they are.
The same path serves pages of any size; a page costs its boxes and the pairs that meet.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .pairs import PAGE

XY = ["x0", "y0", "x1", "y1"]
LATE = 1 << 40
BLOCK = 1 << 21  # pairs that are looked at together
NULL = -(1 << 62)

Group = tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]  # boxes, scores, list numbers, pairs that overlap
Settled = tuple[np.ndarray, np.ndarray, dict[int, list[int]]]  # who stays, the last box of each, places
Rule = Callable[..., Settled]


def settled(boxes: DataFrame, order: str, rule: Rule, seeds_share: float, share: float | None, keys: list[str] = PAGE) -> DataFrame:
    """``boxes`` after ``rule``: boxes that go are left out, others have their new box, and ``_key`` where the rule gives one.

    Boxes are linked if ``seeds_share`` (half or more) of one lies inside the other. With ``share`` boxes grow, and a pair that never
    overlaps by more than that of the smaller one does not affect each other.
    """
    schema = T.StructType([*boxes.schema.fields, T.StructField("_key", T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            page, _ = _numbered(table, keys)
            xy = np.stack([_floats(table[c]) for c in XY], axis=1)
            score = _floats(table["score"]) if "score" in table.column_names else np.zeros(len(page))
            stay, now, places = settle(page, xy, score, table[order].to_numpy(), rule, seeds_share, share)
            for c, column in zip(XY, now.T):
                field = table.schema.field(c)
                table = table.set_column(table.column_names.index(c), field, pa.array(column).cast(field.type))
            key = pa.array([places.get(k) for k in range(len(page))], pa.list_(pa.int64())) if places else pa.nulls(len(page), pa.list_(pa.int64()))
            yield from table.append_column("_key", key).filter(pa.array(stay)).cast(arrow).to_batches()

    return boxes.repartition(*keys).sortWithinPartitions(*keys, order).mapInArrow(run, schema)


def _floats(column: pa.ChunkedArray) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy()


def _numbered(table: pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of each row, and the rows at which groups begin."""
    opens = np.zeros(table.num_rows, bool)
    for k in keys:
        value = table[k].cast(pa.int64()).fill_null(NULL).to_numpy()
        opens[1:] |= value[1:] != value[:-1]
    return np.cumsum(opens), np.flatnonzero(np.r_[True, opens[1:]] if len(opens) else opens)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted batches as tables of whole groups; the open group is held until the next one begins."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        joined = pa.concat_tables([held[-1].slice(held[-1].num_rows - 1), table]) if held else table
        starts = _numbered(joined, keys)[1] - (1 if held else 0)
        last = int(starts[-1])
        if last > 0 or (last == 0 and held):
            yield pa.concat_tables([*held, table.slice(0, last)])
            held = []
        held.append(table.slice(max(last, 0)))
    if held:
        yield pa.concat_tables(held)


# ---- pairs of boxes of a page


def _area(b: np.ndarray) -> np.ndarray:
    return (b[..., 2] - b[..., 0]) * (b[..., 3] - b[..., 1])


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    w = np.minimum(a[..., 2], b[..., 2]) - np.maximum(a[..., 0], b[..., 0])
    h = np.minimum(a[..., 3], b[..., 3]) - np.maximum(a[..., 1], b[..., 1])
    return np.maximum(w, 0) * np.maximum(h, 0)


def _hull(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.r_[np.minimum(a[:2], b[:2]), np.maximum(a[2:], b[2:])]


def _expanded(first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, place) for all places first[row]..last[row], the last left out, in blocks."""
    n = np.maximum(last - first, 0)
    ends = np.cumsum(n)
    at = 0
    while at < len(n):
        end = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, "right")), at + 1)
        rows = np.repeat(np.arange(at, end), n[at:end])
        yield rows, np.arange(len(rows)) - np.repeat(ends[at:end] - n[at:end] - (ends[at - 1] if at else 0), n[at:end]) + first[rows]
        at = end


def meeting(page_a: np.ndarray, a: np.ndarray, page_b: np.ndarray, b: np.ndarray, inside: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of pairs of a page whose boxes share area. ``inside``: only those where the middle of b lies in a.

    Boxes go to the bands of y that they cover, those of b in order of x; a pair is taken from the band of its common upper edge.
    """
    if not len(a) or not len(b):
        return
    band = max(float((b[:, 3] - b[:, 1]).mean()), 1e-9)
    base = min(a[:, 1].min(), b[:, 1].min())
    level = lambda y: np.floor((y - base) / band).astype(np.int64)
    rows_a, bands_a = (np.concatenate(x) for x in zip(*_expanded(level(a[:, 1]), level(a[:, 3]) + 1)))
    if inside:
        x, rows_b, bands_b = (b[:, 0] + b[:, 2]) / 2, np.arange(len(b)), level((b[:, 1] + b[:, 3]) / 2)
        reach = 0.0
    else:
        rows_b, bands_b = (np.concatenate(x) for x in zip(*_expanded(level(b[:, 1]), level(b[:, 3]) + 1)))
        x, reach = b[rows_b, 0], float((b[:, 2] - b[:, 0]).max())
    bands = int(max(bands_a.max(), bands_b.max())) + 1
    left = min(a[:, 0].min(), b[:, 0].min()) - reach
    width = 2.0 ** np.ceil(np.log2(max(a[:, 2].max(), b[:, 2].max()) - left + 1))
    key = (page_b[rows_b] * bands + bands_b) * width + (x - left)
    order = np.argsort(key, kind="stable")
    key, rows_b, bands_b = key[order], rows_b[order], bands_b[order]
    place = (page_a[rows_a] * bands + bands_a) * width - left
    first = np.searchsorted(key, place + a[rows_a, 0] - reach, "left")
    last = np.searchsorted(key, place + a[rows_a, 2], "right")
    for at, k in _expanded(first, last):
        i, j = rows_a[at], rows_b[k]
        ok = (a[i, 0] < b[j, 2]) & (b[j, 0] < a[i, 2]) & (a[i, 1] < b[j, 3]) & (b[j, 1] < a[i, 3])
        if not inside:
            ok &= level(np.maximum(a[i, 1], b[j, 1])) == bands_b[k]
        yield i[ok], j[ok]


def linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest number that each of 0..n-1 reaches over the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def settle(page: np.ndarray, xy: np.ndarray, score: np.ndarray, number: np.ndarray, rule: Rule, seeds_share: float, share: float | None) -> Settled:
    """Who stays, the last box of each, and places, for rows in order of page and list."""
    n = len(page)
    stay, now, places = np.ones(n, bool), xy.copy(), {}
    area = np.where((xy[:, 2] > xy[:, 0]) & (xy[:, 3] > xy[:, 1]), _area(xy), 0)
    seeds = [(np.zeros(0, np.int64),) * 2]
    for i, j in meeting(page, xy, page, xy, inside=True):
        over = (i != j) & (area[j] > 0) & (_common(xy[i], xy[j]) >= seeds_share * area[j])
        seeds.append((i[over], j[over]))
    outer, inner = (np.concatenate(x) for x in zip(*seeds))
    label = linked(n, outer, inner)
    todo = np.unique(label[outer])  # groups to settle
    while len(todo):
        changed = _settle_groups(todo, label, outer, inner, xy, score, number, rule, stay, now, places)
        if share is None or not len(changed):
            break
        hits = [(np.zeros(0, np.int64),) * 2]
        for i, j in meeting(page[changed], now[changed], page, now, inside=False):
            i = changed[i]
            over = (label[i] != label[j]) & (_common(now[i], now[j]) > share * np.minimum(area[i], area[j]))
            hits.append((label[i[over]], label[j[over]]))
        a, b = (np.concatenate(x) for x in zip(*hits))
        label = linked(n, a, b)[label]
        todo = np.unique(label[a])
    return stay, now, places


def _settle_groups(todo, label, outer, inner, xy, score, number, rule, stay, now, places) -> np.ndarray:
    """Runs ``rule`` on the groups named; returns the rows whose boxes have grown."""
    rows = np.flatnonzero(np.isin(label, todo))
    rows = rows[np.argsort(label[rows], kind="stable")]
    ends = np.r_[np.flatnonzero(np.diff(label[rows])) + 1, len(rows)]
    at = np.empty(len(label), np.int64)  # place in the group
    starts = np.r_[0, ends[:-1]]
    at[rows] = np.arange(len(rows)) - np.repeat(starts, ends - starts)
    held = np.isin(label[outer], todo)
    a, b = outer[held], inner[held]
    by = np.argsort(label[a], kind="stable")
    a, b = a[by], b[by]
    cut = np.searchsorted(label[a], label[rows[starts]])
    cut = np.r_[cut, len(a)]
    a, b = at[a].tolist(), at[b].tolist()
    for k, (first, last) in enumerate(zip(starts.tolist(), ends.tolist())):
        own = rows[first:last]
        pairs = list(zip(a[cut[k]:cut[k + 1]], b[cut[k]:cut[k + 1]]))
        stay[own], now[own], made = rule(xy[own], score[own], number[own], pairs)
        for m in own if places else ():
            places.pop(int(m), None)
        places.update((int(own[m]), place) for m, place in made.items())
    return rows[(now[rows] != xy[rows]).any(axis=1)]


# ---- rules on one group; pairs (i, j): enough of j lies inside i


def _over(boxes: np.ndarray, k: int, threshold: float) -> np.ndarray:
    """Who overlaps box ``k`` by more than ``threshold`` of the smaller of both."""
    area = _area(boxes)
    small = np.minimum(area, area[k])
    found = (small > 0) & (_common(boxes[k], boxes) > threshold * small)
    found[k] = False
    return np.flatnonzero(found)


def absorbing(threshold: float, by_score: bool = False) -> Rule:
    """Of two boxes overlapping by more than ``threshold`` of the smaller, the larger takes both areas and the smaller goes. Boxes that
    are gone still compare, but are not absorbed twice. ``by_score``: a smaller box with the better score makes the larger one go,
    ungrown, and boxes that are gone take no further part, but for one that goes while it is the outer one of the list.

    Pairs wait in list order; when a box has grown, its pairs further down the list are found anew.
    """

    def rule(boxes: np.ndarray, score: np.ndarray, number: np.ndarray, pairs: list[tuple[int, int]]) -> Settled:
        boxes, gone, score = boxes.copy(), [False] * len(boxes), score.tolist()
        waiting = sorted({(i, j) if i < j else (j, i) for i, j in pairs})
        at = (-1, -1)
        while waiting:
            pair = heapq.heappop(waiting)
            i, j = pair
            if pair <= at or (by_score and (gone[j] or (gone[i] and i != at[0]))):
                continue
            (ax0, ay0, ax1, ay1), (bx0, by0, bx1, by1) = a, b = boxes[i].tolist(), boxes[j].tolist()
            area_a, area_b = (ax1 - ax0) * (ay1 - ay0), (bx1 - bx0) * (by1 - by0)
            w, h = min(ax1, bx1) - max(ax0, bx0), min(ay1, by1) - max(ay0, by0)
            least = min(area_a, area_b)
            if w <= 0 or h <= 0 or least <= 0 or not w * h / least > threshold:
                continue
            small, large = (i, j) if area_a <= area_b else (j, i)
            if by_score and score[small] > score[large]:
                gone[large], at = True, pair
            elif not gone[small]:
                gone[small], at = True, pair
                grown = [min(ax0, bx0), min(ay0, by0), max(ax1, bx1), max(ay1, by1)]
                if grown != (b if large == j else a):
                    boxes[large] = grown
                    for k in _over(boxes, large, threshold * (1 - 1e-12)).tolist():
                        if (new := (large, k) if large < k else (k, large)) > at:
                            heapq.heappush(waiting, new)
        return ~np.array(gone), boxes, {}

    return rule


def merging(threshold: float) -> Rule:
    """The first pair of the list with IoU above ``threshold`` becomes its hull, placed last, with the columns of its first member.

    Places tell the order in the list of the whole page: that of a box is its number; merged boxes come after all of those, in order of
    their merges. Over all groups of a page merges happen by the place of the pair's first member, but not before the merges of their
    group that they follow, so a merge's place is the greatest such place so far and its number in the group.
    """

    def alike(b: np.ndarray, others: np.ndarray) -> np.ndarray:
        both = _common(b, others)
        union = _area(b) + _area(others) - both
        return (both > 0) & (np.divide(both, union, out=np.zeros(len(others)), where=union > 0) > threshold)

    def rule(boxes: np.ndarray, score: np.ndarray, number: np.ndarray, pairs: list[tuple[int, int]]) -> Settled:
        n = len(boxes)
        place, inside, live = [[int(o)] for o in number], [[k] for k in range(n)], [True] * n
        made, latest = 0, []
        waiting = sorted({(i, j) if i < j else (j, i) for i, j in pairs})
        waiting = [(i, j) for i, j in waiting if alike(boxes[i], boxes[j:j + 1])[0]]
        while waiting:
            i, j = heapq.heappop(waiting)
            if not (live[i] and live[j]):
                continue
            latest = max(latest, place[i])
            place.append([LATE, *latest, made])
            made += 1
            live[i] = live[j] = False
            new = _hull(boxes[i], boxes[j])
            for k in np.flatnonzero(alike(new, boxes) & np.array(live)).tolist():
                heapq.heappush(waiting, (k, len(boxes)))
            boxes = np.vstack((boxes, new))
            live.append(True)
            inside.append(inside[i] + inside[j])
        stay, last, places = np.zeros(n, bool), boxes[:n].copy(), {}
        for k in np.flatnonzero(live).tolist():
            first = inside[k][0]
            stay[first], places[first] = True, place[k]
            last[inside[k]] = boxes[k]
        return stay, last, places

    return rule


def outvoting(share: float) -> Rule:
    """A box with two or more live boxes inside either takes them over (its score beats their mean) or goes itself. Inside is judged by
    the boxes as they came in; hulls only grow the result."""

    def rule(boxes: np.ndarray, score: np.ndarray, number: np.ndarray, pairs: list[tuple[int, int]]) -> Settled:
        held: dict[int, list[int]] = {}
        for i, j in pairs:
            held.setdefault(i, []).append(j)
        now, gone = boxes.copy(), np.zeros(len(boxes), bool)
        for i in sorted(held):
            inner = [j for j in sorted(held[i]) if not gone[j]]
            if gone[i] or len(inner) < 2:
                continue
            if score[i] > sum(score[j] for j in inner) / len(inner):
                gone[inner] = True
                for j in inner:
                    now[i] = _hull(now[i], now[j])
            else:
                gone[i] = True
        return ~gone, now, {}

    return rule
