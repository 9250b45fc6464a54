"""Plain loops that say what the order-dependent steps mean, on lists of boxes."""

import random


def area(b):
    return (b[2] - b[0]) * (b[3] - b[1])


def common(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    return max(w, 0) * max(h, 0)


def of_smaller(a, b):
    m = min(area(a), area(b))
    return common(a, b) / m if m else 0


def iou(a, b):
    u = area(a) + area(b) - common(a, b)
    return common(a, b) / u if area(a) and area(b) else 0


def union(a, b):
    return (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))


def absorb(boxes, t):
    boxes, removed = dict(enumerate(boxes)), []
    for i in range(len(boxes)):
        for j in range(i + 1, len(boxes)):
            if of_smaller(boxes[i], boxes[j]) > t:
                small, big = (i, j) if area(boxes[i]) <= area(boxes[j]) else (j, i)
                if small not in removed:
                    boxes[big] = union(boxes[big], boxes[small])
                    removed.append(small)
    return {k: b for k, b in boxes.items() if k not in removed}


def absorb_scored(boxes, scores, t):
    boxes, removed = dict(enumerate(boxes)), []
    for i in range(len(boxes)):
        if i in removed:
            continue
        for j in range(i + 1, len(boxes)):
            if j in removed:
                continue
            if of_smaller(boxes[i], boxes[j]) > t:
                small, big = (i, j) if area(boxes[i]) <= area(boxes[j]) else (j, i)
                if scores[small] <= scores[big]:
                    if small not in removed:
                        boxes[big] = union(boxes[big], boxes[small])
                        removed.append(small)
                elif big not in removed:
                    removed.append(big)
    return {k: b for k, b in boxes.items() if k not in removed}


def merge_alike(boxes, t):
    items = [(k, b) for k, b in enumerate(boxes)]
    changed = True
    while changed:
        changed = False
        for i in range(len(items)):
            for j in range(i + 1, len(items)):
                if iou(items[i][1], items[j][1]) > t:
                    new = (items[i][0], union(items[i][1], items[j][1]))
                    items = [x for k, x in enumerate(items) if k not in (i, j)] + [new]
                    changed = True
                    break
            if changed:
                break
    return dict(items)


def big_or_inner(boxes, scores, share):
    now, removed = list(boxes), set()
    for i in range(len(boxes)):
        if i in removed:
            continue
        inside = [j for j in range(len(boxes)) if j != i and j not in removed and common(boxes[j], boxes[i]) > 0
                  and common(boxes[j], boxes[i]) >= share * area(boxes[j])]
        if len(inside) >= 2:
            if scores[i] > sum(scores[j] for j in inside) / len(inside):
                removed |= set(inside)
                for j in inside:
                    now[i] = union(now[i], now[j])
                now[i] = union(now[i], boxes[i])
            else:
                removed.add(i)
    return {k: now[k] for k in range(len(boxes)) if k not in removed}


def eliminate(pairs):
    """pairs: (i, j, loser) in order."""
    gone = set()
    for i, j, loser in sorted(pairs):
        if i not in gone and j not in gone:
            gone.add(loser)
    return gone


def xy_cut(boxes, ids=None):
    """Order of indices: bands by gaps in y, columns by gaps in x, recursively."""
    ids = list(range(len(boxes))) if ids is None else ids

    def split(idx, lo, hi):
        groups, reach = [], None
        for k in sorted(idx, key=lambda k: (boxes[k][lo], k)):
            if reach is None or boxes[k][lo] > reach:
                groups.append([])
                reach = boxes[k][hi]
            groups[-1].append(k)
            reach = max(reach, boxes[k][hi])
        return groups

    out = []
    for band in split(ids, 1, 3):
        columns = split(band, 0, 2)
        if len(columns) == 1:
            out += sorted(band, key=lambda k: (boxes[k][0], boxes[k][1], k))
        else:
            for column in columns:
                out += xy_cut(boxes, column)
    return out


def outside(a, b):
    """Share of a's height outside b; None without height."""
    size = a[3] - a[1]
    return (size - (min(a[3], b[3]) - max(a[1], b[1]))) / size if size > 0 else None


def settle_rows(boxes, tolerance, share=None):
    order = sorted(range(len(boxes)), key=lambda k: (boxes[k][1], boxes[k][0], k))
    for i in range(len(order) - 1):
        for j in range(i, -1, -1):
            p, q = boxes[order[j]], boxes[order[j + 1]]
            near = share is None or (outside(p, q) or 0) < share or (outside(q, p) or 0) < share
            if abs(q[1] - p[1]) < tolerance and q[0] < p[0] and near:
                order[j], order[j + 1] = order[j + 1], order[j]
            else:
                break
    return order


def gather(pieces, gap, share):
    """Texts of a cell's rows from (box, text) in order: the first piece left takes all that lie on its height, again and again."""
    out = []
    while pieces:
        (head, text), rest = pieces[0], []
        for box, more in pieces[1:]:
            if any(s is None or s < share for s in (outside(head, box), outside(box, head))):
                text += " " * int(max(box[0] - head[2], 0) / gap) + more
                head = union(head, box)
            else:
                rest.append((box, more))
        out.append(text)
        pieces = rest
    return out


def gap2(a, b):
    return max(a[0] - b[2], b[0] - a[2], 0) ** 2 + max(a[1] - b[3], b[1] - a[3], 0) ** 2


def pair_by_distance(boxes, kinds):
    """Parts (kind 1) to bodies (kind 0), pair by pair from the top-left corner of what is free; boxes inside one of their kind are left out."""
    def inside(k, o):
        return kinds[k] == kinds[o] and k != o and boxes[k][0] >= boxes[o][0] and boxes[k][1] >= boxes[o][1] and boxes[k][2] <= boxes[o][2] and boxes[k][3] <= boxes[o][3]

    free = [k for k in range(len(boxes)) if not any(inside(k, o) for o in range(len(boxes)))]
    free.sort(key=lambda k: (kinds[k], boxes[k][0] ** 2 + boxes[k][1] ** 2, k))
    bodies, parts, pairs = [k for k in free if kinds[k] == 0], [k for k in free if kinds[k] == 1], []
    while len({b for b, _ in pairs}) < len(bodies):
        if not free:
            break
        x, y = min(boxes[k][0] for k in free), min(boxes[k][1] for k in free)
        ranked = sorted(free, key=lambda k: (boxes[k][0] - x) ** 2 + (boxes[k][1] - y) ** 2)
        others = [k for k in ranked if kinds[k] != kinds[ranked[0]]]
        if not others:
            break
        other = min(others, key=lambda k: gap2(boxes[ranked[0]], boxes[k]))
        body, part = sorted((ranked[0], other), key=lambda k: kinds[k])
        free.remove(body)
        if gap2(boxes[body], boxes[part]) < 9 * min(gap2(boxes[b], boxes[part]) for b in bodies):
            free.remove(part)
            pairs.append((body, part))
    pairs += [(min(bodies, key=lambda b: gap2(boxes[b], boxes[p])), p) for p in parts if p in free and bodies]
    return pairs + [(b, None) for b in bodies if b not in {x for x, _ in pairs}]


def random_pages(n_pages, n_boxes, seed, size=100):
    """Pages with near copies, equal boxes, zero areas and score ties."""
    rnd = random.Random(seed)
    pages = []
    for _ in range(n_pages):
        boxes = []
        for _ in range(rnd.randint(0, n_boxes)):
            kind = rnd.random()
            if boxes and kind < 0.25:
                x0, y0, x1, y1 = rnd.choice(boxes)
                d = rnd.randint(0, 2)
                boxes.append((x0 + d, y0, x1 + d, y1))
            elif boxes and kind < 0.4:
                x0, y0, x1, y1 = rnd.choice(boxes)
                boxes.append((x0 + (x1 - x0) // 4, y0 + (y1 - y0) // 4, x1, y1))
            else:
                x0, y0 = rnd.randint(0, size), rnd.randint(0, size)
                boxes.append((x0, y0, x0 + rnd.choice([0, 10, 20, 40]), y0 + rnd.choice([5, 10, 30])))
        pages.append((boxes, [rnd.randint(0, 4) / 4 for _ in boxes]))
    return pages


def random_clusters(n_clusters, n_boxes, seed):
    """Boxes of clusters far from each other, in mixed order; inside a cluster they nearly coincide."""
    rnd = random.Random(seed)
    boxes = [(300 * c + rnd.randint(0, 14), rnd.randint(0, 6), 300 * c + 60 + rnd.randint(0, 14), 40 + rnd.randint(0, 6))
             for c in range(n_clusters) for _ in range(n_boxes)]
    rnd.shuffle(boxes)
    return boxes
