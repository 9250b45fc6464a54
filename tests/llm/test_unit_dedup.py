import random
import re

from pageloom.llm.unit_dedup import Params, remove, removed

UNIT = re.compile(r"[^.!?\n]+[.!?\n]*|[.!?\n]+")


def plain(pairs, least):
    first, out = {}, set()
    for i, t in sorted(set((i, t) for i, t in pairs if t)):
        run, before = [], -1
        units = [(m.start(), m.end(), m[0].translate({c: c + 32 for c in range(65, 91)}).split()) for m in UNIT.finditer(t)]
        units = [u for u in units if u[2]]
        later = []
        for a, b, w in units:
            key = " ".join(w)
            later.append(key in first)
            first.setdefault(key, (i, a))
        k = 0
        while k < len(units):
            e = k
            while e < len(units) and later[e]:
                e += 1
            if e > k and sum(len(u[2]) for u in units[k:e]) >= least:
                out.add((i, units[k][0], units[e - 1][1], *first[" ".join(units[k][2])]))
            k = max(e, k + 1)
    return out


def test_same_as_a_loop(documents, prose):
    r = random.Random(4)
    shared = [". ".join(prose(900 + k * 9 + j, r.randrange(3, 14)) for j in range(6)) + "." for k in range(8)]
    pairs = []
    for k in range(80):
        parts = [prose(k * 5 + j, 12) + r.choice([".", "!", "?!", "\n", ""]) for j in range(4)]
        if k % 2:
            parts.insert(r.randrange(5), r.choice(shared).upper() if k % 5 == 0 else r.choice(shared))
        pairs.append((k, r.choice([" ", "\n"]).join(parts)))
    pairs += [(200, None), (201, ""), (202, " \n.\n"), (203, pairs[3][1]), (204, "Hi. " * 50)]
    for least in (1, 20):
        got = removed(documents(pairs), Params(min_words=least)).collect()
        assert {(x.doc_id, x.start, x.end, x.first_doc_id, x.first_start) for x in got} == plain(pairs, least)


def test_cut_text_keeps_the_rest_and_its_offsets(documents, clashing):
    text = "Keep this. " + "One two three four five. Six seven eight nine ten. " * 1 + "Tail"
    pairs = [(1, text), (2, "Other start. " + text), (2, "Other start. " + text), (3, None), (4, "")]
    rows = remove(clashing(documents(pairs)), Params(min_words=5)).collect()
    assert len(rows) == 5
    for r in rows:
        original = dict(pairs)[r.doc_id]
        if r.doc_id == 2:
            (a, b, source), = [tuple(s) for s in r.spans]
            assert source == 1 and r.text == original[:a] + original[b:] == "Other start."
        else:
            assert r.text == original and not r.spans
    assert removed(documents([])).count() == 0
