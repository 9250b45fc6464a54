import hashlib
import random
import re

import pytest

from pageloom.llm.decontaminate import Params, alignments, find, items, leaders, postings, report, term_counts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(docs, bench, size=10):
    out = set()
    for i, t in docs:
        w, hit, ids = split(t), set(), set()
        for item, b in bench:
            v = split(b)
            n = min(size, len(v))
            windows = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if v else set()
            for k in range(len(w) - n + 1 if v else 0):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    ids.add("" if item is None else str(item))
        out.add((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.fixture
def bench(spark):
    return lambda pairs: spark.createDataFrame(pairs, "item_id long, text string")


def rows(docs, bench, p=Params()):
    got = report(find(docs, bench, p)).collect()
    return {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got}


@pytest.mark.parametrize("bound", [200_000, 0])
def test_same_as_all_windows(documents, bench, prose, bound):
    r = random.Random(1)
    passages = [(k, prose(100 + k, r.choice([1, 3, 9, 10, 11, 40]))) for k in range(25)]
    passages += [(50, passages[5][1]), (50, "The THE the the the the the the the the the the"), (51, ""), (52, None), (None, prose(77, 30)), (53, "«École» déjà—vu ÉCOLE")]
    texts = []
    for k in range(120):
        w = prose(k, r.randrange(0, 120)).split()
        for _ in range(r.randrange(3)):
            v = (r.choice(passages)[1] or "").split()
            a = r.randrange(len(v) + 1)
            at = r.randrange(len(w) + 1)
            w[at:at] = v[a:a + r.randrange(1, 40)]
        texts.append((k, r.choice([" ", "\n", ", "]).join(w)))
    texts += [(500, None), (501, ""), (502, "the " * 500), (503, "ÉCOLE déjà vu école"), (504, "«École déjà vu ÉCOLE»"), (505, "no words" + " " * 9)]
    assert rows(documents(texts), bench(passages), Params(broadcast_terms=bound)) == plain(texts, passages)


def test_odd_rows(documents, bench, clashing, prose):
    p = prose(5, 30)
    texts = [(1, p), (1, p), (1, "other " + p[:40]), (None, p), (2, None), (3, "x" * 200_000)]
    got = report(find(clashing(documents(texts)), bench([(7, p), (7, p)]))).collect()
    assert len(got) == 6 and {(r.doc_id, r.n_items) for r in got} == {(1, 1), (1, 0), (None, 1), (2, 0), (3, 0)}
    assert rows(documents(texts), bench([])) == plain(texts, [])
    assert rows(documents([]), bench([(1, p)])) == set()


def test_proximity(documents, bench):
    """With a slop, leaders that stand somewhat nearer or farther than in the item still align."""
    item = bench([(1, "quokka juggles seven purple melons")])
    docs = documents([(1, "a quokka juggles about seven purple melons"), (2, "quokka x x x x x x x x x x melons"), (3, "quokka juggles seven purple melons")])
    found = {}
    for slop in (0, 1):
        p = Params(slop=slop)
        b = items(item)
        lead = leaders(b, term_counts(docs, b, p), p)
        found[slop] = {r.doc_id for r in alignments(postings(docs, lead, p), lead, p).collect()}
    assert 3 in found[0] and found[0] <= found[1] and 1 in found[1] and 2 not in found[1]
    got = {r.doc_id: r for r in find(docs, item, Params(slop=1)).collect()}
    assert [m.item_id for m in got[1].near] == ["1"] and not got[1].matches
    assert not got[2].near and not got[2].matches
    assert [(m.item_id, m.starts) for m in got[3].matches] == [("1", [0])] and not got[3].near


def test_no_python_in_the_plan(documents, bench):
    plan = report(find(documents([(1, "a b")]), bench([(1, "a b")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
