import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pageloom.llm.ranked_search import Params, Shard, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def plain(docs, bench, best=20):
    counts = [(i, Counter(split(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = set()
    for item, text in set(bench):
        scored = []
        for i, c in counts:
            m = 75 + (25 * c.total() * n_docs) // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in split(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i))
        out |= {(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored)[:best])}
    return out


@pytest.fixture
def bench(spark):
    return lambda pairs: spark.createDataFrame(pairs, "item_id long, text string")


def rows(df):
    return {(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()}


@pytest.mark.parametrize("p", [Params(), Params(shard=300, block=20, wave=3, broadcast_terms=0), Params(best=1)], ids=["production", "many shards", "one"])
def test_same_as_scoring_all(documents, bench, prose, p):
    r = random.Random(2)
    asked = [(k, prose(500 + k, r.choice([1, 2, 5, 20, 40]))) for k in range(20)]
    asked += [(30, "Kilo kilo KILO lemon"), (31, "nowhere zzz"), (32, ""), (33, None), (None, "river stone"), (34, "École élan é")]
    texts = [(k, prose(k, r.choice([0, 1, 3, 10, 60, 200]))) for k in range(250)]
    texts += [(k, texts[7][1]) for k in range(300, 340)]  # forty copies: equal scores
    texts += [(400, None), (401, "..."), (402, "école ÉCOLE élan"), (403, "kilo " * 30_000), (None, "river stone kilo")]
    assert rows(search(documents(texts), bench(asked), p)) == plain(texts, asked, p.best)


def test_odd_rows(documents, bench, clashing):
    texts = [(1, "alpha beta"), (1, "alpha beta"), (1, "alpha"), (2, None), (3, "gamma"), (None, "alpha gamma")]
    assert rows(search(clashing(documents(texts)), bench([(7, "alpha"), (7, "alpha"), (8, "gamma alpha")]))) == plain(texts, [(7, "alpha"), (8, "gamma alpha")])
    assert rows(search(documents([]), bench([(7, "alpha")]))) == set()
    assert rows(search(documents(texts), bench([]))) == set()
    assert rows(search(documents([(1, None), (2, "")]), bench([(7, "alpha")]))) == set()


def test_range_maxima_are_exact():
    r = np.random.default_rng(5)
    at = np.unique(np.stack((r.integers(0, 6, 400), r.integers(0, 100, 400)), axis=1), axis=0)
    impact = r.integers(1, 50, len(at))
    shard = Shard(at[:, 0] * 10, at[:, 1], impact, 100)
    assert (shard.terms == np.arange(6) * 10).all()
    for _ in range(300):
        t, a, b = r.integers(0, 6), *sorted(r.integers(0, 101, 2))
        first, last = np.searchsorted(shard.keys, [[t * 100 + a], [t * 100 + b]])
        inside = impact[(at[:, 0] == t) & (at[:, 1] >= a) & (at[:, 1] < b)]
        assert (shard.best(first, last) >> 21)[0] == (inside.max() if len(inside) else 0)


def test_intervals_are_dropped(monkeypatch):
    """Of many documents with one strong one, few intervals are looked at."""
    size = 4096
    impact = np.r_[np.full(size - 1, 5), 900]
    shard = Shard(np.zeros(size, np.int64), np.arange(size), impact, size)
    seen = []
    bounds = Shard._bounds
    monkeypatch.setattr(Shard, "_bounds", lambda self, a, b, w: seen.append(a.shape[1]) or bounds(self, a, b, w))
    docs, scores = shard.search(np.zeros(1, np.int64), np.full(1, 3, np.int64), 4, 2)
    assert docs.tolist() == [size - 1, 0, 1, 2] and scores.tolist() == [2700, 15, 15, 15] and sum(seen) < 100
