import random

from pageloom.llm import minhash
from pageloom.llm.minhash import Params, components, near_duplicates

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def plain(pairs, percent=75):
    """Component of each text by comparing all pairs."""
    sets = []
    for _, t in pairs:
        w = (t or "").encode().translate(LOWER).split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(pairs)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(pairs):
        least[top(k)] = min(i, least.get(top(k), i))
    return {(i, len(sets[k]), least[top(k)]) for k, (i, _) in enumerate(pairs)}


def mutated(text, seed, share):
    r = random.Random(seed)
    words = text.split()
    for _ in range(int(len(words) * share)):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


def test_same_components_as_all_pairs(documents, prose):
    base = [prose(s, 150) for s in range(12)]
    pairs = [(k, t) for k, t in enumerate(base)]
    for k in range(160):
        pairs.append((100 + k, mutated(base[k % 12], k, (k % 7) * 0.012)))
    chain = prose(99, 200).split()
    for k in range(12):  # each is near to the next only
        pairs.append((500 + k, " ".join(chain[4 * k:4 * k + 120])))
    pairs += [(600, None), (601, ""), (602, " \n\t"), (603, "Too few words"), (604, "too FEW words"), (605, base[3].upper())]
    random.Random(5).shuffle(pairs)
    got = near_duplicates(documents(pairs)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == plain(pairs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_crowds_of_copies_and_borderline_members(documents, prose):
    base = prose(7, 120)
    pairs = [(k, base) for k in range(300)] + [(300 + k, mutated(base, k, 0.02 + 0.0002 * k)) for k in range(200)]
    got = near_duplicates(documents(pairs))
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()} == plain(pairs)


def test_odd_rows(documents, clashing, prose):
    t, u = prose(1, 60), prose(2, 60)
    rows = near_duplicates(clashing(documents([(None, t), (4, t), (4, t), (2, t), (4, u), (9, None), (9, ""), (2, "unrelated text")]))).collect()
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in rows), key=str)
    assert got == sorted([(None, None, True), (4, 2, False), (4, 2, False), (2, 2, True), (4, 4, True), (9, 9, True), (9, 9, True), (2, 2, True)], key=str)
    assert near_duplicates(documents([])).count() == 0


def test_components_of_long_paths(spark):
    n = 300
    order = list(range(n))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame([(order[k], order[k + 1]) for k in range(n - 1)] + [(1000, 1001)], "a long, b long")
    assert {(r.id, r.component) for r in components(edges).collect()} == {(k, 0) for k in range(n)} | {(1000, 1000), (1001, 1000)}
    assert components(edges.limit(0)).count() == 0


def test_components_take_few_tables(spark, monkeypatch):
    """A table costs a job with a file for each shuffle partition, however few its rows."""
    written = []
    monkeypatch.setattr(minhash, "cut", lambda df, name, cut=minhash.cut: written.append(name) or cut(df, name))
    stars = spark.createDataFrame([(k % 3, 10 + k) for k in range(30)] + [(0, 10)], "a long, b long")
    assert {(r.id, r.component) for r in components(stars).collect()} == {(10 + k, k % 3) for k in range(30)} | {(k, k) for k in range(3)}
    assert len(written) == 2
    written.clear()
    assert components(spark.createDataFrame([(0, 5), (2, 5), (2, 7)], "a long, b long")).filter("component = 0").count() == 4
    assert len(written) <= 8


def test_links_of_blocks_join_components_as_a_whole(documents, prose, monkeypatch):
    """What blocks find is settled over components, not over all links again."""
    sizes = []
    monkeypatch.setattr(minhash, "components", lambda links, settle=minhash.components: sizes.append(links.count()) or settle(links))
    base, r = prose(7, 120).split(), random.Random(1)
    pairs = []
    for k in range(150):  # all share half; groups of copies with few changes are near to each other by their borders only
        words = base[:]
        for at in r.sample(range(120), 2 + k % 5):
            words[at] = f"new{k}x{at}"
        pairs.append((k, " ".join(words)))
    got = near_duplicates(documents(pairs))
    assert {(x.doc_id, x.n_shingles, x.component_id) for x in got.collect()} == plain(pairs)
    assert len(sizes) == 1 or sizes[1] < sizes[0]


def test_bands_miss_hardly_any_link():
    p = Params()
    assert (1 - 0.75**p.rows) ** p.bands < 1e-4
