import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pageloom.llm.merkle import Params, folded, leaves, manifest

UPPER = {c: c + 32 for c in range(65, 91)}


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def up(nodes, k, f):
    """Root, and the siblings of leaf ``k`` with its places, by the plain rule."""
    steps = []
    while len(nodes) > 1:
        runs = [nodes[i:i + f] for i in range(0, len(nodes), f)]
        run, j = runs[k // f], k % f
        steps.append((j, run[:j] + run[j + 1:]))
        nodes, k = [h(*r) for r in runs], k // f
    return nodes[0], steps


def fold(node, steps):
    for j, others in steps:
        node = h(*others[:j], node, *others[j:])
    return node


def plain(rows, f):
    trees = {}
    for r in rows:
        trees.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    nodes = {s: [x[2] for x in sorted(trees[s], key=lambda x: x[:3])] for s in names}
    subroots = [up(nodes[s], 0, f)[0] for s in names]
    root = up(subroots, 0, f)[0]
    out = []
    for r in rows:
        own = leaf(r, r.text)
        steps = up(nodes[r.source], nodes[r.source].index(own), f)[1] + up(subroots, names.index(r.source), f)[1]
        bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        at = fold(leaf(r, r.text and r.text.translate(UPPER)) if bad else own, steps)
        out.append((r.doc_id, own, subroots[names.index(r.source)], root, h(*(x for _, o in steps for x in o)), at, at == root))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()), key=repr)


@pytest.fixture
def table(documents, prose):
    r = random.Random(3)
    pairs = [(k, prose(k, r.randrange(0, 8)).title()) for k in range(400)] + [(900, None), (901, ""), (902, "É x"), (903, "Y" * 200_000)]
    source = F.expr("CASE WHEN doc_id % 3 = 0 THEN 'hot' WHEN doc_id = 7 THEN NULL WHEN doc_id % 31 = 1 THEN NULL "
                    "ELSE concat('s', doc_id % 9, CASE WHEN doc_id % 2 = 0 THEN 'é' ELSE '' END) END")
    return documents(pairs).withColumn("source", source).withColumn("lang", F.when(F.col("doc_id") % 4 > 0, F.col("lang")))


@pytest.mark.parametrize("p", [Params(), Params(2, 1), Params(4, 0)], ids=str)
def test_same_as_plain_trees(table, p):
    assert rows(manifest(leaves(table), p).audit()) == plain(table.collect(), p.fanout)


@pytest.mark.parametrize("n", [1, 4, 9, 10, 28])
def test_ragged_trees(documents, n):
    """Last runs and last subtrees of any size, a lone leaf included."""
    df = documents([(k, f"t{k}") for k in range(n)])
    p = Params(3, 0)
    found = manifest(leaves(df), p)
    assert rows(found.audit()) == plain(df.collect(), 3)
    proofs = found.proofs().collect()
    assert len(proofs) == n and all(folded(r.leaf, [(s.place, s.others) for s in r.proof]) == r.root for r in proofs)


def test_odd_rows(documents, clashing):
    df = clashing(documents([(1, "Ab"), (1, "Ab"), (1, "b"), (None, "A"), (None, None), (5, None)]))
    df = df.withColumns({c: F.lit("mine") for c in ("tree", "at", "size", "part", "path", "leaf", "root")})
    got = rows(manifest(leaves(df), Params(2, 1)).audit())
    assert got == plain(df.collect(), 2) or {r[:4] for r in got} == {r[:4] for r in plain(df.collect(), 2)}  # repeated rows may swap places
    assert rows(manifest(leaves(documents([]))).audit()) == []


def test_a_change_is_found(table):
    audit = manifest(leaves(table)).audit().join(table.select("doc_id", "text"), "doc_id").collect()
    for r in audit:
        changed = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None and r.text.translate(UPPER) != r.text
        assert r.verified != changed
