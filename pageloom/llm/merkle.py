"""Merkle manifest of a table by butterfly exchange.

1. Every row becomes a leaf, the digest of its fields. Leaves are ordered inside their tree (one tree a source) by a range shuffle; counts
   of its partitions give every leaf its place, without a window over a tree.
2. Places are dealt to aligned parts of fanout ** levels leaves; a part hashes its own subtree.
3. Parts then exchange subtree roots in rounds. In round r a part meets one partner in each sibling subtree of height r, those whose
   number differs from its own in digit r to the base fanout; all of the group hash the same parent redundantly. After as many rounds as
   the number of parts has digits, each part holds the root and the siblings on its way up. Nothing is sent down again.
4. The trees' roots, ordered by source, are leaves of a tree of their own that is built in the same way.
5. Each part joins its leaves with its way up: proofs, or digests of proofs and roots recomputed from claimed leaves.

A tree with a third of all rows only has more parts. A round moves fanout rows for each part, whatever the number of leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, cut

Step = tuple[int, list[str]]  # own place among its siblings, and the siblings' digests


@dataclass(frozen=True)
class Params:
    fanout: int = 16
    levels: int = 3  # of a part's own subtree: 4096 leaves


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of bytes in UTF-8, a colon, and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column) -> Column:
    """Digest of a row of ``documents`` with ``text`` as its text."""
    return digest(F.concat(*(field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")), field(text)))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, claim): claim is the leaf of a row whose text lost its capitals, for every row that counts as tampered with,
    and null for others. tree names the source; it keeps the order of sources, null first."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    return docs.select(tree.alias("tree"), "doc_id", leaf(F.col("text")).alias("leaf"), F.when(tampered, leaf(ascii_lower(F.col("text")))).alias("claim"))


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` plus at, the place in its ``tree`` by ``order`` (nulls first) from 0, and size, the tree's number of nodes.

    Nodes are dealt by ranges of (tree, order), so a large tree is spread over many tasks; only a count for each tree and partition
    goes through a window. Nodes equal in ``order`` keep the places they come by.
    """
    keys = ["tree", *order]
    sorted_ = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_seen", F.monotonically_increasing_id())
    sorted_ = cut(sorted_.withColumn("_task", F.shiftright("_seen", 33)), "merkle-sorted")
    counts = sorted_.groupBy("tree", "_task").agg(F.min("_seen").alias("_first"), F.count("*").alias("_n"))
    tree = Window.partitionBy("tree")
    before = F.sum("_n").over(tree.orderBy("_task").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    starts = cut(counts.select("tree", "_task", (F.col("_first") - before).alias("_shift"), F.sum("_n").over(tree).alias("size")), "merkle-counts")
    return sorted_.join(starts, ["tree", "_task"]).withColumn("at", F.col("_seen") - F.col("_shift")).drop("_seen", "_task", "_shift")


def _joined(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def ladder(nodes: list[str], size: int, p: Params) -> list[list[str]]:
    """Levels of a part's own subtree, leaves first. ``size``: nodes of the whole tree, which ends where one node is left."""
    out = [nodes]
    for _ in range(p.levels):
        if size <= 1:
            break
        nodes = [_joined(nodes[k:k + p.fanout]) for k in range(0, len(nodes), p.fanout)]
        size = -(-size // p.fanout)
        out.append(nodes)
    return out


def way_up(rungs: list[list[str]], k: int, p: Params) -> list[Step]:
    """Of leaf ``k``, level by level: its place among its siblings, and their digests."""
    out = []
    for nodes in rungs[:-1]:
        first = k - k % p.fanout
        out.append((k - first, nodes[first:k] + nodes[k + 1:first + p.fanout]))
        k //= p.fanout
    return out


def folded(node: str, steps: list[Step]) -> str:
    """Root recomputed from a leaf and its proof."""
    for place, others in steps:
        node = _joined([*others[:place], node, *others[place:]])
    return node


def parts(nodes: DataFrame, p: Params) -> DataFrame:
    """(tree, part, parts, node): root of each aligned part's own subtree."""
    width = p.fanout**p.levels

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        size = rows["size"][0].as_py()
        top = ladder(rows["leaf"].to_pylist(), size, p)[-1]
        return pa.table({"tree": rows["tree"][:1], "part": [rows["at"][0].as_py() // width], "parts": [-(-size // width)], "node": top})

    grouped = nodes.select("tree", "at", "size", "leaf").withColumn("part", F.floor(F.col("at") / width)).groupBy("tree", "part")
    return cut(grouped.applyInArrow(run, "tree string, part long, parts long, node string"), "merkle-parts")


def butterfly(subtrees: DataFrame, p: Params) -> DataFrame:
    """(tree, part, node, path): every part with its tree's root and, level by level, its place among its siblings and their digests."""
    f = p.fanout
    state = subtrees.withColumn("path", F.array().cast("array<struct<place:int,others:array<string>>>"))
    most = subtrees.agg(F.max("parts")).first()[0] or 0
    width = 1
    while width < most:
        state = cut(_exchange(state, width, f), f"merkle-round-{width}")
        width *= f
    return state


def _exchange(state: DataFrame, width: int, f: int) -> DataFrame:
    """One round: partners are in subtrees of ``width`` parts each. Where the last subtree of a tree has fewer parts, they serve in turn."""
    number = F.expr(f"part div {width * f}") * f + F.col("digit")
    first = number * width
    there = F.least(F.lit(width), F.col("parts") - first)
    asks = state.filter(F.col("parts") > width).select("tree", "part", "parts", F.explode(F.sequence(F.lit(0), F.lit(f - 1))).alias("digit"))
    asks = asks.filter(first < F.col("parts")).select("tree", "part", "digit", (first + F.col("part") % width % there).alias("partner"))
    told = asks.join(state.select("tree", F.col("part").alias("partner"), "node"), ["tree", "partner"])
    runs = told.groupBy("tree", "part").agg(F.array_sort(F.collect_list(F.struct("digit", "node"))).alias("run"))
    place = (F.expr(f"part div {width}") % f).cast("int")
    others = F.transform(F.filter("run", lambda x: x.digit != place), lambda x: x.node)
    met = F.col("run").isNotNull()
    parent = digest(F.array_join(F.transform("run", lambda x: x.node), ""))
    step = F.array(F.struct(place.alias("place"), others.alias("others")))
    return state.join(runs, ["tree", "part"], "left").select(
        "tree", "part", "parts", F.when(met, parent).otherwise(F.col("node")).alias("node"),
        F.when(met, F.concat("path", step)).otherwise(F.col("path")).alias("path"))


def _climbed(nodes: DataFrame, tops: DataFrame, p: Params, take, schema: str) -> DataFrame:
    """``take(rows, way)`` for every part: its rows in order, and the proof of the k-th one as ``way(k)``."""
    width = p.fanout**p.levels

    def run(rows: pa.Table, top: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        rungs = ladder(rows["leaf"].to_pylist(), rows["size"][0].as_py(), p)
        above = [(s["place"], s["others"]) for s in top["path"][0].as_py()]
        return take(rows, top.slice(0, 1).to_pylist()[0], lambda k: way_up(rungs, k, p) + above)

    split = nodes.withColumn("part", F.floor(F.col("at") / width))
    return split.groupBy("tree", "part").cogroup(tops.groupBy("tree", "part")).applyInArrow(run, schema)


PATH = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.list_(pa.string()))]))


def _as_path(steps: list[Step]) -> list[dict]:
    return [{"place": a, "others": b} for a, b in steps]


@dataclass(frozen=True)
class Manifest:
    """``nodes``: (tree, at, size, leaf, ...) as stored; ``tops``: (tree, part, subroot, root, path) with the whole way up of each part."""

    nodes: DataFrame
    tops: DataFrame
    params: Params

    def proofs(self) -> DataFrame:
        """(tree, at, leaf, proof, root) of every leaf; proof holds place and siblings, level by level."""

        def take(rows, top, way):
            return pa.table({"tree": rows["tree"], "at": rows["at"], "leaf": rows["leaf"], "root": [top["root"]] * rows.num_rows,
                             "proof": pa.array([_as_path(way(k)) for k in range(rows.num_rows)], PATH)})

        return _climbed(self.nodes.select("tree", "at", "size", "leaf"), self.tops, self.params, take,
                        "tree string, at long, leaf string, root string, proof array<struct<place:int,others:array<string>>>")

    def audit(self) -> DataFrame:
        """(tree, doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): for each row the digest of its proof, and the root
        recomputed from its ``claim``, or its leaf where that is null."""
        names = ("proof_sha256", "folded_root")

        def take(rows, top, way):
            found: Iterator[tuple[str, str]] = (
                (_joined([x for _, others in steps for x in others]), folded(claim or own, steps))
                for k, (own, claim) in enumerate(zip(rows["leaf"].to_pylist(), rows["claim"].to_pylist())) for steps in [way(k)])
            pairs = list(zip(*found))
            n = rows.num_rows
            return pa.table({"tree": rows["tree"], "doc_id": rows["doc_id"], "leaf": rows["leaf"], "subroot": [top["subroot"]] * n,
                             "root": [top["root"]] * n, names[0]: list(pairs[0]), names[1]: list(pairs[1])})

        kind = self.nodes.schema["doc_id"].dataType.simpleString()
        out = _climbed(self.nodes.select("tree", "at", "size", "doc_id", "leaf", "claim"), self.tops, self.params, take,
                       f"tree string, doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
        return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest(rows: DataFrame, p: Params = Params()) -> Manifest:
    """Manifest of ``rows`` (tree, doc_id, leaf, claim), as of ``leaves``: leaves of a tree ascend by doc_id, null first, rows that repeat a
    doc_id by leaf. Trees ascend by name. A table without rows has no root and an empty manifest."""
    nodes = cut(placed(cut(rows, "merkle-leaves"), ["doc_id", "leaf"]), "merkle-nodes")
    own = butterfly(parts(nodes, p), p)

    whole = F.lit("").alias("tree")
    subroots = own.filter(F.col("part") == 0).select(whole, F.col("tree").alias("name"), F.col("node").alias("leaf"))
    above = cut(placed(subroots, ["name"]), "merkle-subroots")

    def take(rows, top, way):
        return pa.table({"tree": rows["name"], "subroot": rows["leaf"], "root": [top["node"]] * rows.num_rows,
                         "upper": pa.array([_as_path(way(k)) for k in range(rows.num_rows)], PATH)})

    roots = _climbed(above, butterfly(parts(above, p), p), p, take,
                     "tree string, subroot string, root string, upper array<struct<place:int,others:array<string>>>")
    tops = own.join(cut(roots, "merkle-roots"), "tree").select("tree", "part", "subroot", "root", F.concat("path", "upper").alias("path"))
    return Manifest(nodes, cut(tops, "merkle-tops"), p)


def _oracle(fanout: int = 16, inner: int = 6, outer: int = 4) -> str:
    """SQL of the audit of ``documents``, for up to fanout ** inner rows of a source and fanout ** outer sources: one level after another."""
    def value(x: str) -> str:
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE octet_length(encode(CAST({x} AS VARCHAR))) || ':' || CAST({x} AS VARCHAR) END"

    def leaf_sql(text: str) -> str:
        return "sha256(" + " || ".join(value(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    crc = (f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), lambda a, e: xor(xor(a, e) >> 1, "
           "CASE WHEN xor(a, e) % 2 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)")
    lines = [f"""d AS (SELECT doc_id, source, {leaf_sql('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf_sql(lower)} ELSE {leaf_sql('text')} END AS claim,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos FROM documents)""",
             "n0 AS (SELECT source AS tree, pos, leaf AS h, count(*) OVER (PARTITION BY source) AS c FROM d)",
             "f0 AS (SELECT doc_id, source AS tree, pos, claim AS h, '' AS others FROM d)"]

    def level(k: int, nodes: str, state: str) -> None:
        # all nodes of a level and the next one; a tree with one node left stays as it is
        lines.append(f"""n{k + 1} AS (SELECT tree, pos, h, count(*) OVER (PARTITION BY tree) AS c FROM (
  SELECT tree, pos // {fanout} AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h FROM {nodes} WHERE c > 1 GROUP BY tree, pos // {fanout}
  UNION ALL SELECT tree, pos, h FROM {nodes} WHERE c = 1))""")
        lines.append(f"""f{k + 1} AS (SELECT s.doc_id, s.tree, CASE WHEN any_value(n.c) > 1 THEN s.pos // {fanout} ELSE s.pos END AS pos,
  CASE WHEN any_value(n.c) > 1 THEN sha256(string_agg(CASE WHEN n.pos = s.pos THEN s.h ELSE n.h END, '' ORDER BY n.pos)) ELSE s.h END AS h,
  s.others || coalesce(string_agg(CASE WHEN n.pos <> s.pos THEN n.h END, '' ORDER BY n.pos), '') AS others
  FROM {state} s JOIN {nodes} n ON s.tree IS NOT DISTINCT FROM n.tree AND s.pos // {fanout} = n.pos // {fanout}
  GROUP BY s.doc_id, s.tree, s.pos, s.h, s.others)""")

    for k in range(inner):
        level(k, f"n{k}", f"f{k}")
    base = inner + 1  # the trees' roots as leaves of one tree
    lines.append(f"sub AS (SELECT tree AS source, h, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos FROM n{inner})")
    lines.append(f"n{base} AS (SELECT '' AS tree, pos, h, count(*) OVER () AS c FROM sub)")
    lines.append(f"f{base} AS (SELECT f.doc_id, '' AS tree, s.pos, f.h, f.others FROM f{inner} f JOIN sub s ON f.tree IS NOT DISTINCT FROM s.source)")
    for k in range(base, base + outer):
        level(k, f"n{k}", f"f{k}")
    return "WITH " + ",\n".join(lines) + f"""
SELECT d.doc_id, d.leaf, s.h AS subroot, r.h AS root, sha256(f.others) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM d JOIN sub s ON d.source IS NOT DISTINCT FROM s.source JOIN f{base + outer} f USING (doc_id), n{base + outer} r
"""


ORACLE = _oracle()
