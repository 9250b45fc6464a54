"""Near-duplicates by MinHash: universal hash minima, banding, signature check, exact check, connected components.

* Documents with equal shingle sets are one class; only its representative goes on, so thousands of copies cost one row.
* A representative has one bucket per band. In each bucket all members are compared with the smallest one only (a star). Links are
  first judged by one bit of each minimum (a fixed 32 bytes per document), then on the full shingle sets.
* Components of the confirmed links come from alternating large-star and small-star rounds.
* What a star left in different components is compared in blocks: representatives that met the same smallest member make blocks of
  a bounded number of shingles, and blocks that share such a bucket are compared as a whole, first by signatures and, if any pair may
  reach the limit, on the full sets. So no pair of a bucket whose link could change the result goes unchecked, a crowd of copies that
  all lie just below the limit costs rows by blocks and not by pairs, and only links are returned.

No step gathers a bucket, class or component in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, cut, text_key

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RNG = np.random.default_rng(20240611)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


@dataclass(frozen=True)
class Params:
    shingle: int = 5  # words
    percent: int = 75  # 100 * intersection >= percent * union
    bands: int = 48
    rows: int = 6  # minima per band: 0.75 ** 6 a band, so a link at the limit is missed with probability 8e-5
    floor: float = 0.5  # least similarity by the 256 signature bits to go on to the exact check; the limit lies 6 deviations above
    block_floor: float = 0.6  # the same by all minima, again 6 deviations
    block: int = 20_000  # shingles of a block, more only if a single text has more


def shingles(text: memoryview | None, size: int) -> np.ndarray:
    """Distinct 64-bit hashes of the word windows of a whole text, ascending."""
    words = bytes(text).translate(_LOWER).split() if text else []  # bytes are split at space and \x09-\x0D, no other
    if not words:
        return np.zeros(0, np.uint64)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    hashes = _word_hashes(list(number))[ids]
    n = min(size, len(words))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = (h ^ hashes[k:k + len(h)]) * _MIX
        h ^= h >> np.uint64(32)
    return np.unique(h)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def signature(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima over the set of the hashes (a * x + b) mod 2**64, upper 32 bits."""
    out = np.full(len(a), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(found), 256):  # a table of 256 rows stays in the processor's cache; memory does not follow the text
        hashes = found[at:at + 256, None] * a
        hashes += b
        np.minimum(out, hashes.min(axis=0), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def sketch(text: str, p: Params) -> Column:
    """struct(n_shingles, digest, bands, bits, signature) of each whole text: set size, 128-bit digest of the set (null if empty), one
    hash per band, a bit of each of 256 minima, and a byte of each minimum."""
    count = max(p.bands * p.rows, 256)
    a = _RNG_PARAMS[0][:count]
    b = _RNG_PARAMS[1][:count]

    @F.arrow_udf("struct<n_shingles:long,digest:binary,bands:array<long>,bits:array<long>,signature:binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import xxhash

        for batch in batches:
            rows = []
            for block in blocks(batch):
                for t in block:
                    found = shingles(t, p.shingle)
                    if not len(found):
                        rows.append((0, None, [], [], None))
                        continue
                    least = signature(found, a, b)
                    banded = least[:p.bands * p.rows].reshape(p.bands, p.rows)
                    keys = [xxhash.xxh3_64_intdigest(row.tobytes(), seed=k) >> 1 for k, row in enumerate(banded)]
                    mixed = _spread(least)
                    bits = np.packbits(mixed[:256] & 1).view(np.int64).tolist()
                    rows.append((len(found), xxhash.xxh3_128_digest(found.tobytes()), keys, bits, mixed.tobytes()))
            names = ("n_shingles", "digest", "bands", "bits", "signature")
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            yield pa.StructArray.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(5)], list(names))

    return run(F.col(text))


_RNG_PARAMS = (_RNG.integers(0, 2**64, 4096, dtype=np.uint64) | np.uint64(1), _RNG.integers(0, 2**64, 4096, dtype=np.uint64))


def _spread(minima: np.ndarray) -> np.ndarray:
    """A byte of each minimum. Minima are small numbers for big sets, so they are mixed first: unequal ones agree by chance only."""
    x = minima.astype(np.uint32)
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return ((x ^ (x >> np.uint32(16))) & np.uint32(255)).astype(np.uint8)


def similar(left: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """Of the candidate pairs (a, b) those whose full shingle sets reach the limit.

    ``texts``: (id, text) of the representatives. Only texts of a candidate are moved; a set is hashed in the task that compares.
    """
    limit = p.percent

    @F.arrow_udf("boolean")
    def close(one: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for x, y in one:
            out, held = [], (None, None)
            flat_x = (t for block in blocks(x) for t in block)
            flat_y = (t for block in blocks(y) for t in block)
            for s, t in zip(flat_x, flat_y):
                if held[0] is None or held[0] != s:
                    held = (s, shingles(s, p.shingle))
                mine, other = held[1], shingles(t, p.shingle)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                out.append(bool(both) and 100 * both >= limit * (len(mine) + len(other) - both))
            yield pa.array(out, pa.bool_())

    a = texts.select(F.col("id").alias("a"), F.col("text").alias("_s"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("_t"))
    return left.join(b, "b").join(a, "a").filter(close("_s", "_t")).select("a", "b")


def likely(pairs: DataFrame, marks: DataFrame, p: Params) -> DataFrame:
    """Candidate pairs whose set sizes and signature bits allow the limit. Bits of equal minima agree, of others in half the cases."""
    bit = lambda k: F.bit_count(F.get("_x", F.lit(k)).bitwiseXOR(F.get("_y", F.lit(k))))
    differ = bit(0) + bit(1) + bit(2) + bit(3)
    x = marks.select(F.col("id").alias("a"), F.col("bits").alias("_x"), F.col("n_shingles").alias("_m"))
    y = marks.select(F.col("id").alias("b"), F.col("bits").alias("_y"), F.col("n_shingles").alias("_n"))
    sized = F.least("_m", "_n") * 100 >= F.greatest("_m", "_n") * p.percent
    return pairs.join(x, "a").join(y, "b").filter(sized & (differ <= int(128 * (1 - p.floor)))).select("a", "b")


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in a link. Alternating large-star and small-star.

    The tables of a round are written: their sizes are then known, so that small ones are joined without a shuffle. A node with very many
    neighbours is not gathered: its smallest neighbour is an aggregate and the edges are joined with it.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(F.col("u") != F.col("v")), "cc-0")
    for k in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = cut(both.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high")), f"cc-near-{k}")
        # stars around their smallest node: whoever has a smaller neighbour has no other one
        if near.filter((F.col("low") < F.col("u")) & (F.col("low") < F.col("high"))).isEmpty():
            return near.select(F.col("u").alias("id"), F.least("low", "u").alias("component"))
        # large star: neighbours above u hang on u's smallest neighbour
        least = near.select("u", F.least("low", "u").alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large, f"cc-large-{k}")
        # small star: u and its neighbours below hang on the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v")).distinct()
        edges = cut(small, f"cc-small-{k}")
    raise RuntimeError("components did not settle")


def classes(docs: DataFrame, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """(rows, members): every row with its set size and digest; and one row for each digest, with its smallest doc_id as ``id``."""
    rows = docs.select("doc_id", text_key("text").alias("key"), sketch("text", p).alias("k")).select("doc_id", "key", "k.*")
    rows = cut(rows, "minhash-rows")
    named = rows.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    # bands and bits follow from the set alone, so those of any row of the class do
    first = F.min_by(F.struct("doc_id", "key", "n_shingles", "bands", "bits", "signature"), F.struct("doc_id", "key"))
    firsts = named.groupBy("digest").agg(first.alias("f")).select("digest", F.col("f.doc_id").alias("id"), *(f"f.{c}" for c in ("key", "n_shingles", "bands", "bits", "signature")))
    return rows, cut(firsts.withColumn("rep", F.monotonically_increasing_id()), "minhash-reps")


def near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, key, n_shingles, component, component_id, kept) for every row of ``docs`` (doc_id, text).

    component_id: smallest doc_id reachable over links; the row's own if its text has no word. A null doc_id takes part in nothing
    and has a null component. Rows that share a doc_id belong to one component only by their texts; each is judged by its own.
    ``key`` tells such rows apart, and ``component`` (any number; null where a row takes no part) tells components apart that share
    their smallest doc_id. Of repeated rows with the smallest id all have doc_id = component_id.
    """
    rows, reps = classes(docs, p)
    marks = reps.select(F.col("rep").alias("id"), "bits", "n_shingles")
    spread = reps.select(F.col("rep").alias("id"), F.posexplode("bands").alias("band", "bucket"))
    sizes = spread.groupBy("band", "bucket").agg(F.count("*").alias("n"), F.min("id").alias("least")).filter(F.col("n") > 1)
    shared = cut(spread.join(cut(sizes, "minhash-buckets"), ["band", "bucket"]), "minhash-members")
    texts = cut(_texts(docs, reps, shared), "minhash-texts")

    stars = shared.filter(F.col("id") != F.col("least")).select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    links = cut(similar(likely(stars, marks, p), texts, p), "minhash-links")
    settled = components(links)

    # what is found in blocks links components as a whole, so only these are settled again
    more = cut(_blockwise(shared, settled, reps, texts, p), "minhash-more")
    rooted = reps.select("digest", F.col("rep").alias("id"), F.col("id").alias("first")).join(settled, "id", "left")
    rooted = rooted.withColumn("component", F.coalesce("component", "id"))
    if not more.isEmpty():
        merged = components(more).toDF("component", "_merged")
        rooted = rooted.join(merged, "component", "left").withColumn("component", F.coalesce("_merged", "component")).drop("_merged")
    rooted = cut(rooted, "minhash-rooted")
    # written, so that the join sees its size and can split a component that has very many members
    smallest = cut(rooted.groupBy("component").agg(F.min("first").alias("component_id")), "minhash-smallest")
    named = rooted.join(smallest, "component").select("digest", "component", "component_id")
    return (rows.withColumn("digest", F.when(F.col("doc_id").isNotNull(), F.col("digest"))).join(named, "digest", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
            .select("doc_id", "key", "n_shingles", "component", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def _blockwise(shared: DataFrame, settled: DataFrame, reps: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """Pairs (a, b) of components linked by members of a bucket that the stars left apart; one for two components of a block pair.

    Small tables that are met more than once are written, so that they are joined without a shuffle.
    """
    placed = shared.join(settled, "id", "left").withColumn("component", F.coalesce("component", "id"))
    by_part = placed.groupBy("band", "bucket", "component").agg(F.count("*").alias("c"))
    largest = (by_part.groupBy("band", "bucket").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("c", "component")).alias("major"))
               .filter(F.col("parts") > 1).drop("parts"))
    left = cut(placed.join(cut(largest, "minhash-major"), ["band", "bucket"]).select("band", "bucket", "id", "component", "major", "least"), "minhash-open")

    # those that met the same smallest member go together, split by hash where they are many
    met = cut(left.groupBy("id").agg(F.min("least").alias("anchor"), F.max("component").alias("component")), "minhash-met")
    met = met.join(reps.select(F.col("rep").alias("id"), "n_shingles", "signature"), "id")
    sizes = cut(met.groupBy("anchor").agg(F.ceil(F.sum("n_shingles") / p.block).alias("splits")), "minhash-splits")
    block = F.xxhash64("anchor", F.pmod(F.xxhash64("id"), F.col("splits")))
    blocked = cut(met.join(sizes, "anchor").select("id", "component", "signature", block.alias("block")), "minhash-blocks")

    touched = cut(left.join(blocked.select("id", "block"), "id").groupBy("band", "bucket", "block")
                  .agg(F.max(F.col("component") != F.col("major")).alias("minor")), "minhash-touched")
    one = touched.select("band", "bucket", F.col("block").alias("x"), F.col("minor").alias("mx"))
    two = touched.select("band", "bucket", F.col("block").alias("y"), F.col("minor").alias("my"))
    meet = (one.join(two, ["band", "bucket"]).filter((F.col("x") <= F.col("y")) & (F.col("mx") | F.col("my"))).select("x", "y").distinct())

    marks = cut(blocked.groupBy("block").agg(F.collect_list(F.struct("component", "signature")).alias("c")), "minhash-block-marks")
    maybe = cut(_block_pairs(meet, marks).filter(_any_likely(p)("cx", "cy")).select("x", "y"), "minhash-likely-blocks")
    used = maybe.select(F.col("x").alias("block")).union(maybe.select("y")).distinct()
    sets = (blocked.drop("signature").join(used, "block", "left_semi").join(texts, "id").withColumn("s", _packed_set(p)("text"))
            .groupBy("block").agg(F.collect_list(F.struct("component", "s")).alias("c")))
    return _block_pairs(maybe, cut(sets, "minhash-block-sets")).select(F.explode(_block_links(p)("cx", "cy")).alias("l")).select("l.a", "l.b")


def _block_pairs(pairs: DataFrame, content: DataFrame) -> DataFrame:
    return (pairs.join(content.select(F.col("block").alias("x"), F.col("c").alias("cx")), "x")
            .join(content.select(F.col("block").alias("y"), F.col("c").alias("cy")), "y"))


def _packed_set(p: Params):
    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([shingles(t, p.shingle).tobytes() for block in blocks(batch) for t in block], pa.binary())

    return run


def _any_likely(p: Params):
    @F.arrow_udf("boolean")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            out = []
            for x, y in zip(left, right):
                x, y = x.as_py(), y.as_py()
                apart = np.array([r["component"] for r in x])[:, None] != np.array([r["component"] for r in y])[None, :]
                a, b = (np.frombuffer(b"".join(r["signature"] for r in z), np.uint8).reshape(len(z), -1) for z in (x, y))
                out.append(any(bool((((row == b).mean(axis=1) >= p.block_floor) & apart[k]).any()) for k, row in enumerate(a) if apart[k].any()))
            yield pa.array(out, pa.bool_())

    return run


def _block_links(p: Params):
    @F.arrow_udf("array<struct<a:long,b:long>>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for left, right in batches:
            yield pa.array([_links_between(x.as_py(), y.as_py(), p.percent) for x, y in zip(left, right)], kind)

    return run


def _links_between(x: list[dict], y: list[dict], percent: int) -> list[tuple[int, int]]:
    """Components linked by an exact comparison of two blocks: sizes of all intersections as a product of membership matrices over the shared shingles."""
    sets = [[np.frombuffer(r["s"], np.uint64) for r in z] for z in (x, y)]
    sizes = [np.array([len(s) for s in z], np.int64) for z in sets]
    flat = [np.concatenate(z) for z in sets]
    common = np.intersect1d(flat[0], flat[1])
    members = []
    for values, n in zip(flat, sizes):
        at = np.minimum(np.searchsorted(common, values), max(len(common) - 1, 0))
        known = common[at] == values if len(common) else np.zeros(len(values), bool)
        matrix = np.zeros((len(n), len(common)), np.float32)
        matrix[np.repeat(np.arange(len(n)), n)[known], at[known]] = 1
        members.append(matrix)
    both = (members[0] @ members[1].T).round().astype(np.int64)
    found = (both > 0) & (100 * both >= percent * (sizes[0][:, None] + sizes[1][None, :] - both))
    pairs = {tuple(sorted((x[i]["component"], y[j]["component"]))) for i, j in zip(*np.nonzero(found))}
    return sorted((a, b) for a, b in pairs if a != b)


def _texts(docs: DataFrame, reps: DataFrame, shared: DataFrame) -> DataFrame:
    """(id, text) of the representatives that share a bucket."""
    wanted = reps.select(F.col("rep").alias("id"), F.col("id").alias("doc_id"), "key").join(shared.select("id"), "id", "left_semi")
    return docs.select("doc_id", "text", text_key("text").alias("key")).join(wanted, ["doc_id", "key"]).select("id", "text").dropDuplicates(["id"])
