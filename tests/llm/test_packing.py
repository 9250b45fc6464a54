import zlib
from array import array
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pageloom.llm.packing import Capacity, best_fit, pack, pack_documents, token_pieces


def plain_ids(text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return t.encode(text or "", add_special_tokens=False).ids + [2]


TEXTS = [None, "", "a", "ein Häuschen\n\n\n  mit   Lücken\t", "x <|endoftext|> y", "word " * 700, "😀 é" * 50, "b" * 3000, "a", "a"]


def test_pieces_are_the_tokenizers_ids(documents):
    got = {}
    for r in token_pieces(documents(enumerate(TEXTS)), 64).collect():
        got.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for i, text in enumerate(TEXTS):
        ids, at = plain_ids(text), 0
        for piece, start, length, crc in sorted(got[i]):
            assert start == at and 0 < length <= 64 and (piece == 0 or length == 64)
            assert crc == zlib.crc32(array("I", ids[start:start + length]).tobytes())
            at += length
        assert at == len(ids)
        assert len(ids) > 64 or len(got[i]) == 1


def check(rows, limit=1024):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= limit
    return bins


def test_packing_is_gapless_and_tight(documents, prose):
    docs = documents([(k, prose(k, 20 + 97 * k % 900)) for k in range(120)])
    rows = pack_documents(docs, Capacity(512)).collect()
    bins = check(rows, 512)
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // 512) * 1.04 + 1


def test_empty_table_and_repeated_rows(documents):
    assert pack_documents(documents([])).count() == 0
    rows = pack_documents(documents([(1, "same"), (1, "same"), (None, "same"), (None, None)])).collect()
    assert len(rows) == 4
    check(rows)


@pytest.mark.parametrize("rule", ["residual", "dot"])
def test_every_limit_holds(rule):
    histogram = {7: 11, 5: 20, 4: 9, 3: 40, 2: 33, 1: 50}
    plan = best_fit(histogram, Capacity(16, documents=4, attention=90, rule=rule))
    used = defaultdict(int)
    for count, content in plan:
        assert sum(n * k for n, k in content) <= 16 and sum(k for _, k in content) <= 4
        assert sum(n * n * k for n, k in content) <= 90
        for n, k in content:
            used[n] += count * k
    assert dict(used) == histogram
    with pytest.raises(ValueError):
        best_fit({20: 1}, Capacity(16))


def test_a_hot_length_is_spread(spark):
    pieces = spark.range(20000).selectExpr("id as doc_id", "0 as piece", "0L as start", "if(id % 3 = 0, id % 900 + 1, 300L) as length", "id as ids_crc32")
    rows = pack(pieces, Capacity(1024)).collect()
    assert len(rows) == 20000
    check(rows)
