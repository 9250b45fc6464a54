import hashlib
import random
import re

import pytest

from pageloom.llm.exact_dedup import Params, decide, exact_duplicates, ingest, retained
from pageloom.session import scratch

GAPS = re.compile(r"[\x20\x09-\x0D]")


def plain(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(GAPS.sub("", t or ""), []).append((-len(t or ""), i is None, i))
    out = set()
    for i, t in docs:
        body = GAPS.sub("", t or "")
        best = min(groups[body])
        out.add((i, best[2], len(groups[body]), i == best[2], hashlib.sha256(body.encode()).hexdigest()))
    return out


def rows(df):
    return {(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


@pytest.fixture
def stored(spark, documents):
    """Path of a table of (doc_id, text) pairs in several files."""

    def write(pairs, files=3, change=lambda df: df):
        path = scratch(spark, "exact-test")
        change(documents(pairs)).repartition(files).write.parquet(path)
        return path

    return write


@pytest.fixture
def texts(prose):
    r = random.Random(4)
    some = [prose(k, r.randrange(1, 30)) for k in range(40)]
    out = [(k, r.choice([" ", "\n\t", "\x0b\x0c\r", " "]).join(r.choice(some).split())) for k in range(300)]
    return out + [(400, None), (401, ""), (402, " \n"), (403, "é" * 9), (404, "é " * 9), (405, "x" * 300_000), (406, "x" * 300_000 + " ")]


@pytest.mark.parametrize("p", [Params(), Params(digest_bytes=1), Params(batch_bytes=1)], ids=["production", "digests collide", "many batches"])
def test_same_as_grouping_by_text(spark, stored, texts, p):
    assert rows(exact_duplicates(spark, stored(texts), p)) == plain(texts)


def test_state_goes_on_with_new_files(spark, stored, documents, texts):
    path, checkpoint = stored(texts[:100]), scratch(spark, "exact-test-state")
    ingest(spark, path, checkpoint)
    first = retained(spark, checkpoint).count()
    documents(texts[100:]).write.mode("append").parquet(path)
    ingest(spark, path, checkpoint)
    ingest(spark, path, checkpoint)  # nothing new: counts stay
    assert first < retained(spark, checkpoint).count()
    assert rows(decide(spark, path, checkpoint)) == plain(texts)


def test_odd_rows(spark, stored, clashing):
    texts = [(1, "a b"), (1, "a b"), (1, "other"), (None, "a b"), (None, "alone"), (2, "ab"), (3, None)]
    got = exact_duplicates(spark, stored(texts, change=clashing)).collect()
    assert len(got) == 7 and sum(r.kept for r in got) == 4
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(1, 1, 4), (1, 1, 1), (None, 1, 4), (None, None, 1), (2, 1, 4), (3, 3, 1)}


def test_empty_tables(spark, stored, documents):
    assert exact_duplicates(spark, stored([], 1)).count() == 0
    path = scratch(spark, "exact-none")
    documents([]).write.partitionBy("source").parquet(path)
    checkpoint = scratch(spark, "exact-test-state")
    assert retained(spark, checkpoint).count() == 0


def test_no_python_in_the_plan(spark, stored):
    plan = exact_duplicates(spark, stored([(1, "a b"), (2, "ab")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
