import random

import pytest

import corpus_pipeline
from pageloom.llm.line_runs import Params, remove_copies, repeated_runs


def plain(pairs, least):
    """Kept text of each (doc_id, text): lines in a window of ``least`` lines that stood earlier go."""
    seen, out = set(), {}
    for i, t in sorted(set(pairs)):
        lines = t.split("\n")
        gone = set()
        for k in range(len(lines) - least + 1):
            window = tuple(lines[k:k + least])
            if window in seen:
                gone.update(range(k, k + least))
            seen.add(window)
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_same_as_windows_of_lines(documents, least):
    r = random.Random(least)
    pairs = [(i, "\n".join(f"line {r.randrange(25) if r.random() < 0.6 else r.randrange(10**6)}" for _ in range(r.randrange(1, 40)))) for i in range(60)]
    pairs += [(100 + i, pairs[i][1]) for i in range(10)] + [(200, "\n".join(["again"] * 70)), (201, "\n".join(["again"] * 33)), (202, "")]
    got = {x.doc_id: x.text for x in remove_copies(documents(pairs), Params(min_lines=least)).collect()}
    assert got == plain(pairs, least)


def test_runs_are_maximal(documents):
    text = "\n".join("abcdefgh")
    rows = repeated_runs(documents([(1, text), (2, "x\n" + text + "\ny"), (3, "b\nc\nd\nq\nf\ng")])).collect()
    assert {(r.doc_id, tuple(tuple(x) for x in r.runs)) for r in rows} == {(2, ((1, 8),)), (3, ((0, 2), (4, 5)))}


def test_odd_rows(documents, clashing):
    pairs = [(1, "a\nb"), (1, "a\nb"), (1, "a\nb\nc"), (2, "a\nb"), (3, None), (4, ""), (None, "p\nq"), (5, "p\nq"), (6, "\n\n\n\n"), (7, "x" * 100_000)]
    got = [(r.doc_id, r.text, r.n_lines) for r in remove_copies(clashing(documents(pairs))).collect()]
    by = {}
    for i, t, n in got:
        by.setdefault(i, []).append((t, n))
    assert len(got) == len(pairs)
    assert by[2] == [("", 2)] and by[3] == [(None, 0)] and by[4] == [("", 1)] and by[None] == [("p\nq", 2)] and by[5] == [("", 2)]
    assert by[6][0][1] == 5 and by[7][0][0] == "x" * 100_000
    assert sorted(t for t, _ in by[1]) in (["", "", "a\nb\nc"], ["a\nb", "a\nb", "c"])
    assert remove_copies(documents([])).count() == 0


def test_no_python_in_the_plan(documents):
    plan = remove_copies(documents([(1, "a\nb"), (2, "a\nb")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def words_plain(pairs, least, words):
    """As ``plain``, and windows of fewer lines go if they have ``words`` words."""
    seen, out = set(), {}
    for i, t in sorted(set(pairs)):
        lines = t.split("\n")
        gone = set()
        for n in range(1, least + 1):
            for k in range(len(lines) - n + 1):
                window = tuple(lines[k:k + n])
                if window in seen and (n == least or sum(len(x.split()) for x in window) >= words):
                    gone.update(range(k, k + n))
                seen.add(window)
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_short_runs_of_many_words(documents, least):
    r = random.Random(least)
    pairs = [(i, "\n".join("w " * r.randrange(1, 9) + str(r.randrange(30)) for _ in range(r.randrange(1, 30)))) for i in range(60)]
    got = {x.doc_id: x.text for x in remove_copies(documents(pairs), Params(min_lines=least, min_words=8)).collect()}
    assert got == words_plain(pairs, least, 8)


def test_one_line_passage_between_different_lines(spark, documents, prose, tmp_path):
    passage, short = prose(1, 50), prose(2, 49)
    docs = documents([(1, f"a\n{passage}\nb\n{short}\nc"), (2, f"d\n{passage}\ne\n{short}\nf"), (3, passage), (4, prose(3, 60))])
    got = {x.doc_id: x.text for x in corpus_pipeline.line_dedup(spark, docs, str(tmp_path)).collect()}
    assert got == {1: f"a\n{passage}\nb\n{short}\nc", 2: f"d\ne\n{short}\nf", 4: prose(3, 60)}
