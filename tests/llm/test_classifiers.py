import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.llm import ngrams, quality_embed, quality_rules, toxicity
from pageloom.llm.common import fold
from pageloom.llm.linear import train
from pageloom.llm.ngrams import Hasher
from pageloom.llm.samples import Example

BITS = 18


@pytest.fixture
def corpus(spark, documents, prose):
    """Good prose and junk with labels; junk repeats words or is full of symbols."""
    r = random.Random(2)
    pairs, labels = [], []
    for k in range(300):
        good = k % 3 > 0
        text = prose(k, 60) if good else " ".join(f"{w}!! ###" for w in prose(k, 60).split()) if k % 2 else " ".join([prose(k, 1)] * 70)
        pairs.append((k, text))
        labels.append((k, int(good), int(r.random() < 0.3)))
    return documents(pairs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(docs, labels, score, label):
    rows = docs.select("doc_id", score.alias("s")).join(labels, "doc_id").filter(fold("doc_id", 5) == 0).collect()
    return np.mean([(r.s >= 0.5) == (r[label] == 1) for r in rows])


def test_embeddings_on_held_out_rows(corpus):
    docs, labels = corpus
    model = quality_embed.fit(docs, labels, fold("doc_id", 5) != 0, quality_embed.Params(bits=BITS))
    assert accuracy(docs, labels, quality_embed.score(model, "text"), "quality") > 0.95
    # the folded table gives the scores of the full model
    text = docs.first().text
    ids, n = model.hasher.counts(memoryview(text.encode()))
    hidden = (n / n.sum()) @ model.vectors[ids]
    logits = model.output @ hidden + model.bias
    full = np.exp(logits[1]) / np.exp(logits).sum()
    assert abs(docs.limit(1).select(quality_embed.score(model, "text")).first()[0] - full) < 1e-4


def test_rules_learn_and_calibrate(corpus):
    docs, labels = corpus
    model = quality_rules.fit(docs, labels, fold("doc_id", 5) != 0, quality_rules.Params(bits=BITS))
    rows = quality_rules.apply_rules(docs, model).join(labels, "doc_id").filter(fold("doc_id", 5) == 0).collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.95
    symbols = [r for r in rows if r.n_symbols and not r.base_failed]
    assert symbols and not any(r.kept for r in symbols)  # by the classifier alone


def slow_counts(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines, again, seen = (text or "").split("\n"), 0, set()
    for x in lines:
        if __import__("re").search(r"[^\x20\x09-\x0D]", x):
            again += x in seen
            seen.add(x)
    windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    hit = {j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(k, k + 3)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), again, len(hit)


def test_base_counts(documents, prose, clashing):
    texts = [None, "", " \n ", "a b c a b c", "x\nx\n \n \nx", "é ß ü #1 $2", "a " * 400, prose(1, 300) + "\n" + prose(1, 300), "<b>|</b>",
             "a a a a", "\x1c a\x85b  c", "z" * 50_000, "u\r\nu\r\n"]
    docs = clashing(documents(list(enumerate(texts))))
    model = train([], Hasher(BITS))
    got = {r.doc_id: r for r in quality_rules.apply_rules(docs, model).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = slow_counts(t)
        assert tuple(got[i][c] for c in quality_rules.COUNTS) == want, t
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert got[i].base_failed == failed and (not failed or not got[i].kept)


def test_long_texts_in_pieces_give_the_same_features(prose):
    h = Hasher(BITS)
    text = memoryview((prose(3, 400) + "\n" + "x" * 70 + " é").encode())
    whole, parts = h.counts(text), None
    from pageloom.llm import ngrams
    size, ngrams.PIECE = ngrams.PIECE, 500
    try:
        parts = h.counts(text)
        weight = np.random.default_rng(0).normal(size=1 << BITS).astype(np.float32)
        total, n = h.sums([text, None, memoryview(b"")], weight)
    finally:
        ngrams.PIECE = size
    assert (whole[0] == parts[0]).all() and abs(whole[1].sum() - parts[1].sum()) == 0
    assert n.tolist() == [whole[1].sum(), 0, 0] and abs(total[0] - weight[whole[0]] @ whole[1]) < 1e-2


def slow_features(h, text):
    """The features of one text by a plain loop over its words and characters: buckets with repeats."""
    def bucket(x, family):
        return int(h._bucket(np.array([x], np.uint32), family)[0])

    raw = bytes(32 if b in range(9, 14) else b + 32 if 65 <= b <= 90 else b for b in text.encode())
    words = raw.split()
    out = [bucket(sum(int(ngrams._BYTE[b]) * int(ngrams._PLACE[k & 63]) for k, b in enumerate(w)) & 0xFFFFFFFF, 1) for w in words]
    out += [h.repeat_mark for a, b in zip(words, words[1:]) if a == b]
    for w in words:
        full = b" " + w + b" "
        for size in h.sizes:
            for at in range(len(full) - size + 1):
                gram = full[at:at + size]
                value = int(ngrams._BYTE[gram[0]]) + sum(int(ngrams._BYTE[b]) * int(ngrams._PLACE[k]) for k, b in enumerate(gram[1:], 2))
                out.append(bucket(value & 0xFFFFFFFF, size))
    return Counter(out)


def test_scores_depend_on_the_text_alone(prose, monkeypatch):
    """Any batch gives each text the features of a plain loop and, to the last bit, the sums of the text alone."""
    monkeypatch.setattr(ngrams, "PIECE", 700)
    h, r = Hasher(BITS), random.Random(3)
    weight = np.random.default_rng(0).normal(size=1 << BITS).astype(np.float32)
    texts = ["bar baz", "foo bar", "bar", "bar bar", "", " ", "É é\tÉ", "Go go\ngo", *(prose(k, r.randrange(1, 60)) for k in range(30)),
             "again " * 600, prose(3, 400), "x" * 3000 + " y y", "ab" * 40 + " " + "ab" * 40]
    alone = {t: h.sums([memoryview(t.encode())], weight) for t in texts}
    for t in texts:
        want = slow_features(h, t)
        ids, n = h.counts(memoryview(t.encode()))
        assert dict(zip(ids.tolist(), n.tolist())) == want, t[:40]
        assert alone[t][1][0] == want.total() and abs(alone[t][0][0] - sum(float(weight[k]) * c for k, c in want.items())) < 1e-6 * (1 + want.total())
    for _ in range(5):
        r.shuffle(texts)
        total, n = h.sums([memoryview(t.encode()) for t in texts], weight)
        assert total.tolist() == [alone[t][0][0] for t in texts] and n.tolist() == [alone[t][1][0] for t in texts]


def test_scores_of_long_texts_in_any_batch(documents, prose):
    long = " ".join(prose(1, 400) for _ in range(450))  # beyond a block of 1 MB
    assert len(long) > 1 << 20
    model = train([Example(k % 2, *Hasher(BITS).counts(memoryview(prose(k, 40).encode()))) for k in range(40)], Hasher(BITS))
    pairs = [(k, prose(k, 20)) for k in range(20)] + [(50, long), (51, None), (52, "")]
    seen = {}
    for seed, parts in ((0, 1), (1, 3)):
        rows = pairs[:]
        random.Random(seed).shuffle(rows)
        for x in documents(rows).repartition(parts).select("doc_id", toxicity.score(model, "text").alias("s")).collect():
            assert seen.setdefault(x.doc_id, x.s) == x.s


def test_few_and_odd_labels(documents, spark, prose):
    docs = documents([(1, "a b"), (1, "a b"), (2, None), (None, "x"), (3, "")])
    for rows in ([], [(1, 1, 1)], [(None, 1, 0), (1, None, None), (9, 0, 0), (2, 0, 1), (2, 1, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        m = quality_embed.fit(docs, labels, F.lit(True), quality_embed.Params(bits=BITS))
        t = toxicity.fit(docs, labels, F.lit(True), toxicity.Params(bits=BITS))
        got = docs.select(quality_embed.score(m, "text").alias("q"), toxicity.score(t, "text").alias("t")).collect()
        assert len(got) == 5 and all(0 <= r.q <= 1 and 0 <= r.t <= 1 for r in got)
    assert docs.limit(0).select(quality_embed.score(m, "text")).count() == 0


def test_swapping_identity_terms(documents):
    docs = documents([(1, "Women met a Muslim near the womenfolk"), (2, None), (3, "nothing")])
    got = [r[0] for r in docs.orderBy("doc_id").select(toxicity.swapped(F.col("text"), (("women", "men"), ("muslim", "jewish", "hindu")))).collect()]
    assert got == ["men met a jewish near the womenfolk", None, "nothing"]


def test_counterfactual_penalty_frees_neutral_mentions(documents, spark, prose):
    """In the sample a group is named mostly in toxic texts; with the penalty its neutral mention is not held against it."""
    r = random.Random(8)
    pairs, labels = [], []
    for k in range(400):
        toxic = k % 2
        group = "muslims" if r.random() < (0.9 if toxic else 0.1) else "christians"
        insult = r.choice(["scumbags", "vermin", "filth"]) if toxic else "neighbours"
        pairs.append((k, f"{prose(k, 8)} {group} are {insult} {prose(k + 999, 8)}"))
        labels.append((k, 1, toxic))
    docs, labels = documents(pairs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    probe = documents([(k, f"{prose(5000 + k, 8)} {g} are neighbours {prose(6000 + k, 8)}") for k in range(20) for g in ("muslims", "christians")])
    gap = {}
    for pull in (0.0, 8.0):
        model = toxicity.fit(docs, labels, F.lit(True), toxicity.Params(bits=BITS, pull=pull))
        rows = probe.select("text", toxicity.score(model, "text").alias("s")).collect()
        means = [np.mean([x.s for x in rows if g in x.text]) for g in ("muslims", "christians")]
        gap[pull] = means[0] - means[1]
        hits = docs.select("doc_id", toxicity.score(model, "text").alias("s")).collect()
        assert np.mean([(x.s > 0.5) == (x.doc_id % 2 == 1) for x in hits]) > 0.95
    assert gap[8.0] < 0.5 * gap[0.0]


def test_without_rows_of_both_labels():
    one = [Example(1, np.array([3], np.int32), np.array([1.0], np.float32))] * 4
    assert 0.5 < 1 / (1 + np.exp(-train(one, Hasher(BITS)).bias)) < 1
