import itertools
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from pageloom.llm.language import Lattice, Params, expected, fit, forward, identify, train, vocabulary, words_of

PIECES = [b"a", b"b", b"ab", b"ba", b"aba", b" ", b" a", b" ab", b"c", b"bc", b"abc"]


def all_cuts(word, pieces):
    """Every way to cut a word into pieces."""
    if not word:
        yield ()
    for k in range(1, len(word) + 1):
        if word[:k] in pieces:
            for rest in all_cuts(word[k:], pieces):
                yield (word[:k], *rest)


def test_forward_and_expected_counts_sum_over_all_segmentations():
    prob = np.random.default_rng(1).dirichlet(np.ones(len(PIECES)), 2).T
    at = {p: k for k, p in enumerate(PIECES)}
    words = [bytes([32, *w]) for n in range(1, 6) for w in itertools.product(b"abc", repeat=n)]
    lattice = Lattice(PIECES)
    logs = forward(lattice, prob, words)[0]
    for k in random.Random(1).sample(range(len(words)), 60):
        for lang in (0, 1):
            ways = [np.prod([prob[at[p], lang] for p in cut]) for cut in all_cuts(words[k], at)]
            assert abs(logs[k, lang] - np.log(sum(ways))) < 1e-9
    n = np.ones((len(words), 2))
    got, want = expected(lattice, prob, words, n), np.zeros_like(prob)
    for w in words:
        for lang in (0, 1):
            cuts = [(c, np.prod([prob[at[p], lang] for p in c])) for c in all_cuts(w, at)]
            whole = sum(x for _, x in cuts)
            for c, x in cuts:
                for p in c:
                    want[at[p], lang] += x / whole
    assert np.allclose(got, want)


def test_long_words_do_not_underflow():
    prob = np.full((len(PIECES), 1), 1e-9)
    logs = forward(Lattice(PIECES), prob, [b" " + b"ab" * 90])[0]
    assert np.isfinite(logs).all() and logs[0, 0] < -900


def test_vocabulary_reaches_every_string():
    pieces = set(vocabulary("piece_bpe_32k.model"))
    assert all(bytes([b]) in pieces for b in range(256))


def test_words():
    assert words_of("Ab, cd2É_f ½", 50) == [b" ab", b" cd", " é".encode(), b" f"]
    assert words_of("123 -- ½", 50) == []
    assert b"".join(words_of("x" * 500, 64))[1:] == b"x" * 500


SYLLABLES = {"aa": ["the", "ing", "and", "her", "ou"], "bb": ["sch", "ein", "ung", "der", "ü"], "cc": ["ción", "que", "los", "ñ", "ar"]}


def sentence(lang, seed, n=12):
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randrange(1, 4))) for _ in range(n))


def test_held_out_texts_and_odd_rows(spark, clashing):
    rows = [(k, sentence(lang, k), lang) for k in range(240) for lang in [list(SYLLABLES)[k % 3]]]
    odd = [(900, None, "aa"), (901, "", "aa"), (902, "12 34 !!", None), (903, "½ ²", "bb"), (904, "the " * 30_000, None), (None, sentence("bb", 5), "bb"), (7, sentence("aa", 1), "aa"), (7, sentence("aa", 1), "aa"), (905, "日本語", None)]
    docs = clashing(spark.createDataFrame(rows + odd, "doc_id long, text string, lang string"))
    model = fit(docs, F.coalesce(F.col("doc_id") % 4 != 2, F.lit(False)), Params(per_language=40))
    assert model.languages == ["aa", "bb", "cc"]
    got = docs.select("doc_id", "lang", identify(model, "text").alias("l")).select("doc_id", "lang", "l.*").collect()
    assert len(got) == len(rows) + len(odd)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 240 and r.doc_id % 4 == 2]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    by = {r.doc_id: r for r in got}
    assert all((by[k].lang_pred, by[k].score) == ("und", 0.0) for k in (900, 901, 902, 903))
    assert by[904].lang_pred == "aa" and by[None].lang_pred == "bb" and by[905].lang_pred in model.languages
    assert all(0 <= r.score <= 1 for r in got)


def unspaced(first, last, seed, n):
    """A text of one long word from a range of letters, of which some are frequent."""
    r = random.Random(seed)
    letters = [chr(c) for c in range(first, last) if chr(c).isalpha()]
    return "".join(letters[int(len(letters) * r.random() ** 3)] for _ in range(n))


SCRIPTS = {"zh": (0x4E00, 0x5200), "ja": (0x3041, 0x3097), "ko": (0xAC00, 0xB000), "th": (0x0E01, 0x0E2F)}


def test_scripts_without_spaces(spark):
    """Words of any length are learned, also such that no table of plain probabilities could hold."""
    rows = [(k, unspaced(*SCRIPTS[x], k, 5 + k % 140), x) for k in range(400) for x in [list(SCRIPTS)[k % 4]]]
    rows += [(1000 + k, sentence("aa", k), "aa") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit(docs, F.col("doc_id") % 5 != 2, Params(per_language=60))
    assert np.isfinite(model.prob).all()
    held = docs.filter("doc_id % 5 = 2").select("lang", identify(model, "text").alias("l")).collect()
    for x in (*SCRIPTS, "aa"):
        assert np.mean([r.l.lang_pred == x for r in held if r.lang == x]) > 0.95, x


def test_two_mixtures_of_one_script(spark):
    """The same letters with different frequencies, in words of 15."""
    def text(k, x):
        r = random.Random(k)
        return "。".join("".join(chr(0x4E00 + int(300 * (r.random() ** 3 if x == "u" else 1 - r.random() ** 3))) for _ in range(15)) for _ in range(4))

    docs = spark.createDataFrame([(k, text(k, "uv"[k % 2]), "uv"[k % 2]) for k in range(300)], "doc_id long, text string, lang string")
    model = fit(docs, F.col("doc_id") % 3 != 2, Params(per_language=60))
    held = docs.filter("doc_id % 3 = 2").select("lang", identify(model, "text").alias("l")).collect()
    assert np.mean([r.l.lang_pred == r.lang for r in held]) > 0.95


def test_expected_counts_of_words_that_underflow():
    """A word with probability 1e-900: as many pieces are expected as it must have, language by language."""
    prob = np.full((len(PIECES), 2), 1e-9)
    prob[PIECES.index(b"a"), 1] = 1e-3
    word = b" " + b"cb" * 60
    total = expected(Lattice(PIECES), prob, [word], np.ones((1, 2)))
    size = np.array([len(p) for p in PIECES], float)
    assert np.isfinite(total).all() and np.allclose(total.T @ size, len(word))


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = fit(docs, F.lit(True))
    assert docs.select(identify(model, "text").alias("l")).first().l.lang_pred == "und"
    assert train({"aa": Counter()}).languages == ["aa"]
    assert docs.limit(0).select(identify(model, "text")).count() == 0
