"""Quality rules: exact counts of words, symbols and repetition, and a calibrated n-gram logistic regression with fixed limits."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks
from .linear import Linear, calibrate, train
from .ngrams import Hasher
from .samples import examples, labelled

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = f"struct<{','.join(f'{c}:long' for c in COUNTS)},probability:double>"
_BLANK, _SYMBOL = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


@dataclass(frozen=True)
class Params:
    bits: int = 18
    sizes: tuple[int, ...] = (3, 4, 5)
    per_class: int = 1500  # labelled rows of each class that are used at most; a fifth of them calibrates
    min_words: int = 50
    max_repeat_percent: int = 50
    min_probability: float = 0.3


def counts(text: memoryview | None) -> tuple[int, ...]:
    """The five base counts of a whole text; a null text has no words."""
    if not text:
        return (0,) * 5
    raw = bytes(text)
    bytes_ = np.frombuffer(raw, np.uint8)
    words = raw.split()  # for bytes: at space and \x09-\x0D, no other
    chars = len(raw) - int(((bytes_ & 0xC0) == 0x80).sum()) - int(_BLANK[bytes_].sum())
    seen, again = set(), 0
    for line in raw.split(b"\n"):
        if line.strip():
            again += line in seen
            seen.add(line)
    return len(words), chars, int(_SYMBOL[bytes_].sum()), again, _repeated(words)


def _repeated(words: list[bytes]) -> int:
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    windows, back, n = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    twice = n[back] > 1
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k:k + len(twice)] |= twice
    return int(inside.sum())


def fit(docs: DataFrame, labels: DataFrame, learn: Column, p: Params = Params(), label: str = "quality") -> Linear:
    """Weights from four fifths of the sample, calibration from the rest."""
    hasher = Hasher(p.bits, p.sizes)
    found = examples(labelled(docs, labels, label, learn, p.per_class), hasher)
    held = [e for k, e in enumerate(found) if k % 5 == 4]
    return calibrate(train([e for k, e in enumerate(found) if k % 5 != 4], hasher), held)


def assess(model: Linear, text: str) -> Column:
    """Base counts and calibrated probability of good quality, as one struct; whole texts, in Arrow batches."""

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found, probability = [], []
            for block in blocks(batch):
                found += [counts(t) for t in block]
                probability.append(model.scores(block))
            cols = [pa.array([x[k] for x in found], pa.int64()) for k in range(5)]
            cols.append(pa.array(np.concatenate(probability) if probability else np.zeros(0)))
            yield pa.StructArray.from_arrays(cols, [*COUNTS, "probability"])

    return run(F.col(text))


def apply_rules(docs: DataFrame, model: Linear, p: Params = Params(), text: str = "text") -> DataFrame:
    """``docs`` plus the counts, probability, base_failed and kept (columns of these names are replaced)."""
    out = docs.withColumn("_q", assess(model, text))
    out = out.withColumns({c: F.col(f"_q.{c}") for c in (*COUNTS, "probability")}).drop("_q")
    failed = (F.col("n_words") < p.min_words) | (100 * F.col("n_repeat_words") > p.max_repeat_percent * F.col("n_words"))
    return (out.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= p.min_probability)))
