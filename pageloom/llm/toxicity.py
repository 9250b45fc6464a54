"""Toxicity: logistic regression on hashed n-grams whose scores must not move when identity terms are swapped.

For each sampled text that names a group, a twin is made in which every identity term is replaced by the next one of its list.
Training adds the squared difference of the two scores, so the weight of the terms themselves is pulled to the common one and
neutral mentions of a group are not taken for toxicity.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks
from .linear import Linear, train
from .ngrams import Hasher
from .samples import Example, features, labelled, unpack

# Exchangeable terms, list by list; a parameter, since they depend on the languages of the corpus.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "bisexual"), ("immigrants", "natives"), ("old", "young"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)


@dataclass(frozen=True)
class Params:
    bits: int = 18
    sizes: tuple[int, ...] = (3, 4, 5)
    per_class: int = 2000  # labelled rows of each class that are fitted on at most
    pull: float = 4.0  # weight of the counterfactual penalty
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS


def swapped(text: Column, terms: tuple[tuple[str, ...], ...]) -> Column:
    """The text with each identity term replaced by the next of its list, in one pass; whole words, any letter case."""
    after = {t: ring[(k + 1) % len(ring)] for ring in terms for k, t in enumerate(ring)}
    pattern = re.compile(r"\b(" + "|".join(sorted(map(re.escape, after), key=len, reverse=True)) + r")\b", re.IGNORECASE)

    @F.arrow_udf("string")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([None if t is None else pattern.sub(lambda m: after[m[1].lower()], t) for t in batch.to_pylist()], pa.string())

    return run(text)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, p: Params = Params(), label: str = "toxic") -> Linear:
    hasher = Hasher(p.bits, p.sizes)
    rows = labelled(docs, labels, label, learn, p.per_class).withColumn("twin", swapped(F.col("text"), p.terms))
    changed = F.when(F.lower("text") != F.lower("twin"), F.col("twin"))
    got = rows.select("doc_id", "label", F.xxhash64("text").alias("h"), changed.isNotNull().alias("differs"),
                      features(hasher, "text").alias("f"), features(hasher, changed).alias("t")).collect()
    got.sort(key=lambda r: (r.doc_id, r.h))
    found = [Example(r.label, *unpack(r.f)) for r in got]
    twins = [Example(r.label, *unpack(r.t)) if r.differs else None for r in got]
    return train(found, hasher, twins=twins, pull=p.pull, by_ratio=True)


def score(model: Linear, text: str) -> Column:
    """Probability of label 1 for every whole text; null and blank texts have no feature and get the score of the bias."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = [model.scores(block) for block in blocks(batch)]
            yield pa.array(np.concatenate(out) if out else np.zeros(0))

    return run(F.col(text))
