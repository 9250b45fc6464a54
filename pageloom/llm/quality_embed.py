"""Quality classifier: supervised subword embeddings.

Every hashed word and character n-gram has a learned vector; a text is the mean of the vectors of all its n-grams and a softmax
over two classes reads it. Vectors and softmax are trained together by stochastic gradient descent in numpy on a bounded
sample. For scoring, the softmax is linear in the mean, so the two are folded into one number per bucket (vector times the
difference of the class rows): the table that goes to the executors has a fixed size, and scores equal those of the full model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks
from .ngrams import Hasher
from .samples import Example, class_weights, examples, labelled


@dataclass(frozen=True)
class Params:
    bits: int = 18
    sizes: tuple[int, ...] = (3, 4, 5)
    dim: int = 16
    epochs: int = 8
    least_steps: int = 12_000  # a small sample is gone through more often
    rate: float = 0.4
    per_class: int = 1500  # labelled rows of each class that are fitted on at most
    seed: int = 1


@dataclass
class Model:
    hasher: Hasher
    vectors: np.ndarray  # (buckets, dim)
    output: np.ndarray  # (2, dim)
    bias: np.ndarray  # (2,)

    def folded(self) -> tuple[np.ndarray, float]:
        return (self.vectors @ (self.output[1] - self.output[0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def train(found: list[Example], p: Params = Params()) -> Model:
    """Without rows of both classes all vectors stay zero and the score is the smoothed share of label 1."""
    rng = np.random.default_rng(p.seed)
    hasher = Hasher(p.bits, p.sizes)
    vectors = np.zeros((1 << p.bits, p.dim), np.float32)
    ones = sum(e.label for e in found)
    if not 0 < ones < len(found):
        share = (ones + 1) / (len(found) + 2)
        return Model(hasher, vectors, np.zeros((2, p.dim), np.float32), np.log(np.array([1 - share, share])))
    vectors[:] = rng.uniform(-1 / p.dim, 1 / p.dim, vectors.shape)
    output = rng.normal(0, 0.5, (2, p.dim)).astype(np.float32)
    bias, weight = np.zeros(2), class_weights(found)
    epochs = max(p.epochs, -(-p.least_steps // len(found)))
    steps, step = epochs * len(found), 0
    for _ in range(epochs):
        for k in rng.permutation(len(found)):
            e = found[k]
            rate = p.rate * (1 - step / steps)
            step += 1
            if not len(e.ids):
                continue
            x = (e.n / e.n.sum()).astype(np.float32)
            hidden = x @ vectors[e.ids]
            logits = output @ hidden + bias
            prob = np.exp(logits - logits.max())
            prob /= prob.sum()
            error = prob.astype(np.float32)
            error[e.label] -= 1
            error *= np.float32(rate * weight[e.label])
            # a mean over thousands of n-grams moves each by a tiny part: the step is scaled by the number of distinct n-grams
            scale = np.float32(min(len(e.ids), 200))
            back = error @ output
            output -= np.outer(error, hidden)
            bias -= 0.1 * error
            vectors[e.ids] -= (x * scale)[:, None] * back
    return Model(hasher, vectors, output, bias)


def score(model: Model, text: str) -> Column:
    """Probability of label 1 for every whole text. A null text, and one without any word, has the mean vector zero."""
    table, bias = model.folded()
    hasher = model.hasher

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for block in blocks(batch):
                total, n = hasher.sums(block, table)
                out.append(1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + bias, -40, 40))))
            yield pa.array(np.concatenate(out) if out else np.zeros(0))

    return run(F.col(text))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, p: Params = Params(), label: str = "quality") -> Model:
    rows = labelled(docs, labels, label, learn, p.per_class)
    return train(examples(rows, Hasher(p.bits, p.sizes)), p)
