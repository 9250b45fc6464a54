"""Language ID by unigram piece models summed over all segmentations.

The pieces are those of a fixed public vocabulary, as byte strings (its byte pieces make every string reachable). Each language
has a probability for every piece, found by expectation maximisation on a bounded sample. The probability of a word is the sum
over all ways to cut it into pieces of the product of their probabilities (forward algorithm); words are independent.
All of that runs in numpy over many distinct words at once, and each task keeps the results of words it has seen.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, decoded

UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UP, _DOWN = 1e100, np.log(1e100)


@dataclass(frozen=True)
class Params:
    vocabulary: str = "piece_bpe_32k.model"
    per_language: int = 400  # documents of each language that are learned from at most
    rounds: int = 4
    smooth: float = 0.02  # added to each piece's expected count
    longest_word: int = 192  # bytes; a longer run of letters is read as several words, none is left out
    remembered: int = 150_000  # words whose results a task keeps


def vocabulary(name: str) -> list[bytes]:
    """Distinct byte strings of the pieces that can occur in a word; a leading space marks the start of a word."""
    import public_tokenizers as public
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=public.path(name))
    found = set()
    for k in range(model.get_piece_size()):
        if model.is_byte(k):
            found.add(bytes([int(model.id_to_piece(k)[3:5], 16)]))
        elif not (model.is_control(k) or model.is_unknown(k)):
            piece = model.id_to_piece(k).replace("▁", " ").encode()
            if b" " not in piece[1:]:
                found.add(piece)
    return sorted(found)


class Lattice:
    """Finds all pieces in words. Prefixes of pieces are looked up by a 64-bit hash, so a search stops where no piece goes on."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        number = {p: k for k, p in enumerate(pieces)}
        prefixes = {p[:n] for p in pieces for n in range(1, len(p) + 1)}
        keyed = sorted((int(self._hash(p)), number.get(p, -1)) for p in prefixes)
        self.keys = np.array([k for k, _ in keyed], np.uint64)
        self.ids = np.array([v for _, v in keyed], np.int32)
        self.longest = max(map(len, pieces))

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def edges(self, words: list[bytes]) -> tuple[np.ndarray, list[list[tuple[int, np.ndarray, np.ndarray]]]]:
        """Lengths, and for each start position the (piece length, word numbers, piece ids) found there."""
        lengths = np.array([len(w) for w in words])
        width = int(lengths.max())
        grid = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        grid = grid.astype(np.uint64) + np.uint64(1)
        out = []
        for start in range(width):
            rows = np.flatnonzero(lengths > start)
            h = np.zeros(len(rows), np.uint64)
            here = []
            for n in range(1, min(self.longest, width - start) + 1):
                if n > 1:
                    more = lengths[rows] >= start + n
                    rows, h = rows[more], h[more]
                h = h * _BASE + grid[rows, start + n - 1]
                at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                known = self.keys[at] == h
                rows, h, at = rows[known], h[known], at[known]
                if not len(rows):
                    break
                ids = self.ids[at]
                whole = ids >= 0
                if whole.any():
                    here.append((n, rows[whole], ids[whole]))
            out.append(here)
        return lengths, out


def _lifted(value: np.ndarray, lift: np.ndarray, at: int, onward: slice) -> None:
    """Raises values at place ``at`` that are very small, and those that build on them, so that long words do not underflow."""
    low = (value[:, at] < 1 / _UP) & (value[:, at] > 0)
    if low.any():
        w, k = np.nonzero(low)
        value[w, onward, k] *= _UP
        lift[w, k] += _DOWN


def forward(lattice: Lattice, prob: np.ndarray, words: list[bytes]):
    """log P(word) for each language, and what the backward pass needs: forward values, the log factor each place has been raised by,
    lengths, edges. ``prob``: (pieces, languages). A word that no pieces make has probability 0."""
    lengths, edges = lattice.edges(words)
    alpha = np.zeros((len(words), len(edges) + 1, prob.shape[1]))
    alpha[:, 0] = 1
    lift = np.zeros((len(words), prob.shape[1]))
    raised = np.zeros_like(alpha)
    for start, here in enumerate(edges):
        _lifted(alpha, lift, start, slice(start, None))
        raised[:, start] = lift
        for n, rows, ids in here:
            alpha[rows, start + n] += alpha[rows, start] * prob[ids]
    ends = alpha[np.arange(len(words)), lengths]
    return np.log(np.maximum(ends, 1e-300)) - lift, alpha, raised, lengths, edges


def expected(lattice: Lattice, prob: np.ndarray, words: list[bytes], n: np.ndarray) -> np.ndarray:
    """Expected piece counts over all segmentations, (pieces, languages); ``n``: how often each word occurs in each language.

    Forward and backward values are raised each on its own, so their product is taken in logarithms.
    """
    total = np.zeros_like(prob)
    whole, alpha, raised, lengths, edges = forward(lattice, prob, words)
    beta = np.zeros_like(alpha)
    beta[np.arange(len(words)), lengths] = 1
    lift = np.zeros((len(words), prob.shape[1]))
    with np.errstate(divide="ignore"):
        before, logs = np.log(alpha) - raised, np.log(prob)
        for start in range(len(edges) - 1, -1, -1):
            for size, rows, ids in edges[start]:
                beta[rows, start] += prob[ids] * beta[rows, start + size]
            # what edges from here can reach has been raised as often as this place
            for size, rows, ids in edges[start]:
                part = before[rows, start] + logs[ids] + np.log(beta[rows, start + size]) - lift[rows] - whole[rows]
                part = np.exp(part) * n[rows]
                for k in range(prob.shape[1]):
                    total[:, k] += np.bincount(ids, part[:, k], len(prob))
            _lifted(beta, lift, start, slice(start, start + lattice.longest + 1))
    return total


@dataclass
class Model:
    languages: list[str]
    pieces: list[bytes]
    prob: np.ndarray  # (pieces, languages)
    params: Params


def words_of(text: str, longest: int) -> list[bytes]:
    """Runs of letters in lower case as UTF-8, each with a leading space."""
    out = []
    for w in LETTERS.findall(text.lower()):
        if not w.isalpha():  # numerals such as fractions count as word characters in patterns
            w = "".join(filter(str.isalpha, w))
            if not w:
                continue
        w = b" " + w.encode()
        out += [w] if len(w) <= longest else [w[k:k + longest] for k in range(0, len(w), longest)]
    return out


def groups(words: list[bytes], most: int = 4096) -> Iterator[list[int]]:
    """Word numbers in groups of about equal length, so that a grid of a group wastes little."""
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    at = 0
    while at < len(order):
        longest = max(32, len(words[order[at]]) * 2)
        end = at
        while end < len(order) and end - at < most and len(words[order[end]]) <= longest:
            end += 1
        yield order[at:end]
        at = end


def train(counted: dict[str, Counter], p: Params = Params()) -> Model:
    """``counted``: word counts of each language."""
    languages = sorted(counted)
    pieces = vocabulary(p.vocabulary)
    lattice = Lattice(pieces)
    words = sorted(set().union(*counted.values())) if counted else []
    n = np.array([[counted[k][w] for k in languages] for w in words], float).reshape(len(words), len(languages))
    length = np.array([len(x) for x in pieces], float)
    prob = np.repeat((np.exp(-length) / np.exp(-length).sum())[:, None], len(languages), 1)
    for _ in range(p.rounds if words else 0):
        total = np.full_like(prob, p.smooth)
        for part in groups(words):
            total += expected(lattice, prob, [words[k] for k in part], n[part])
        prob = total / total.sum(axis=0)
        if not np.isfinite(prob).all():
            raise ArithmeticError("piece probabilities are not finite")
    return Model(languages, pieces, prob, p)


class Scorer:
    def __init__(self, model: Model):
        self.model, self.lattice = model, Lattice(model.pieces)
        self._reset()

    def _reset(self) -> None:
        self.number: dict[bytes, int] = {}
        self.logs = np.zeros((0, len(self.model.languages)))

    def learn(self, words: set[bytes]) -> None:
        fresh = [w for w in words if w not in self.number]
        if not fresh:
            return
        logs = np.zeros((len(fresh), len(self.model.languages)))
        for part in groups(fresh):
            logs[part] = forward(self.lattice, self.model.prob, [fresh[k] for k in part])[0]
        base = len(self.number)
        self.number.update((w, base + k) for k, w in enumerate(fresh))
        self.logs = np.concatenate([self.logs, logs])

    def classify(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if len(self.number) > self.model.params.remembered:
            self._reset()
        longest = self.model.params.longest_word
        out = []
        found = [words_of(t, longest) if t else [] for t in texts]
        self.learn(set().union(*found) if self.model.languages else set())
        for words in found:
            if not words or not self.model.languages:
                out.append((UNKNOWN, 0.0))
                continue
            ids = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
            total = self.logs[ids].sum(axis=0) / np.sqrt(len(words))
            share = np.exp(total - total.max())
            best = int(share.argmax())
            out.append((self.model.languages[best], float(share[best] / share.sum())))
        return out


def fit(docs: DataFrame, learn: Column, p: Params = Params(), lang: str = "lang") -> Model:
    """Learns from at most ``per_language`` documents of each language, picked by hash of the text."""
    rows = docs.filter(learn & F.col(lang).isNotNull() & F.col("text").isNotNull()).select(F.col(lang).alias("lang"), "text")
    texts = rows.select("lang", F.xxhash64("text").alias("h")).distinct()
    picks = bounded_sample(texts, "lang", F.xxhash64(F.lit(13), "h"), p.per_language)
    chosen = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(picks), ["lang", "h"]).dropDuplicates(["lang", "h"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), decoded(batch.column(1))):
                found = Counter(words_of(text, p.longest_word))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(found), pa.string()), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                    ["lang", "word", "n"])

    counted: dict[str, Counter] = {}
    each = chosen.select("lang", "text").mapInArrow(count, "lang string, word binary, n long")
    for r in each.groupBy("lang", "word").agg(F.sum("n").alias("n")).toLocalIterator():
        counted.setdefault(r.lang, Counter())[bytes(r.word)] = r.n
    return train(counted, p)


def identify(model: Model, text: str) -> Column:
    """struct(lang_pred, score) for every whole text. A text that is null or has no letter is ``und`` with score 0.

    The score is the share of the best language when each has exp(log P(text) / sqrt(words)).
    """

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for batch in batches:
            found, at = [], 0
            while at < len(batch):
                part, size = [], 0
                while at < len(batch) and size < 1 << 20:
                    part.append(batch[at].as_py())
                    size += len(part[-1] or "")
                    at += 1
                found += scorer.classify(part)
            yield pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                             ["lang_pred", "score"])

    return run(F.col(text))
