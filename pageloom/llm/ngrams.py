"""Hashed word and character n-gram features of whole texts, computed with numpy over blocks of UTF-8 bytes.

A text is lower-cased (A-Z) and its white space becomes a space. Features are the words and the byte n-grams that do not reach
over a space, where the space before and after a word counts as a part of it. A word equal to the one before it also gives a
repeat mark, the same for all words. Each feature goes to one of ``2**bits`` buckets. Every feature of the whole text counts;
memory is bounded by the block (a long text is read in pieces that end between words). The features of a text, and sums over
them, do not depend on the texts beside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SPACE = 32
_RNG = np.random.default_rng(20240501)
_BYTE = _RNG.integers(1, 2**32, 256, dtype=np.uint32) | np.uint32(1)
_PLACE = _RNG.integers(1, 2**32, 64, dtype=np.uint32) | np.uint32(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = SPACE
PIECE = 1 << 20  # bytes of a long text that are looked at together


class Hasher:
    """``words``: word features too; ``sizes``: lengths of byte n-grams."""

    def __init__(self, bits: int = 18, sizes: tuple[int, ...] = (3, 4, 5), words: bool = True):
        self.bits, self.sizes, self.words = bits, tuple(sorted(sizes)), words

    def _bucket(self, h: np.ndarray, family: int) -> np.ndarray:
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(family * 0x9E3779B1 & 0xFFFFFFFF)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        return (h >> np.uint32(32 - self.bits)).astype(np.int32)

    @property
    def repeat_mark(self) -> int:
        return int(self._bucket(np.zeros(1, np.uint32), 2)[0])

    def families(self, raw: bytes, piece: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(position, bucket) of the features of each family; ``raw`` starts and ends with a space. ``piece``: number of the
        piece at each position; no repeat mark reaches from one to the next."""
        buf = _LOWER[np.frombuffer(raw, np.uint8)]
        n = len(buf)
        space = buf == SPACE
        place = np.arange(n, dtype=np.int32)
        value = _BYTE[buf]
        following = np.empty(n, np.int32)  # first space after a position
        later = np.where(space, place, n)[::-1]
        following[:-1] = np.minimum.accumulate(later)[::-1][1:]
        following[-1] = n
        if self.words:
            starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
            if len(starts):
                first = np.zeros(n, np.int32)
                first[starts] = starts
                inside = (place - np.maximum.accumulate(first)) & 63
                mixed = value * _PLACE[inside]
                mixed[space] = 0
                whole = np.add.reduceat(mixed, starts, dtype=np.uint32)
                yield starts, self._bucket(whole, 1)
                same = whole[1:] == whole[:-1]
                if piece is not None:
                    same &= piece[starts[1:]] == piece[starts[:-1]]
                again = starts[1:][same]
                yield again, np.full(len(again), self.repeat_mark)
        if self.sizes:
            h = value.copy()
            for k in range(2, self.sizes[-1] + 1):
                if n < k:
                    break
                h = h[:n - k + 1] + value[k - 1:] * _PLACE[k]
                if k in self.sizes:
                    at = np.flatnonzero(following[:n - k + 1] >= place[:n - k + 1] + (k - 1))
                    if k == 2:
                        at = at[~(space[at] & space[at + 1])]
                    else:
                        at = at[~(space[at] & (following[at] == at + 1))]
                    yield at, self._bucket(h[at], k)

    @staticmethod
    def pieces(text: memoryview) -> Iterator[bytes]:
        """The text in parts cut at spaces, so that no n-gram is lost or split (a word longer than a part stays whole)."""
        if len(text) <= PIECE:
            yield bytes(text)
            return
        held = b""
        for at in range(0, len(text), PIECE):
            held += bytes(text[at:at + PIECE])
            end = max(held.rfind(c) for c in (b" ", b"\n", b"\t"))
            if end > 0:
                yield held[:end]
                held = held[end + 1:]
        yield held

    @staticmethod
    def edge_repeats(pieces: list[bytes]) -> int:
        """How often a piece of a text begins with the word that the piece before it ended with."""
        out, last = 0, None
        for words in (p.lower().split() for p in pieces) if len(pieces) > 1 else ():
            if words:
                out += words[0] == last
                last = words[-1]
        return out

    def counts(self, text: memoryview | None) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of one text, ascending, and how often each occurs."""
        found = np.zeros(0, np.int32), np.zeros(0, np.int64)
        pieces = list(self.pieces(text)) if text is not None else []
        each = [[b for _, b in self.families(b" " + p + b" ")] for p in pieces]
        if self.words:
            each.append([np.full(self.edge_repeats(pieces), self.repeat_mark)])
        for buckets in each:
            if buckets:
                ids, n = np.unique(np.concatenate(buckets), return_counts=True)
                if len(found[0]):
                    ids, back = np.unique(np.concatenate([found[0], ids]), return_inverse=True)
                    n = np.bincount(back, np.concatenate([found[1], n])).astype(np.int64)
                found = ids, n
        return found

    def sums(self, block: list[memoryview | None], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the weights of all features of each text of the block, and the number of features.

        Every piece is summed for itself and in order, so a text has the same sum, to the last bit, in any block.
        """
        total, number = np.zeros(len(block)), np.zeros(len(block), np.int64)
        taken: list[tuple[int, bytes]] = []
        size = 0
        for i, text in enumerate(block):
            pieces = list(self.pieces(text)) if text is not None else []
            for p in pieces:
                if taken and size + len(p) > PIECE:
                    self._add(taken, weight, total, number)
                    taken, size = [], 0
                taken.append((i, p))
                size += len(p) + 1
            if self.words and (again := self.edge_repeats(pieces)):
                self._add(taken, weight, total, number)
                taken, size = [], 0
                total[i] += again * float(weight[self.repeat_mark])
                number[i] += again
        self._add(taken, weight, total, number)
        return total, number

    def _add(self, taken: list[tuple[int, bytes]], weight: np.ndarray, total: np.ndarray, number: np.ndarray) -> None:
        if not taken:
            return
        raw = b" " + b" ".join(p for _, p in taken) + b" "
        # the space before a piece belongs to it, as an n-gram may begin there
        piece = np.repeat(np.arange(len(taken), dtype=np.int32), [len(p) + 1 for _, p in taken])
        piece = np.append(piece, np.int32(len(taken) - 1))
        sums, counts = np.zeros(len(taken)), np.zeros(len(taken), np.int64)
        for at, bucket in self.families(raw, piece):
            sums += np.bincount(piece[at], weight[bucket], len(taken))
            counts += np.bincount(piece[at], minlength=len(taken))
        for k, (i, _) in enumerate(taken):
            total[i] += sums[k]
            number[i] += counts[k]
