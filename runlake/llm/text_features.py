"""Hashed n-grams of words and characters as numpy arrays, in memory that doesn't grow with the text.

A text is read in pieces of so many characters. What a cut goes through is carried over it: the word that
goes on, the word before a pair, the characters of a run. So features don't depend on where the cuts are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_PRIME, _FULL = 0x100000001B3, (1 << 64) - 1
_STEP, _MIX = np.uint64(_PRIME), np.uint64(0x9E3779B97F4A7C15)
#: Characters that are read at a time, and the longest run of characters less one.
PIECE, AHEAD = 1 << 16, 3

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int) -> np.ndarray:
    out = np.full(PIECE + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_FORTH, _BACK = _powers(_PRIME), _powers(pow(_PRIME, -1, 1 << 64))


def scan(text: str) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """For each piece: its characters' numbers with those of up to AHEAD more, how many are its own, where words
    start in it, and the 64-bit hashes of the words that end in it, in order.

    A word's hash is the sum of (character + 1) * prime**place over its characters, which can go on over a cut.
    """
    at, inside, held, length = 0, False, 0, 0
    while at < len(text):
        n = min(PIECE, len(text) - at)
        codes = np.frombuffer(text[at : at + n + AHEAD].encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        own = codes[:n]
        solid = (own > 32) | ((own < 32) & ((own < 9) | (own > 13)))
        at += n
        edge = np.diff(np.concatenate([[inside], solid, [solid[-1] and at < len(text)]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((own + np.uint64(1)) * _FORTH[:n], out=total[1:])
        begins = np.concatenate([[0], starts]) if inside else starts
        first = begins[: len(ends)]
        hashes = (total[ends] - total[first]) * _BACK[first]
        if inside and len(ends):
            hashes[0] = (held + int(hashes[0]) * pow(_PRIME, length, 1 << 64)) & _FULL
        if len(begins) > len(ends):  # the last word goes on
            s = int(begins[-1])
            part = ((int(total[n]) - int(total[s])) * int(_BACK[s])) & _FULL
            goes_on = inside and not len(ends)
            held = (held + part * pow(_PRIME, length, 1 << 64)) & _FULL if goes_on else part
            length = length + n if goes_on else n - s
            inside = True
        else:
            inside = False
        yield codes, n, starts, hashes * _MIX


def buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    return ((hashes * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def char_hashes(codes: np.ndarray, size: int, most: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` characters that starts in the first ``most``."""
    n = max(0, min(most, len(codes) - size + 1))
    out = codes[:n] + np.uint64(size)
    for k in range(1, size):
        out = out * _STEP + codes[k : n + k]
    return out


def scaled(counts: np.ndarray) -> np.ndarray:
    """Dampened counts, each row of length one."""
    x = np.log1p(counts).astype(np.float32)
    return x / np.maximum(np.sqrt((x * x).sum(axis=-1, keepdims=True)), 1e-6)


def document(text: str, bits: int) -> np.ndarray:
    """A row of 2 * 2**bits features: hashed words and pairs of words, then hashed runs of 3 and 4 characters."""
    size = 1 << bits
    counts = np.zeros(2 * size)
    before = np.zeros(0, dtype=np.uint64)
    for codes, n, _, hashes in scan(text):
        chain = np.concatenate([before, hashes])
        both = chain[:-1] * _STEP + chain[1:]
        counts[:size] += np.bincount(buckets(hashes, bits), minlength=size) + np.bincount(buckets(both, bits), minlength=size)
        for run in (3, 4):
            counts[size:] += np.bincount(buckets(char_hashes(codes, run, n), bits), minlength=size)
        before = chain[-1:]
    return np.concatenate([scaled(counts[:size]), scaled(counts[size:])])


#: Columns of a passage beside the hashed ones: see ``passages``.
SHAPE = 5


def _shapes(ids: np.ndarray, of_word: np.ndarray, rows: int, length: int) -> np.ndarray:
    """The last columns of some passages, from the hashes of their words and the passage of each."""
    n_words = np.bincount(of_word, minlength=rows)
    inner = of_word[1:] == of_word[:-1]
    n_pairs = np.maximum(n_words - 1, 1)
    again = np.bincount(of_word[1:][inner & (ids[1:] == ids[:-1])], minlength=rows) / n_pairs
    pairs = (ids[:-1] * _STEP + ids[1:])[inner]
    different = [
        np.bincount((np.unique((at << 40).astype(np.uint64) | (h >> np.uint64(24))) >> np.uint64(40)).astype(np.int64), minlength=rows)
        for at, h in ((of_word, ids), (of_word[1:][inner], pairs))
    ]
    return np.stack([different[0] / np.maximum(n_words, 1), again, different[1] / n_pairs, n_words / length, np.log1p(n_words) / 5], axis=1).astype(np.float32)


def passages(text: str, bits: int, length: int) -> Iterator[np.ndarray]:
    """Rows of 2 * 2**bits + SHAPE features for the passages of ``length`` words, some at a time.

    A passage goes from its first word to the next one's. A text without words has one row of zeros. The last
    columns are the shares of different words, of words equal to the one before and of different pairs of
    words, how full the passage is, and the logarithm of its words.
    """
    size = 1 << bits
    started = ended = first = 0  # words so far, and the passage that is open
    tokens, chars, ids = np.zeros((1, size)), np.zeros((1, size)), np.zeros(0, dtype=np.uint64)

    def made(rows: int) -> np.ndarray:
        """The first rows of what is held, which are whole."""
        of_word = np.arange(first * length, first * length + len(ids)) // length - first
        own = of_word < rows
        return np.concatenate([scaled(tokens[:rows]), scaled(chars[:rows]), _shapes(ids[own], of_word[own], rows, length)], axis=1)

    for codes, n, starts, hashes in scan(text):
        mark = np.zeros(n, dtype=np.int64)
        mark[starts] = 1
        word = started + np.cumsum(mark) - 1
        started += len(starts)
        rows = max(started - 1, 0) // length - first + 1
        run = char_hashes(codes, 3, n)
        known = word[: len(run)] >= 0
        of_char = word[: len(run)][known] // length - first
        of_word = np.arange(ended, ended + len(hashes)) // length - first
        ended += len(hashes)
        more = [np.bincount(at * size + buckets(h, bits), minlength=rows * size).reshape(rows, size).astype(np.float64) for at, h in ((of_word, hashes), (of_char, run[known]))]
        more[0][0] += tokens[0]
        more[1][0] += chars[0]
        tokens, chars, ids = more[0], more[1], np.concatenate([ids, hashes])
        if rows > 1:  # a passage is whole once the next one has begun
            yield made(rows - 1)
            tokens, chars, ids = tokens[-1:], chars[-1:], ids[(rows - 1) * length :]
            first += rows - 1
    yield made(1) if started else np.zeros((1, 2 * size + SHAPE), dtype=np.float32)
