"""Secret scans: fixed patterns, and tokens that a battery of randomness tests tells from ordinary text.

For each long token, and the parts it falls into at its signs, the encoding is inferred as the smallest usual alphabet
that holds it. Three tests look at its symbols, twice each. As evidence against ordinary text, the use of the alphabet
(letters as in prose or evenly; digits, capitals and signs in the alphabet's share or in any), the number of runs
(changes between words and numbers) and the correlation of neighbours (vowels beside consonants) give likelihood ratios,
whose product ordinary text exceeds x times with a chance of at most 1 / x: an e-value. As tests of randomness,
chi-squared against uniform use, runs and serial correlation give levels: the least of them refuses the token under LEVEL
(words, counting up, keyboard rows) and, times their number, lessens that value where it is under DOUBTED.

What is found is decided for a document as a whole: the e-values of all its parts, weighted by their lengths, go through a
step-up (the k largest are found if the k-th is at least m / (k * FALSE_RATE), m parts in all). The expected share of
false ones among those found is then at most FALSE_RATE, however the parts depend on each other.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import smaller_batches, text_or_empty

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:={1,6}(?![A-Za-z0-9+/_=-]))?")  # '=' pads the end; before a value it parts name and value
#: How a token is cut into parts, beside taking it whole: at the signs of base64, of base64url, and of both.
CUTS = tuple(re.compile(x) for x in (r"[^+/]+", r"[^_-]+", r"[^+/_-]+"))
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")

#: Usual alphabets, smallest first, and how often each letter stands in English prose (per mille).
ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("base64 of both kinds", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
)
PROSE = dict(zip("abcdefghijklmnopqrstuvwxyz", (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1), strict=True))
#: How often ordinary tokens change from one word or number to the next, and how many times as often as by chance a
#: vowel (True) or consonant (False) follows another in words.
CHANGES, FOLLOWS = 0.06, {(True, True): 0.3, (True, False): 1.45, (False, True): 1.5, (False, False): 0.68}
#: The expected share of ordinary parts among those found in a document, at most. A test of randomness that is failed at
#: LEVEL refuses a part; a battery failed at DOUBTED lessens its evidence.
FALSE_RATE, DOUBTED, LEVEL = 5e-4, 0.05, 1e-3
LEAST = 16


def _kind(symbol: str) -> int:
    return 0 if symbol.isdigit() else 1 if symbol.islower() else 2 if symbol.isupper() else 3


class Encoding:
    """An alphabet: each symbol's place, the evidence of each letter, and what random tokens look like."""

    def __init__(self, letters: str):
        share = Counter(ch.lower() for ch in letters if ch.isalpha())
        prose = sum(PROSE[ch] for ch in share)
        kinds = Counter(map(_kind, letters))
        known = sum(kinds[k] for k in (0, 1, 2))
        self.places = {ch: i for i, ch in enumerate(letters)}
        self.letters = {ch: math.log(n / share.total() / (PROSE[ch] / prose)) for ch, n in share.items()}
        #: What a letter tells that ordinary text takes from all letters and this alphabet has few of.
        self.narrow = math.log(sum(PROSE.values()) / prose)
        self.digits, self.signs = kinds[0] / known, kinds[3] / len(letters)
        self.both_cases = kinds[1] > 0 and kinds[2] > 0
        self.changed = 1 - sum((kinds[k] / known) ** 2 for k in (0, 1, 2)) - kinds[2] * kinds[1] / known**2


_ENCODINGS = [Encoding(letters) for _, letters in ALPHABETS]
_KIND = {ch: _kind(ch) for ch in ALPHABETS[-1][1]}
_FOLDED = {ch: i for i, ch in enumerate("abcdefghijklmnopqrstuvwxyz0123456789+/-_")}
_VOWELS = frozenset("aeiouAEIOU")


def encoding_of(token: str) -> Encoding | None:
    """The smallest alphabet that holds the token without its padding."""
    symbols = set(token)
    return next((x for x in _ENCODINGS if symbols <= x.places.keys()), None)


def _above(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _share_evidence(k: int, n: int, p: float) -> float:
    """Evidence of k of n symbols of a sort: random tokens have their share p, ordinary ones none or else any number alike."""
    ways = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    return ways + k * math.log(p) + (n - k) * math.log(1 - p) - math.log(0.5 if not k else 0.5 / n)


def _correlated(values: list[int]) -> float:
    """The level at which neighbours go together as those of a random token wouldn't."""
    at = np.array(values, dtype=np.float64)
    centred = at - at.mean()
    spread = float((centred**2).sum())
    return math.erfc(abs(float((centred[1:] * centred[:-1]).sum()) / spread) * math.sqrt(len(at) / 2)) if spread else 0.0


def battery(token: str, encoding: Encoding, changes: int, pairs: int) -> list[float]:
    """The levels at which a random token looks as little like one: alphabet use, neighbours twice, runs."""
    n, k = len(token), len(encoding.places)
    at = [encoding.places[ch] for ch in token]
    uniform = float(((np.bincount(at, minlength=k) - n / k) ** 2).sum() * k / n)
    spread = 2 / (9 * (k - 1))  # the cube root of a chi-squared variable is nearly normal
    levels = [_above(((uniform / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread)), _correlated(at), _correlated([_FOLDED[ch.lower()] for ch in token])]
    if pairs:  # too few runs
        p = encoding.changed
        levels.append(_above((pairs * p - changes) / math.sqrt(pairs * p * (1 - p))))
    return levels


def evidence(token: str) -> float:
    """The logarithm of the token's e-value against ordinary text; 0 where there is none or the battery refuses it."""
    token = token.rstrip("=")
    encoding = encoding_of(token)
    if encoding is None or len(token) < LEAST:
        return 0.0
    kinds = [_KIND[ch] for ch in token]
    digits, small, large, signs = (kinds.count(k) for k in range(4))
    if not small + large:
        return 0.0
    changes = pairs = 0
    for x, y in zip(kinds, kinds[1:]):
        if x < 3 and y < 3:  # a capital goes with the small letters of its word
            pairs += 1
            changes += x != y and (x, y) != (2, 1)
    levels = battery(token, encoding, changes, pairs)
    if min(levels) < LEVEL:
        return 0.0
    out = min(0.0, math.log(min(levels) * len(levels) / DOUBTED)) + _share_evidence(digits, digits + small + large, encoding.digits)
    if encoding.signs:
        out += _share_evidence(signs, len(token), encoding.signs)
    if encoding.both_cases:
        out += _share_evidence(large, small + large, 0.5)
    out += sum(encoding.letters[ch.lower()] for ch, k in zip(token, kinds) if k in (1, 2))
    out += float(np.logaddexp(0.0, (small + large) * encoding.narrow)) - math.log(2)  # half for text of any alphabet, half for that of this one
    out += changes * math.log(encoding.changed / CHANGES) + (pairs - changes) * math.log((1 - encoding.changed) / (1 - CHANGES))
    for x, y in zip(token, token[1:]):
        if x.isalpha() and y.isalpha():
            out -= math.log(FOLLOWS[x in _VOWELS, y in _VOWELS])
    return max(out, 0.0)


def parts_of(text: str, start: int, end: int) -> set[tuple[int, int]]:
    """A token as a whole and what each way of cutting leaves of it, as far as these are long enough."""
    if end - start < LEAST:
        return set()
    return {(start, end)} | {(m.start(), m.end()) for way in CUTS for m in way.finditer(text, start, end) if m.end() - m.start() >= LEAST}


def discoveries(text: str, parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Which parts of a document are taken for random, by the step-up over all of them.

    Of those found that overlap, the one of the largest weighted e-value is taken.
    """
    if not parts:
        return []
    mean = sum(e - s for s, e in parts) / len(parts)
    ranked = sorted((-evidence(text[s:e]) - math.log((e - s) / mean), s, e) for s, e in parts)
    last = max((k for k, (weight, _, _) in enumerate(ranked, 1) if -weight >= math.log(len(parts) / (k * FALSE_RATE))), default=0)
    taken: list[tuple[int, int]] = []  # by start; they don't overlap, so their ends ascend as well
    for _, s, e in ranked[:last]:
        at = bisect.bisect_left(taken, (s, e))
        if (at == 0 or taken[at - 1][1] <= s) and (at == len(taken) or taken[at][0] >= e):
            taken.insert(at, (s, e))
    return taken


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; kind is the place in KINDS."""
    found = []
    if ":" in text or "=" in text:  # each match of the first pattern holds one of them
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    return found


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans and all spans of a whole text, each by start, then kind."""
    base, parts = base_spans(text), []
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
    for start, end in tokens:  # a run of hex digits lies within one token
        if end - start >= LEAST_HEX:
            base += [(start + m.start(), 2, start + m.end()) for m in HEX.finditer(text[start:end]) if len(m[0]) >= LEAST_HEX]
    base.sort()
    reach, at = 0, 0  # how far the base spans go that start before the token ends
    for start, end in tokens:
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= start:
            parts += parts_of(text, start, end)
    return base, sorted(base + [(start, 3, end) for start, end in discoveries(text, parts)])


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with each span, overlapping ones together, replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Whole texts are scanned; a null text counts as an empty one (no spans, the hash of nothing). Offsets are
    code points, ends exclusive. Repeated rows each give a row, a null doc_id stays null, other columns are
    ignored, an empty table gives an empty one.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in smaller_batches(whole, "text", 8 << 20):
                rows = []
                for text in batch["text"]:
                    base, spans = scan(text.as_py())
                    kinds = [kind for _, kind, _ in spans]
                    rows.append((*(kinds.count(k) for k in range(3)), hashlib.sha256(written(base).encode()).hexdigest(), written(spans), kinds.count(3)))
                columns = [pa.array(c, pa.string() if i in (3, 4) else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, schema)


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` and n_chars, where there is one, counted again.

    Rows without a span, and null texts, stay as they are. All columns are kept.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None
        for batch in (piece for whole in batches for piece in smaller_batches(whole, "text", 8 << 20)):
            texts, columns = batch.column(at).to_pylist(), list(batch.columns)
            found = [scan(text)[1] if text else [] for text in texts]
            if any(found):
                new = [redacted(text, spans, mark) if spans else text for text, spans in zip(texts, found, strict=True)]
                columns[at] = pa.array(new, columns[at].type)
                if chars is not None:
                    columns[chars] = pa.array([len(n) if s else c for n, s, c in zip(new, found, columns[chars].to_pylist(), strict=True)], columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
