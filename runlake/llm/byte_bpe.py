"""Byte-level BPE encoding and decoding.

Text is cut by the vocabulary's own pattern. The bytes of each piece are mapped to Latin-1, so that an
Aho-Corasick automaton over the vocabulary finds every token that starts at each byte. Encoding walks
from longest matches and backtracks: a token may follow another only if the merges, run over the two
together, would give back exactly these two. A sequence whose neighbours are all compatible is the one
that the merges give, so the result is exact. Each position is given up at most once, which bounds the
work by the length of the piece; answers about neighbours and whole pieces are memoised.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import struct

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import smaller_batches, text_or_empty

#: Entries that a task keeps about pieces and neighbours before it starts afresh; both hold short values.
PIECES_KEPT, PAIRS_KEPT = 300_000, 400_000
#: Longer pieces are encoded each time: they seldom return, and would make the memo's size unbounded.
LONGEST_KEPT = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a token in base64 and its id on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


#: Fixed values. White space, letters and digits of ASCII, and the other letters from U+00AA to U+024F.
SPACE, LETTER, DIGIT = r" \t\n\r\x0b\x0c", "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9"
_BEYOND = re.compile(f"[^\0-\x7f{LETTER}]").search


def cutter(pattern: str):
    """A function that cuts a text into the pieces that ``pattern`` matches.

    Texts of ASCII and Latin letters take the same pattern with its classes written out, which the
    standard library's engine runs twice as fast; a pattern that names other classes isn't rewritten.
    """
    general = regex.compile(pattern).findall
    plain = pattern
    for name, members in ((r"\p{L}", LETTER), (r"\p{N}", DIGIT), (r"\s", SPACE), (r"\S", f"^{SPACE}")):
        plain = re.sub(r"(\[\^?[^\]]*)?" + re.escape(name), lambda m, x=members: m[1] + x if m[1] else f"[{x}]", plain)
    if "\\p" in plain or "(?" in plain.replace("(?!", "").replace("(?:", "").replace("(?=", ""):
        return general
    fast = re.compile(plain).findall
    return lambda text: general(text) if _BEYOND(text) else fast(text)


class ByteBpe:
    """Encoder and decoder for one vocabulary; ids are the ranks of the merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pieces = cutter(pattern)
        self.ids = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.text_of = {rank: token for token, rank in self.ids.items()}
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.parts = {rank: self._last_merge(token) for token, rank in self.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ids.items():
            if self.parts[rank] is not None:
                self.automaton.add_word(token, (rank, len(token)))
        self.automaton.make_automaton()
        self.reachable = {token for token, rank in self.ids.items() if self.parts[rank] is not None}
        self.shorter = {rank: self._prefix(token) for token, rank in self.ids.items()}
        self.lengths = {rank: len(token) for token, rank in self.ids.items()}
        self.memo: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def _last_merge(self, token: str) -> tuple[int, int] | None:
        """The two ids whose merge makes ``token``; (id, id) twice for one byte; None if no merges make it."""
        own = self.ids[token]
        if len(token) == 1:
            return own, own
        parts = list(token)
        while len(parts) > 2:
            best = min(((self.ids.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1)))
            if best[0] >= own:
                return None
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return self.ids[parts[0]], self.ids[parts[1]]

    def _prefix(self, token: str) -> int | None:
        """The longest token that is a shorter prefix of ``token``."""
        return next((self.ids[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.reachable), None)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges over ``left`` and ``right`` together leave both as they are."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[left, right] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Undo the merges beside the boundary, latest first; none that was left then may cross it earlier.

        ``before`` is the rank before which a merge across the boundary would have come first. Of two
        merges of equal rank the left one is first, so the right part counts for one more.
        """
        before = 1 << 62
        while True:
            across = self.ids.get(self.text_of[left] + self.text_of[right])
            if across is not None and across < before:
                return False
            inner_left, inner_right = self.parts[left][1], self.parts[right][0]
            if inner_left == left and inner_right == right:
                return True
            if inner_right == right or (inner_left != left and left > right):
                before, left = left, inner_left
            else:
                before, right = right + 1, inner_right

    def encode_piece(self, piece: bytes) -> list[int]:
        text = piece.decode("latin-1")
        whole = self.ids.get(text)
        if whole is not None:  # a piece that is a token is that token, even if no merges make it
            return [whole]
        size, pairs, shorter, lengths = len(text), self.pairs, self.shorter, self.lengths
        longest: list[int | None] = [None] * (size + 1)
        reach = [0] * size
        for end, (rank, n) in self.automaton.iter(text):
            start = end - n + 1
            if n > reach[start]:
                reach[start], longest[start] = n, rank
        alive = bytearray(b"\1") * (size + 1)
        found: list[int] = []
        last, at, token = None, 0, longest[0]
        while token is not None:
            end = at + lengths[token]
            if alive[end]:
                fits = last is None or pairs.get((last, token))
                if fits is None:
                    fits = self.compatible(last, token)
                if fits:
                    found.append(token)
                    last, at, token = token, end, longest[end]
                    continue
            token = shorter[token]
            if token is None:  # nothing fits here: no encoding passes through this position
                alive[at] = 0
                token = found.pop()
                at -= lengths[token]
                last = found[-1] if found else None
        return found

    def packed(self, piece: str) -> bytes:
        known = self.memo.get(piece)
        if known is None:
            ids = self.encode_piece(piece.encode())
            known = struct.pack(f"<{len(ids)}I", *ids)
            if len(piece) <= LONGEST_KEPT:
                if len(self.memo) >= PIECES_KEPT:
                    self.memo.clear()
                self.memo[piece] = known
        return known

    def encode_packed(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.packed, self.pieces(text)))

    def decode_packed(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I")))


@functools.lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    """One encoder for each vocabulary and worker process."""
    return ByteBpe(read_ranks(path), pattern)


def encode_texts(docs: DataFrame, vocabulary: str, pattern: str, ids: bool = False) -> DataFrame:
    """Encode each whole text, decode the ids again.

    Returns a row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip (the decoded
    bytes are those of the text), and with ``ids`` also token_ids. A null text counts as an empty one: no
    tokens, the hash of nothing. Repeated rows each give a row; a null doc_id stays null; other columns are
    ignored; an empty table gives an empty one. ``vocabulary`` must be readable at this path on each executor.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean" + ", token_ids array<int>" * ids

    def make():
        bpe = load(vocabulary, pattern)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[list] = [[], [], [], []]
            packed_ids = []
            for text in batch["text"].to_pylist():
                packed = bpe.encode_packed(text)
                decoded = bpe.decode_packed(packed)
                for column, value in zip(out, (len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest(), decoded == text.encode()), strict=True):
                    column.append(value)
                if ids:
                    packed_ids.append(packed)
            columns = [batch["doc_id"], pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string()), pa.array(out[3], pa.bool_())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"]
            if ids:
                ends = pa.array([0, *_running(len(p) // 4 for p in packed_ids)], pa.int32())
                values = pa.Array.from_buffers(pa.int32(), ends[-1].as_py(), [None, pa.py_buffer(b"".join(packed_ids))])
                columns.append(pa.ListArray.from_arrays(ends, values))
                names.append("token_ids")
            return pa.RecordBatch.from_arrays(columns, names=names)

        return work

    def run(batches):
        work = make()
        for batch in batches:
            for piece in smaller_batches(batch, "text", 8 << 20):
                yield work(piece)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, schema)


def _running(lengths):
    total = 0
    for n in lengths:
        total += n
        yield total
