"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes of a text.

Both tokenizations of a text end at growing byte offsets. Merging the two rows of ends visits each stretch of bytes
between neighbouring ends once, and each such stretch is the overlap of one token of either side: a link. Where
both sides end at once, a group ends. The merge is cut along diagonals: on each, a binary search finds how many
ends of either side come before it, so that pieces hold equally many ends and need nothing of one another. Pieces give
their links and the ends that both sides share; a group that runs over pieces is put together from those.

Texts are aligned in blocks of bounded size. A block lists its different pairs of ids once, so that what Spark counts
over the corpus, and hands back to each block, is far less than the links.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import smaller_batches, spooled, text_or_empty

#: Bytes of text of a block (one long text may hold more), and ends of a piece of its merge.
BLOCK_BYTES, PIECE = 4 << 20, 1 << 16
#: Stretches of text whose ids a process keeps, and their characters, beside those of the block at hand, and how many are encoded as one text.
KEPT, KEPT_CHARS, TOGETHER = 1 << 18, 4 << 20, 1 << 14

BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
    "sizes array<int>, codes binary, times binary, pair_a array<int>, pair_b array<int>, pair_n array<long>"
)
COUNTS = ("doc_id", "n_a", "n_b", "n_groups", "n_links")


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 itself, the others from U+0100 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Tokenizers A (byte-level BPE) and B (pieces with byte fallback), and the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        letters = byte_of_letter()
        named = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(letters[c] for c in t) if all(c in letters for c in t) else b"" for t in named]
        # what stands for no bytes gets a byte that no UTF-8 text holds, so that its text differs
        self.bytes_b = [self._piece(i) for i in range(self.b.piece_size())]
        self.bytes_a = [t or b"\xff" for t in self.bytes_a]
        self.sizes = [np.array([len(t) for t in own], np.int64) for own in (self.bytes_a, self.bytes_b)]
        self.digits = [_digits(len(own)) for own in (self.bytes_a, self.bytes_b)]
        self.stretches = Stretches(self.a, self.bytes_a) if _cut_at_spaces(path_a) else None

    def _piece(self, i: int) -> bytes:
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b"\xff"
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(re.fullmatch("<0x([0-9A-F]{2})>", piece)[1], 16)])
        return piece.replace("▁", " ").encode() or b"\xff"

    def ids(self, texts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """The ids of all texts on either side, and where each text's start; none where the joined bytes of a side aren't the text after a space."""
        wholes = [f" {t}".encode() for t in texts]
        b = self.b.encode(texts, num_threads=1)
        good = np.array([bool(t) and b"".join(map(self.bytes_b.__getitem__, own)) == whole for t, own, whole in zip(texts, b, wholes)], bool)
        if self.stretches:
            flat, starts, same = self.stretches.ids([t if ok else "" for t, ok in zip(texts, good.tolist())])
        else:
            a = [e.ids for e in self.a.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]
            same = np.array([b"".join(map(self.bytes_a.__getitem__, own)) == whole for own, whole in zip(a, wholes)], bool)
            flat, starts = _flat(a)
        good &= same
        return _only(flat, starts, good), _only(*_flat(b), good)


#: Where a byte-level vocabulary always cuts: before a space that no white space follows.
_CUT = re.compile(r" (?=\S)")


def _cut_at_spaces(path: str) -> bool:
    """Whether a tokenizer's file cuts texts by the byte-level pattern alone, before all else, and joins each cut's bytes by itself."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    cut, model = told["pre_tokenizer"] or {}, told["model"]
    plain = told["normalizer"] is None and all(t["special"] for t in told["added_tokens"]) and model["type"] == "BPE" and not model.get("dropout")
    return plain and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)


class Stretches:
    """Ids of texts from those of their stretches: each begins with a space, and the tokenizer cuts a text between any two.

    The pattern gives a space to what follows it, and keeps white space to itself but for its last space, so what a
    stretch's ids are depends on it alone. Most stretches are words that come again and again: each is encoded once.
    """

    def __init__(self, tokenizer, token_bytes: list[bytes]):
        self.tokenizer, self.token_bytes = tokenizer, token_bytes
        self.sizes = np.array([len(t) for t in token_bytes], np.int64)
        self._forget()

    def _forget(self) -> None:
        # stretch 0 is nothing, which stands before a text's first space
        self.places, self.chars = {"": 0}, 0
        self.flat, self.starts, self.same = np.zeros(0, np.int64), np.zeros(2, np.int64), np.ones(1, bool)

    def _learn(self, new: list[str]) -> None:
        """Encode stretches, many as one text, unless they begin with more white space, which one before might draw to itself."""
        plain = [s for s in new if s[0] != " "]
        groups = [plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)] + [[s] for s in new if s[0] == " "]
        flats, starts, sames, end = [self.flat], [self.starts], [self.same], len(self.flat)
        while groups:
            wholes = [[s.encode() if s[0] == " " else f" {s}".encode() for s in group] for group in groups]
            texts = [b"".join(whole) for whole in wholes]
            split = []
            for group, whole, text, e in zip(groups, wholes, texts, self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)):
                listed = e.ids
                ids = np.array(listed, np.int64)
                same = b"".join(map(self.token_bytes.__getitem__, listed)) == text
                ends, until = np.cumsum(self.sizes[ids]), np.cumsum(np.fromiter(map(len, whole), np.int64, len(whole)))
                after = np.searchsorted(ends, until) + 1 if same else np.array([len(ids)])
                if len(group) > 1 and not (same and (ends[after - 1] == until).all()):
                    split += [[s] for s in group]  # not what the pattern promises: each by itself
                    continue
                self.places.update(zip(group, range(len(self.places), len(self.places) + len(group))))
                flats.append(ids)
                starts.append(end + after)
                sames.append(np.full(len(group), same))
                end += len(ids)
            groups = split
        self.flat, self.starts, self.same = (np.concatenate(x) for x in (flats, starts, sames))
        self.chars += sum(map(len, new))

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts, each after a space, where each text's start and the last one's end, and whether each one's bytes are the text's."""
        if len(self.places) > KEPT or self.chars > KEPT_CHARS:
            self._forget()
        cut = [_CUT.split(f" {t}") for t in texts]
        stretches = [s for own in cut for s in own]
        if new := set(stretches).difference(self.places):
            self._learn(list(new))
        at = np.fromiter(map(self.places.__getitem__, stretches), np.int64, len(stretches))
        sizes = np.diff(self.starts)[at]
        until = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.flat[np.repeat(self.starts[at] - until[:-1], sizes) + np.arange(until[-1])]
        firsts = np.concatenate([[0], np.cumsum([len(own) for own in cut], dtype=np.int64)])
        wrong = np.concatenate([[0], np.cumsum(~self.same[at])])
        return flat, until[firsts], np.diff(wrong[firsts]) == 0


def _only(flat: np.ndarray, starts: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ids of which those that aren't good are empty."""
    sizes = np.diff(starts)
    if good.all():
        return flat, starts
    return flat[np.repeat(good, sizes)], np.concatenate([[0], np.cumsum(np.where(good, sizes, 0))])


def _digits(n: int) -> np.ndarray:
    """Each number under ``n`` in decimal digits, from the second of eight bytes on; the first is left for a separator."""
    return np.array([f"\0{i}" for i in range(n)], "S8").view("<u8")


@functools.lru_cache(maxsize=2)
def load(path_a: str, path_b: str) -> Tokenizers:
    """Both tokenizers, once for each worker process."""
    return Tokenizers(path_a, path_b)


def diagonals(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many elements of two sorted arrays come first in their merge, for each multiple of ``piece`` and the end.

    Of equal elements that of ``a`` comes first. All diagonals are searched at once, each by halving.
    """
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, piece), total)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        more = a[np.minimum(mid, len(a) - 1)] <= b[np.clip(d - mid - 1, 0, len(b) - 1)]
        low, high = np.where(open_ & more, mid + 1, low), np.where(open_ & ~more, mid, high)
    return low, d - low


def piece_of_merge(a: np.ndarray, b: np.ndarray, i: slice, j: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of a piece of the merge as (tokens of a, tokens of b), and the tokens of either side that end together.

    Each end of ``a`` closes one overlap, and so does each end of ``b`` that no end of ``a`` equals. An equal
    end of ``a`` may be the last of the piece before.
    """
    own_a, own_b = a[i], b[j]
    beside_a = j.start + np.searchsorted(own_b, own_a, "left")
    beside_b = i.start + np.searchsorted(own_a, own_b, "right")
    shared = (beside_b > 0) & (a[np.maximum(beside_b - 1, 0)] == own_b)
    at_a, at_b = np.arange(i.start, i.stop), np.arange(j.start, j.stop)
    return np.concatenate([at_a, beside_b[~shared]]), np.concatenate([beside_a, at_b[~shared]]), beside_b[shared] - 1, at_b[shared]


def merged(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All pieces of the merge of two rows of ends, which must have their last end in common."""
    if not len(a):
        return (np.zeros(0, np.int64),) * 4
    i, j = (x.tolist() for x in diagonals(a, b, piece))
    parts = [piece_of_merge(a, b, slice(i[k], i[k + 1]), slice(j[k], j[k + 1])) for k in range(len(i) - 1)]
    return tuple(np.concatenate(x) for x in zip(*parts))


def groups_text(ids: tuple[np.ndarray, np.ndarray], shared: tuple[np.ndarray, np.ndarray], digits: list[np.ndarray]) -> np.ndarray:
    """Eight bytes for each token, in the order of the groups: a separator, the id's decimal digits, zeros.

    Within a group the tokens of A come first. ``shared`` are the tokens of either side that end each group.
    """
    out = np.empty(len(ids[0]) + len(ids[1]), "<u8")
    firsts = [np.concatenate([[0], s[:-1] + 1]) for s in shared]
    for side, first_mark in ((0, b";"), (1, b"|")):
        n = len(ids[side])
        group = np.searchsorted(shared[side], np.arange(n), "left")
        before = firsts[1][group] if side == 0 else shared[0][group] + 1
        mark = np.full(n, b","[0], "<u8")
        mark[firsts[side]] = first_mark[0]
        out[np.arange(n) + before] = digits[side][ids[side]] | mark
    return out


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the rows, and where each row starts and the last one ends."""
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)])
    return np.fromiter(itertools.chain.from_iterable(rows), np.int64, int(starts[-1])), starts


def _list(values: np.ndarray | pa.Array, kind: pa.DataType) -> pa.ListArray:
    values = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def align_block(both: Tokenizers, number: int, doc_ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
    """One row for a block of texts: each one's counts and hash, and its different pairs of ids by their place among the block's."""
    (a, a_at), (b, b_at) = both.ids(texts)
    n = len(texts)
    ends = [np.cumsum(both.sizes[0][a]), np.cumsum(both.sizes[1][b])]
    link_a, link_b, shared_a, shared_b = merged(*ends)
    doc_of_a = np.repeat(np.arange(n), np.diff(a_at))
    wide = len(both.bytes_b)
    keys, times = np.unique((doc_of_a[link_a] * len(both.bytes_a) + a[link_a]) * wide + b[link_b], return_counts=True)
    pairs, codes = np.unique(keys % (len(both.bytes_a) * wide), return_inverse=True)
    doc_of_key = keys // (len(both.bytes_a) * wide)
    printed = groups_text((a, b), (shared_a, shared_b), both.digits) if len(a) else np.zeros(0, "<u8")
    place = a_at + b_at
    hashes = [hashlib.sha256(printed[s:e].tobytes().translate(None, b"\0")[1:]).hexdigest() if e > s else "" for s, e in zip(place.tolist(), place[1:].tolist())]
    per_doc = [np.diff(a_at), np.diff(b_at), np.bincount(doc_of_a[shared_a], minlength=n), np.bincount(doc_of_a[link_a], minlength=n)]
    counted = np.bincount(codes, weights=times, minlength=len(pairs)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()), _list(doc_ids, pa.int64()), *(_list(x, pa.int64()) for x in per_doc), _list(pa.array(hashes, pa.string()), pa.string()),
            _list(np.bincount(doc_of_key, minlength=n).astype(np.int32), pa.int32()), pa.array([codes.astype("<u2" if len(pairs) <= 1 << 16 else "<u4").tobytes()], pa.binary()),
            pa.array([times.astype("<u2" if times.max(initial=0) < 1 << 16 else "<u8").tobytes()], pa.binary()),
            _list((pairs // wide).astype(np.int32), pa.int32()), _list((pairs % wide).astype(np.int32), pa.int32()), _list(counted, pa.int64()),
        ],
        names=[c.split()[0] for c in BLOCKS.split(", ")],
    )


def _numbers(raw: bytes, n: int, kinds: dict[int, str]) -> np.ndarray:
    """Numbers of whichever width ``raw`` gives ``n`` of them."""
    return np.frombuffer(raw, kinds[len(raw) // n] if n else "<u2")


def _with_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents from blocks, to which the corpus' count of each pair and whether it is its B id's highest have come."""
    for batch in batches:
        for row in range(batch.num_rows):
            block = {name: batch[name][row] for name in batch.schema.names}
            sizes = block["sizes"].values.to_numpy()
            n = int(sizes.sum())
            codes = _numbers(block["codes"].as_py(), n, {2: "<u2", 4: "<u4"})
            times = _numbers(block["times"].as_py(), n, {2: "<u2", 8: "<u8"}).astype(np.int64)
            counts, best = np.zeros(len(block["pair_a"].values), np.int64), np.zeros(len(block["pair_a"].values), np.int64)
            if block["known"].is_valid:
                known = block["known"].values
                at = known.field("at").to_numpy()
                counts[at], best[at] = known.field("count").to_numpy(), known.field("best").to_numpy(zero_copy_only=False)
            until = np.concatenate([[0], np.cumsum(sizes)])
            sums = [np.concatenate([[0], np.cumsum(times * x[codes])])[until] for x in (best, counts)]
            out = [block[c].values for c in COUNTS] + [pa.array(np.diff(s), pa.int64()) for s in sums] + [block["groups_sha256"].values]
            yield pa.RecordBatch.from_arrays(out, names=[*COUNTS, "n_best", "count_sum", "groups_sha256"])


def blocks_of(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The texts of (doc_id, text) aligned, a row for each block of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number = load(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in smaller_batches(batch, "text", BLOCK_BYTES):
                yield align_block(both, number, piece["doc_id"], piece["text"].to_pylist())
                number += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, BLOCKS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, count, best) for each pair of ids that a link holds: links over all blocks, and whether no pair of this B id has more."""
    each = blocks.select(F.explode(F.arrays_zip("pair_a", "pair_b", "pair_n")).alias("p")).select(F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"), F.col("p.pair_n").alias("n"))
    counts = each.groupBy("a", "b").agg(F.sum("n").alias("count"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Align tokenizers A and B over each whole text.

    Returns a row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. A null
    or empty text, and one whose joined tokens differ from it after a space on either side, has no tokens: zeros and ''.
    Repeated rows count as often as they are there; a null doc_id stays null; other columns are ignored; an empty
    table gives an empty one. Both vocabularies must be readable at their paths on each executor.
    """
    blocks = spooled(blocks_of(docs, path_a, path_b), "alignment")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("pair_a", "pair_b")).alias("at", "p")).select("block", "at", F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"))
    # a pair has a row for each block at most, and a block has as many as it has pairs: neither grows with a hot pair's links
    known = pairs.join(pair_counts(blocks), ["a", "b"]).groupBy("block").agg(F.collect_list(F.struct("at", "count", "best")).alias("known"))
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return blocks.join(known, "block", "left").select("*").mapInArrow(_with_counts, schema)
