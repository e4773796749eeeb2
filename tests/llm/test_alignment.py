"""Alignment of two tokenizers, against all pairs of tokens of each text."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from runlake.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(texts):
    """Rows of the contract, from every pair of tokens of a text."""
    both = alignment.load(A, B)
    rows, links = [], []
    for text in texts:
        a, b = (both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)) if text else ([], [])
        joined = [b"".join(table[i] for i in ids) for table, ids in ((both.bytes_a, a), (both.bytes_b, b))]
        if not text or any(j != (" " + text).encode() for j in joined):
            rows.append((0, 0, 0, ""))
            links.append([])
            continue
        spans = []
        for table, ids in ((both.bytes_a, a), (both.bytes_b, b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(own)
        links.append([(x, y) for s, e, x in spans[0] for t, f, y in spans[1] if s < f and t < e])
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, last = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in own if last <= s and e <= cut) for own in spans))
            last = cut
        rows.append((len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(p for own in links for p in own)
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return [(na, nb, ng, len(own), sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own), sha) for (na, nb, ng, sha), own in zip(rows, links)]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def got(df):
    return sorted(((r.doc_id is None, r.doc_id or 0), *(r[c] for c in COLUMNS)) for r in df.collect())


def want(rows):
    texts = [r[1] or "" for r in rows]
    return sorted(((r[0] is None, r[0] or 0), *own) for r, own in zip(rows, brute(texts)))


TEXTS = [
    "the quick brown fox", "", None, " leading  spaces and\ttabs\r\n", "naïve café — 日本語 \U0001f600", "a ▁ b", "<0x41> <s> </s> <unk> <|endoftext|>", "\x00\x01", "Ａ fullwidth ﬁ",
    "the quick brown fox", "antidisestablishmentarianism " * 40, "0123456789 12/34", "é combining", "　wide space", "a", " ",
]


def test_every_pair_of_tokens(spark, monkeypatch):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (3, TEXTS[3])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_a string").repartition(3)
    assert got(alignment.align(df, A, B)) == want(rows)


def test_blocks_and_pieces_do_not_matter(spark, monkeypatch):
    rows = [(k, " ".join(TEXTS[(k * 7 + j) % len(TEXTS)] or "x" for j in range(k % 5 + 1))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    both = alignment.load(A, B)
    import pyarrow as pa

    whole = alignment.align_block(both, 0, pa.array([k for k, _ in rows]), [t for _, t in rows]).to_pydict()
    for piece in (1, 2, 7, 100):
        monkeypatch.setattr(alignment.merged, "__defaults__", (piece,))
        assert alignment.align_block(both, 0, pa.array([k for k, _ in rows]), [t for _, t in rows]).to_pydict() == whole
    monkeypatch.undo()
    assert got(alignment.align(df.repartition(7), A, B)) == got(alignment.align(df.coalesce(1), A, B)) == want(rows)


def test_odd_tables(spark, odd, empty):
    assert alignment.align(empty, A, B).count() == 0
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    short = [r for r in rows if len(r[1] or "") < 5000]
    out = got(alignment.align(odd, A, B))
    assert len(out) == len(rows)
    assert [r[:5] + r[7:] for r in want(short)] == [r[:5] + r[7:] for r in out if r[0][1] not in (103, 104)]
    assert got(alignment.align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), A, B)) == [((False, k), 0, 0, 0, 0, 0, 0, "") for k in (1, 2)]


sizes = st.lists(st.integers(1, 4), min_size=1, max_size=30)


@settings(max_examples=200, deadline=None)
@given(sizes, sizes, st.integers(1, 9))
def test_merge_of_ends(a, b, piece):
    short, other = sorted((a, b), key=sum)
    if sum(short) < sum(other):
        short.append(sum(other) - sum(short))
    ends = [np.cumsum(x) for x in (a, b)]
    spans = [list(zip([0, *e[:-1].tolist()], e.tolist())) for e in ends]
    links = sorted((i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e)
    la, lb, sa, sb = alignment.merged(*ends, piece)
    assert sorted(zip(la.tolist(), lb.tolist())) == links
    assert [(int(ends[0][i]), int(ends[1][j])) for i, j in zip(sa, sb)] == [(e, e) for e in sorted(set(ends[0].tolist()) & set(ends[1].tolist()))]
    low, high = alignment.diagonals(*ends, piece)
    assert {int(x) for x in np.diff(low + high)[:-1]} <= {piece}


@pytest.mark.parametrize("piece", [3, 1 << 16])
def test_ends_of_one_token(piece):
    la, lb, sa, sb = alignment.merged(np.array([5]), np.array([1, 2, 5]), piece)
    assert sorted(zip(la.tolist(), lb.tolist())) == [(0, 0), (0, 1), (0, 2)] and (sa.tolist(), sb.tolist()) == ([0], [2])


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab'sé1.\u0301  \t\n\r\x1c\x85\xa0\u180e\u200b\u2003\u3000\ufeff日<|>"), max_size=40))
def test_stretches_have_the_ids_of_the_whole(text):
    both = alignment.load(A, B)
    texts = [text, f"{text} {text}", f" the<|endoftext|> {text}", ""]
    flat, starts, same = both.stretches.ids(texts)
    assert [flat[s:e].tolist() for s, e in zip(starts, starts[1:])] == [both.a.encode(f" {t}", add_special_tokens=False).ids for t in texts]
    assert same.all()


def test_no_character_but_white_space_is_white_space_to_the_tokenizer():
    """Texts are cut before a space and a character that isn't white space, as Python has it; the tokenizer must cut there as well."""
    cut = alignment.load(A, B).a.pre_tokenizer
    for first in range(0, 0x20000, 0x1000):
        chars = [c for c in map(chr, range(first, first + 0x1000)) if not 0xD800 <= ord(c) <= 0xDFFF and not c.isspace()]
        assert "Ġ" not in {p for p, _ in cut.pre_tokenize_str("".join(f"x {c}.\n" for c in chars))}


def test_each_stretch_is_encoded_once(monkeypatch):
    """What a process keeps is bounded, and forgetting changes nothing."""

    class Counted:
        def __init__(self, real):
            self.real, self.chars = real, 0

        def encode_batch_fast(self, texts, **how):
            self.chars += sum(map(len, texts))
            return self.real.encode_batch_fast(texts, **how)

    both = alignment.Tokenizers(A, B)
    both.a = both.stretches.tokenizer = Counted(both.a)
    texts = [" ".join(f"word{k % 50}" for k in range(n)) for n in range(1, 300)]
    first = both.ids(texts)
    assert both.a.chars == sum(len(f" word{k}") for k in range(50))
    monkeypatch.setattr(alignment, "KEPT", 10)
    for known, again in zip(first, both.ids(texts)):
        assert all((x == y).all() for x, y in zip(known, again))
    assert both.a.chars == 2 * sum(len(f" word{k}") for k in range(50))
