"""Operators on single texts against brute force: secrets, tokens, quality counts, licenses."""

import base64
import hashlib
import random
import time
import re
import uuid
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from runlake.llm import byte_bpe, learning, license_scan, quality_mil, quality_rules, secret_scan, text_features

from .conftest import prose

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
BPE = byte_bpe.load(VOCABULARY, public_tokenizers.PATTERN)
PLAIN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}, special_tokens={})


def texts_of(df):
    return Counter((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect())


def ids(text):
    return list(memoryview(BPE.encode_packed(text)).cast("I"))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcdeinorst'  \n\t09$é日\x1c\x85\xa0²½Ⅷ"), st.characters(codec="utf-8")), max_size=60))
def test_tokens_are_those_of_the_library(text):
    assert ids(text) == PLAIN.encode_ordinary(text)
    assert BPE.decode_packed(BPE.encode_packed(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9_000, "\n" * 2_000, " " * 3_000 + "x", "<|endoftext|>"])
def test_long_runs(text):
    assert ids(text) == PLAIN.encode_ordinary(text)


def test_a_token_that_no_merges_make():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"xy": 257, b"xyz": 258}
    own = byte_bpe.ByteBpe(ranks, r"\S+|\s+")
    public = tiktoken.Encoding("odd", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abc", "abcd", "xyz", "xyzabc", "abc xyz  abcabc", "xy"):
        assert list(memoryview(own.encode_packed(text)).cast("I")) == public.encode_ordinary(text)


def test_encoding_of_a_table(odd, empty):
    rows = byte_bpe.encode_texts(odd, VOCABULARY, public_tokenizers.PATTERN, ids=True).collect()
    packed = lambda t: b"".join(i.to_bytes(4, "little") for i in PLAIN.encode_ordinary(t))
    want = Counter({(i, len(packed(t)) // 4, hashlib.sha256(packed(t)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()): n for (i, t), n in texts_of(odd).items()})
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    assert all(r.round_trip and len(r.token_ids) == r.n_tokens for r in rows)
    assert byte_bpe.encode_texts(empty, VOCABULARY, public_tokenizers.PATTERN).count() == 0


def plain_spans(text):
    assign = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "Api_KEY", "apikey", "TOKEN", "ſecret", "=", ": ", '"', "'", " ", "AKIA", "ABCDEFGH1234", "deadbeef01", "é", "\n", "/", "abc", "-"]), max_size=25))
def test_base_spans(parts):
    text = "".join(parts)
    base, spans = secret_scan.scan(text)
    assert base == plain_spans(text) and set(base) <= set(spans)


@pytest.mark.parametrize("token", ["Xk29fLq8Zr04TbVw7NcY", "c2VjcmV0LXRva2VuLXZhbHVlLTEyMzQ1Njc4", "q9ZpT4rX7mK2wB8nV5cJ1hG6"])
def test_random_tokens_are_found(token):
    text = f"we keep {token} here"
    assert secret_scan.scan(text)[1] == [(8, 3, 8 + len(token))]


@pytest.mark.parametrize("token", ["internationalization", "abcdefghijklmnopqrstuvwxyz0123456789", "node_modules/package/dist/index", "aaaaaaaaaaaaaaaaaaaa", "=" * 30, "thanbleshaningtionnt", "someVariableNameInCamelCase", "2024-01-01-2024-01-01"])
def test_ordinary_tokens_are_left_alone(token):
    assert secret_scan.scan(f"we keep {token} here")[1] == []


@pytest.mark.parametrize("name", ["aws_access", "sig", "AccountKey", "export SIGNING_SALT", "?x", "a_rather_long_configuration_name"])
@pytest.mark.parametrize("value", ["wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "Xk29fLq8Zr04TbVw7NcY", "q9ZpT4rX7mK2wB8nV5cJ1hG6==", "c2VjcmV0LXRva2VuLXZhbHVlLTEyMzQ1Njc4"])
def test_random_values_of_any_name_are_found(name, value):
    text = f"{name}={value}; rest"
    assert secret_scan.scan(text)[1] == [(len(name) + 1, 3, len(name) + 1 + len(value))]
    assert secret_scan.redacted(text, secret_scan.scan(text)[1], "*") == f"{name}=*; rest"


@pytest.mark.parametrize("before, key, after", [("/files/of-users/", "Xk29fLq8Zr04TbVw7NcY", ""), ("/file/d/", "1aB9xQ-7kLmZ2_pR4tVw8YcN3sD6", "/edit"), ("my-bucket-", "wJalrXUtnFEMI/K7MDENG+bPxRfiCY8Qz", ""), ("some_dir/other-dir/", "q9ZpT4rX7mK2wB8nV5cJ1hG6", "==")])
def test_random_parts_of_mixed_tokens_are_found(before, key, after):
    ((start, kind, end),) = secret_scan.scan(f"see {before}{key}{after} here")[1]
    assert kind == 3 and start <= 4 + len(before) and 4 + len(before + key) <= end


@pytest.mark.parametrize("text", ["mode=internationalization", "path=node_modules/some-package/dist/index", "a_very_long_variable_name=another_very_long_name", "first-part/second_part/third-part/index", "x" * 20 + "=" * 30 + "y" * 20])
def test_ordinary_values_and_mixed_tokens_are_left_alone(text):
    assert secret_scan.scan(text)[1] == []


def test_false_discoveries_are_held_to_their_rate():
    rng = random.Random(3)
    letters, weights = zip(*secret_scan.PROSE.items())
    words = ["".join(rng.choices(letters, weights, k=rng.randint(16, 40))) for _ in range(3000)]
    assert secret_scan.scan(" ".join(words))[1] == []
    secrets = ["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=32)) for _ in range(200)]
    assert sum(bool(secret_scan.scan(f"a {s} b")[1]) for s in secrets) >= 195


@pytest.mark.parametrize("name, letters", secret_scan.ALPHABETS)
def test_recall_of_random_tokens_by_encoding_and_length(name, letters):
    rng = random.Random(name)
    for n, least in ((16, 0.88 if name.lower() == "hex" else 0.82), (20, 0.9), (24, 0.94), (32, 0.96), (64, 0.97)):
        tokens = ["".join(rng.choices(letters, k=n)) for _ in range(250)]
        found = sum(any(min(e, 8 + n) - max(s, 8) >= 0.8 * n for s, _, e in secret_scan.scan(f"we keep {t} here")[1]) for t in tokens)
        assert found >= least * len(tokens), (n, found)


IDENTIFIERS = "getUserAccountBalanceById2024 AbCdEfGhIjKlMnOpQrStUvWxYz XMLHttpRequestFactoryBean 20240115T103045Z order20240115number12345 user_12345678901234567890 INV-2024-000123-A qwertyuiopasdfghjklzxcvbnm przedsiebiorstwami Rindfleischetikettierungsueberwachungsaufgabe A1B2C3D4E5F6G7H8 1234567890abcdef MAX_BUFFER_SIZE_IN_BYTES_V2 https/www/example/com/index/html/2024/05/17 iPhone15ProMax256GB model_checkpoint_epoch_12_step_3400 img_20230412_153022_HDR test_case_017_should_return_404 x86_64-unknown-linux-gnu org/apache/spark/sql/catalyst/expressions 4713403953524564"


@pytest.mark.parametrize("token", IDENTIFIERS.split())
def test_identifiers_are_left_alone(token):
    assert secret_scan.scan(f"we keep {token} here")[1] == []


def test_names_of_pods_and_uuids_are_left_alone():
    rng = random.Random(17)
    apart = "bcdfghjklmnpqrstvwxz2456789"
    pods = [f"{rng.choice(['kubernetes-deployment', 'frontend-service-api', 'my-nginx-ingress'])}-{''.join(rng.choices(apart, k=10))}-{''.join(rng.choices(apart, k=5))}" for _ in range(400)]
    assert sum(bool(secret_scan.scan(f"see {x} here")[1]) for x in pods) <= 12
    assert not [x for _ in range(400) if secret_scan.scan(x := f"see {uuid.UUID(int=rng.getrandbits(128))} here")[1]]


def test_the_step_up_over_a_documents_parts(monkeypatch):
    """Values of parts of one length, given outright: the k largest count if the k-th is m / (k * rate) or more."""
    n = 40
    text = " ".join(f"{k:016d}" for k in range(n))
    parts = [(17 * k, 17 * k + 16) for k in range(n)]
    for seed in range(200):
        rng = random.Random(seed)
        value = {f"{k:016d}": rng.choice([0.0, rng.uniform(0, 14)]) for k in range(n)}
        monkeypatch.setattr(secret_scan, "evidence", value.__getitem__)
        ranked = sorted(value.values(), reverse=True)
        want = max((k for k in range(1, n + 1) if np.exp(ranked[k - 1]) >= n / (k * secret_scan.FALSE_RATE)), default=0)
        assert len(secret_scan.discoveries(text, parts)) == want


def test_longer_parts_and_more_finds_need_less(monkeypatch):
    monkeypatch.setattr(secret_scan, "evidence", lambda t: {"l": 9.0, "s": 9.0, "r": 30.0}.get(t[0], 0.0))
    threshold = np.log(2 / secret_scan.FALSE_RATE)
    text = "l" * 64 + " " + "s" * 16
    assert 9 + np.log(16 / 40) < threshold < 9 + np.log(64 / 40)
    assert secret_scan.discoveries(text, [(0, 64), (65, 81)]) == [(0, 64), (65, 81)]  # the second of two, at half the threshold
    monkeypatch.setattr(secret_scan, "evidence", lambda t: 8.0 if t[0] == "s" else 0.0)
    assert secret_scan.discoveries("s" * 16, [(0, 16)]) == [(0, 16)]
    assert secret_scan.discoveries("s" * 16 + " " + "w" * 16, [(0, 16), (17, 33)]) == []  # a part beside it that isn't random raises it


def test_false_discoveries_among_many_ordinary_tokens():
    """A document of ordinary long tokens with a few random ones: those are found, the others left alone."""
    rng = random.Random(11)
    found = 0
    for _ in range(50):
        tokens = ["".join(rng.choices(secret_scan.ALPHABETS[4][1], k=32)) for _ in range(3)]
        words = [w for w in IDENTIFIERS.split() for _ in range(10)]
        text = " ".join(words[:100] + tokens + words[100:])
        spans = {text[s:e] for s, _, e in secret_scan.scan(text)[1]}
        assert spans <= set(tokens)
        found += len(spans)
    assert found >= 0.95 * 150


def test_a_token_of_very_many_parts_takes_time_in_proportion():
    rng = random.Random(19)
    text = "-".join("".join(rng.choices(secret_scan.ALPHABETS[4][1], k=24)) for _ in range(20_000))
    start = time.monotonic()
    assert len(secret_scan.scan(text)[1]) > 19_000
    assert time.monotonic() - start < 30


def plain_random(text):
    """Random spans again, from the docstring: all cuts of each long token, each tested with sums over symbols."""
    from itertools import groupby
    from statistics import NormalDist

    normal, log = NormalDist(), np.log
    alphabets = [a for _, a in secret_scan.ALPHABETS]
    kind = lambda ch: "d" if ch in "0123456789" else "l" if ch.islower() else "u" if ch.isupper() else "x"

    def level(values):
        x = np.array(values, dtype=float) - np.mean(values)
        return 0.0 if not (x * x).sum() else 2 * (1 - normal.cdf(abs((x[1:] * x[:-1]).sum() / (x * x).sum()) * np.sqrt(len(x))))

    def evidence(token):
        letters = next(a for a in alphabets if set(token) <= set(a))
        size, n, kinds = len(letters), len(token), list(map(kind, token))
        if not set(kinds) & {"l", "u"}:
            return 0.0
        known = [kind(ch) for ch in letters if kind(ch) != "x"]
        share = {k: known.count(k) / len(known) for k in "dlu"}
        changed = 1 - sum(v * v for v in share.values()) - share["u"] * share["l"]
        pairs = [(a, b) for a, b in zip(kinds, kinds[1:]) if "x" not in (a, b)]
        changes = sum(a != b and (a, b) != ("u", "l") for a, b in pairs)
        counts = Counter(token)
        chi = sum((counts[ch] - n / size) ** 2 for ch in letters) * size / n
        small = 2 / (9 * (size - 1))
        folded = "abcdefghijklmnopqrstuvwxyz0123456789+/-_"
        levels = [1 - normal.cdf(((chi / (size - 1)) ** (1 / 3) - 1 + small) / np.sqrt(small)), level([letters.index(ch) for ch in token]), level([folded.index(ch.lower()) for ch in token])]
        if pairs:
            levels.append(normal.cdf((changes - len(pairs) * changed) / np.sqrt(len(pairs) * changed * (1 - changed))))
        if min(levels) < 1e-3:
            return 0.0
        doubt = min(levels) * len(levels)
        out = float(log(doubt / 0.05)) if doubt < 0.05 else 0.0

        def any_or_share(k, total, p):
            ways = 1
            for i in range(k):
                ways = ways * (total - i) // (i + 1)
            return float(log(float(ways)) + k * log(p) + (total - k) * log(1 - p) - log(0.5 if k == 0 else 0.5 / total))

        out += any_or_share(kinds.count("d"), n - kinds.count("x"), share["d"])
        if len(known) < size:
            out += any_or_share(kinds.count("x"), n, 1 - len(known) / size)
        if share["l"] and share["u"]:
            out += any_or_share(kinds.count("u"), kinds.count("u") + kinds.count("l"), 0.5)
        used = Counter(ch.lower() for ch in letters if ch.isalpha())
        prose = sum(secret_scan.PROSE[ch] for ch in used)
        of_alphabet = sum(log(used[ch.lower()] / used.total() * prose / secret_scan.PROSE[ch.lower()]) for ch in token if ch.isalpha())
        of_any = sum(log(used[ch.lower()] / used.total() * sum(secret_scan.PROSE.values()) / secret_scan.PROSE[ch.lower()]) for ch in token if ch.isalpha())
        out += float(log((np.exp(of_alphabet) + np.exp(of_any)) / 2))
        out += changes * log(changed / 0.06) + (len(pairs) - changes) * log((1 - changed) / 0.94)
        follows = {"vv": 0.3, "vc": 1.45, "cv": 1.5, "cc": 0.68}
        for word, own in groupby(token, str.isalpha):
            sounds = ["v" if ch.lower() in "aeiou" else "c" for ch in own] if word else []
            out -= sum(log(follows[a + b]) for a, b in zip(sounds, sounds[1:]))
        return max(0.0, out)

    family = set()
    base = plain_spans(text)
    for m in re.finditer(r"[A-Za-z0-9+/_-]{16,}(?:={1,6}(?![A-Za-z0-9+/_=-]))?", text):
        if any(s < m.end() and e > m.start() for s, _, e in base):
            continue
        family |= {(m.start(), m.end())} | {(m.start() + p.start(), m.start() + p.end()) for cut in ("[^+/]+", "[^_-]+", "[^+/_-]+") for p in re.finditer(cut, m[0]) if len(p[0]) >= 16}
    mean = np.mean([e - s for s, e in family]) if family else 0
    ranked = sorted((-(evidence(text[s:e].rstrip("=")) if len(text[s:e].rstrip("=")) >= 16 else 0.0) - log((e - s) / mean), s, e) for s, e in family)
    k = next((k for k in range(len(ranked), 0, -1) if np.exp(-ranked[k - 1][0]) * k * 5e-4 >= len(ranked)), 0)
    taken = []
    for _, s, e in ranked[:k]:
        if not any(s < b and e > a for a, b in taken):
            taken.append((s, e))
    return sorted((s, 3, e) for s, e in taken)


def test_random_spans_are_those_of_a_plain_battery(spark):
    rng = random.Random(12)
    rows = []
    for k in range(300):
        words = []
        for _ in range(12):
            letters = rng.choice(secret_scan.ALPHABETS)[1]
            token = "".join(rng.choices(letters, k=rng.choice([12, 16, 18, 24, 40])))
            words.append(rng.choice([token, token, rng.choice(IDENTIFIERS.split()), f"name={token}", f"/some/path/{token}/x", f"my-{token}_b", token + "==", "secret: " + token]))
        rows.append((k, " ".join(words)))
    got = {r.doc_id: r.spans for r in secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    n = 0
    for k, text in rows:
        own = plain_random(text)
        n += len(own)
        assert got[k] == secret_scan.written(sorted(plain_spans(text) + own)), text
    assert n > 1000


def test_secrets_of_a_table(odd, empty):
    rows = secret_scan.find_secrets(odd).collect()
    want = Counter()
    for (i, t), n in texts_of(odd).items():
        base = plain_spans(t)
        kinds = [k for _, k, _ in base]
        digest = hashlib.sha256(",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest()
        want[(i, *(kinds.count(k) for k in range(3)), digest)] += n
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows) == want
    assert secret_scan.find_secrets(empty).count() == 0


def test_masking(spark):
    df = spark.createDataFrame([(1, "a token = abcdefgh12 b", 22), (2, "plain", 99), (3, None, None)], "doc_id long, text string, n_chars int")
    assert [tuple(r) for r in secret_scan.redact_secrets(df).orderBy("doc_id").collect()] == [(1, "a [SECRET] b", 12), (2, "plain", 99), (3, None, None)]


def plain_counts(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in text), len(lines) - len(set(lines)), len(covered)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "cé", "#", "日", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\xa0", "|"]), max_size=60))
def test_quality_counts(parts):
    assert quality_rules.counts("".join(parts)) == plain_counts("".join(parts))


def test_quality_of_a_table(odd, empty, labels):
    rows = quality_rules.judge(odd, labels).collect()
    want = Counter({(i, *plain_counts(t)): n for (i, t), n in texts_of(odd).items()})
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed) for r in rows)
    assert quality_rules.judge(empty, labels).count() == 0
    without = quality_rules.judge(odd, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in without)
    assert quality_rules.keep_good(odd, labels.limit(0)).count() == sum(r.kept for r in without)


def test_the_sample_has_its_bound_whatever_repeats(spark):
    docs = spark.createDataFrame([(i % 3, f"text {i % 7}", "x") for i in range(3000)] + [(50, None, "y"), (None, "z", "z")], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(60)] * 2, "doc_id long, quality int, toxic int")
    rows = learning.training_rows(docs, labels, "quality", 1000).collect()
    outside = [i for i in (0, 1, 2, 50) if zlib.crc32(str(i).encode()) % 5 != 0]
    assert sorted((r.doc_id, r.label, r.text) for r in rows) == [(i, i % 2, "" if i == 50 else "text 0") for i in outside]
    assert len(learning.training_rows(docs, labels, "quality", 1).collect()) <= 1


def plain_hashes(units, mask=(1 << 64) - 1):
    return sum((ord(ch) + 1) * pow(0x100000001B3, i, 1 << 64) for i, ch in enumerate(units)) * 0x9E3779B97F4A7C15 & mask


def plain_features(text, bits):
    """Word, word-pair and character features, counted one by one."""
    full, prime, mix = (1 << 64) - 1, 0x100000001B3, 0x9E3779B97F4A7C15
    at = lambda h: ((h * mix) & full) >> (64 - bits)
    words = [plain_hashes(w) for w in re.findall("[^\x20\x09-\x0d]+", text)]
    out = [Counter(map(at, words)) + Counter(at((a * prime + b) & full) for a, b in zip(words, words[1:])), Counter()]
    for n in (3, 4):
        for i in range(len(text) - n + 1):
            h = ord(text[i]) + n
            for ch in text[i + 1 : i + n]:
                h = (h * prime + ord(ch)) & full
            out[1][at(h)] += 1
    rows = [np.array([np.log1p(c[k]) for k in range(1 << bits)]) for c in out]
    return np.concatenate([r / max(np.sqrt((r * r).sum()), 1e-6) for r in rows])


CUT = st.lists(st.sampled_from(["a", "bc", "é", "日本", " ", "  ", "\n", "\x1f", "\U0001f600", "word "]), max_size=60).map("".join)


@settings(max_examples=60, deadline=None)
@given(CUT, st.sampled_from([1, 2, 3, 7, 1 << 16]))
def test_features_are_the_plain_ones_wherever_the_text_is_cut(text, piece):
    kept, text_features.PIECE = text_features.PIECE, piece
    try:
        assert np.allclose(text_features.document(text, 6), plain_features(text, 6), atol=1e-5)
        rows = np.concatenate(list(text_features.passages(text, 5, 4)))
    finally:
        text_features.PIECE = kept
    assert np.array_equal(rows, np.concatenate(list(text_features.passages(text, 5, 4))))
    words = re.findall("[^\x20\x09-\x0d]+", text)
    assert len(rows) == max(1, -(-len(words) // 4))
    for k in range(0, len(words), 4):
        own = words[k : k + 4]
        pairs = list(zip(own, own[1:]))
        shape = [len(set(own)) / len(own), sum(a == b for a, b in pairs) / max(1, len(pairs)), len(set(pairs)) / max(1, len(pairs)), len(own) / 4, np.log1p(len(own)) / 5]
        assert np.allclose(rows[k // 4, -5:], shape, atol=1e-5)


def test_a_long_text_has_the_features_of_one_piece(monkeypatch):
    text = prose(4, 60_000)
    assert len(text) > 300_000
    cut = text_features.document(text, 9), np.concatenate(list(text_features.passages(text, 6, 128)))
    monkeypatch.setattr(text_features, "PIECE", len(text))
    for name, base in (("_FORTH", 0x100000001B3), ("_BACK", pow(0x100000001B3, -1, 1 << 64))):
        monkeypatch.setattr(text_features, name, text_features._powers(base))
    assert np.array_equal(cut[0], text_features.document(text, 9)) and np.allclose(cut[1], np.concatenate(list(text_features.passages(text, 6, 128))))


def test_all_passages_of_a_long_text_teach():
    assert len(quality_mil.encode(prose(4, 30_000))) == -(-30_000 // quality_mil.PASSAGE)
    assert len(quality_mil.encode("")) == 1 and len(quality_mil.encode(prose(4, 300))) == 3


def test_labels_of_other_documents_do_not_count(spark):
    docs = spark.range(200).selectExpr("id * 7 AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(200_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality", "0 AS toxic")
    outside = [7 * i for i in range(200) if zlib.crc32(str(7 * i).encode()) % 5 != 0]
    assert sorted(r.doc_id for r in learning.training_rows(docs, labels, "quality", 3000).collect()) == outside
    first = [r.doc_id for r in learning.training_rows(docs, labels, "quality", 20).collect()]
    least = spark.createDataFrame([(i,) for i in outside], "doc_id long").selectExpr("doc_id", "shiftrightunsigned(xxhash64(doc_id), 50) AS part", "xxhash64(doc_id) AS h").orderBy("part", "h").limit(20)
    assert sorted(first) == sorted(r.doc_id for r in least.collect())


def test_verdicts_are_those_of_a_plain_score(spark, odd, labels):
    model = quality_rules.train(odd, labels)
    assert model is not None
    w, slope, offset = model
    for r in quality_rules.judge(odd, labels).join(odd.select("doc_id", "text").distinct(), "doc_id").collect():
        if len(r.text or "") > 5000:
            continue
        x = plain_features(r.text or "", quality_rules.BITS)
        chance = 1 / (1 + np.exp(-(slope * (x @ w[:-1] + w[-1]) + offset)))
        assert abs(r.probability - chance) < 1e-3
        if abs(chance - 0.3) > 1e-3:
            assert r.kept == (not r.base_failed and chance >= 0.3)


def test_scores_are_those_of_a_plain_forward_pass(odd, labels):
    model = learning.fitted(learning.training_rows(odd, labels, "quality", quality_mil.SAMPLE), quality_mil.encode, quality_mil._fit)
    squash = lambda v: 1 / (1 + np.exp(-v))
    for text in [r.text or "" for r in odd.select("text").distinct().collect()]:
        x = np.concatenate(list(text_features.passages(text, quality_mil.BITS, quality_mil.PASSAGE))).astype(np.float64)
        code = np.tanh(x @ model["E"] + model["e"])
        raw = (np.tanh(code @ model["V"]) * squash(code @ model["U"])) @ model["a"]
        weight = np.exp(raw) / np.exp(raw).sum()
        want = squash(model["calibration"][0] * ((weight[:, None] * code).sum(0) @ model["c"] + model["b"][0]) + model["calibration"][1])
        got, n, _ = quality_mil.score(model, text)
        assert abs(got - want) < 1e-3 and n == len(x)


def test_gradients_of_the_attention():
    rng = np.random.default_rng(0)
    m = {k: v.astype(np.float64) for k, v in quality_mil._start().items()}
    x, bag, y = rng.random((5, len(m["E"]))), np.array([0, 2]), np.array([1.0, 0.0])
    loss = lambda: -np.mean(y * np.log(p := quality_mil.sigmoid(quality_mil.forward(m, x, bag)["score"])) + (1 - y) * np.log(1 - p))
    got = quality_mil.gradients(m, x, bag, y, np.ones(2))
    for name in ("E", "V", "U", "a", "c", "b"):
        at = tuple(0 for _ in m[name].shape)
        kept, step = m[name][at], 1e-5
        m[name][at] = kept + step
        above = loss()
        m[name][at] = kept - step
        below = loss()
        m[name][at] = kept
        assert abs((above - below) / (2 * step) - got[name][at]) < 1e-5


def test_documents_that_are_learnt_from_are_learnt_from_whole(spark, monkeypatch):
    """The sample's bound is on rows: as many whole documents as its passages allow, and none in part."""
    docs = spark.createDataFrame([(k, "word " * (128 * (k % 7 + 1))) for k in range(60)] + [(100, "word " * 128 * 99), (101, None)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS quality")
    every = {r.doc_id for r in quality_mil.taught(docs, labels, 3000).collect()}
    assert len(every) > 40
    monkeypatch.setattr(quality_mil, "SAMPLE_PASSAGES", 40)
    kept = quality_mil.taught(docs, labels, 3000).collect()
    sizes = [len(quality_mil.encode(r.text)) for r in kept]
    assert 30 <= sum(sizes) <= 40 and 100 not in {r.doc_id for r in kept} and {r.doc_id for r in kept} < every
    assert all(n == max(1, -(-len((r.text or "").split()) // 128)) for r, n in zip(kept, sizes))
    assert sorted(r.doc_id for r in quality_mil.taught(docs.repartition(7), labels, 3000).collect()) == sorted(r.doc_id for r in kept)


def test_scores_of_a_table(odd, empty, labels):
    import zlib

    rows = quality_mil.score_quality(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert quality_mil.score_quality(empty, labels).count() == 0
    assert {r.score for r in quality_mil.score_quality(odd, labels.limit(0)).collect()} == {0.5}


DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_mil.score_quality(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.9
    rows = quality_rules.judge(docs, labels).join(labels, "doc_id").filter("not base_failed and pmod(crc32(cast(doc_id as string)), 5) = 0").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) / len(rows) > 0.9


@pytest.mark.parametrize("line, name", [("Released under the MIT License.", "MIT"), ("# licensed under the apache license, version 2.0", "Apache-2.0"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"), ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"), ("She renewed her driving licence before the holiday.", None), ("Copyright is a difficult subject.", None)])
def test_notices_are_told_apart(line, name):
    got = license_scan.licence(line)
    assert (got and got[0]) == name


def test_licenses_of_a_table(spark, odd, empty):
    rows = {r.doc_id: r for r in license_scan.find_licenses(odd.unionByName(spark.createDataFrame([(900, "é first\nReleased under the MIT License.\nlast")], "doc_id long, text string"), allowMissingColumns=True)).collect()}
    assert rows[900].spans == "MIT:8:39" and rows[900].licenses == "MIT" and rows[100].n_found == 0
    assert license_scan.find_licenses(empty).count() == 0

WRAPPED = {
    "MIT": 'MIT License\n\nCopyright (c) 2020 Someone\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction',
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n",
    "BSD-3-Clause": "Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n",
    "CC0-1.0": "Dedicated to the public\ndomain under CC0 1.0.",
}


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "-- "])
@pytest.mark.parametrize("name", WRAPPED)
def test_notices_over_lines_are_found(name, mark):
    text = "def f():\n    return 1\n" + "".join(f"{mark}{line}\n" for line in WRAPPED[name].split("\n")) + "the code goes on"
    _, found = license_scan.notices(text)
    assert [x[2] for x in found] == [name] and text[found[0][0] : found[0][1]].count("\n") >= 1


def plain_fits(have, want, most):
    """For each end: the least number of words to drop from a stretch and from ``want`` to make them equal."""

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for i, y in enumerate(b, 1):
                row[i] = last[i - 1] + 1 if x == y else max(last[i], row[i - 1])
        return row[-1]

    for j in range(1, len(have) + 1):
        differ, short, s = min((j - s + len(want) - 2 * common(have[s:j], want), j - s, s) for s in range(j + 1))
        if differ <= most:
            yield differ, s, j


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(1, 4), min_size=1, max_size=6), st.integers(0, 4))
def test_fits_are_those_of_all_stretches(have, want, most):
    assert license_scan.fits(have, want, most) == list(plain_fits(have, want, most))


@pytest.mark.parametrize("around", [("", ""), ("x " * 1500, " y" * 1500), ("no stop " * 400, ""), ("z" * 5000 + " ", "")])
@pytest.mark.parametrize("notice, names", [("Released under the MIT License. Licensed under the Apache License, Version 2.0.", ["MIT", "Apache-2.0"]), ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ["MPL-2.0"]), ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]), (" and ".join(["Licensed under CC BY 4.0.", "Licensed under CC BY-SA 4.0.", "Dedicated to the public domain under CC0 1.0.", "Released under the BSD 2-Clause License.", "Released under the MIT License."]), ["CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "BSD-2-Clause", "MIT"])])
def test_notices_do_not_depend_on_the_length_of_a_line(around, notice, names):
    found = license_scan.notices(around[0] + notice + around[1])[1]
    assert [x[2] for x in found] == names
    assert [(s - len(around[0]), e - len(around[0])) for s, e, *_ in found] == [(s, e) for s, e, *_ in license_scan.notices(notice)[1]]


def test_notices_are_found_across_every_cut(monkeypatch):
    text = " and ".join(f"word {k} Released under the MIT License. It is licensed under CC BY 4.0. Copyright" for k in range(30))
    want = license_scan.notices(text)
    assert len(want[1]) == 60
    for size in (1, 7, 50):
        monkeypatch.setattr(license_scan, "AT_ONCE", size)
        assert license_scan.notices(text) == want


FULL = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons\nAttribution-NonCommercial-ShareAlike 4.0 International License.",
    "BSD-3-Clause": "Copyright (c) 2019, The Authors\nAll rights reserved.\n\n" + license_scan._MAY_USE + "\n\n1. " + license_scan._RETAIN + "\n\n3. " + license_scan._NO_NAMES.replace("the copyright holder", "The Example Project") + "\n\n" + license_scan._NO_WARRANTY,
    "BSD-2-Clause": license_scan._MAY_USE + "\n * " + license_scan._RETAIN + "\n\n" + license_scan._NO_WARRANTY,
    "MIT": "MIT License\n\nCopyright (c) 2021 A. Person\n\n" + license_scan._GRANT,
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS"',
    "Apache-2.0": license_scan._APACHE + "\n\n    " + license_scan._APACHE_REST,
}


@pytest.mark.parametrize("name", FULL)
def test_full_notices_give_one_license(name):
    found = license_scan.notices(f"some words first\n{FULL[name]}\nthen the text goes on and on")[1]
    assert [x[2] for x in found] == [name]


@pytest.mark.parametrize("text", ["Licensed under CC BY-XX 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 International License.", "A licence to kill is no license to use.", "This work is licensed under the GNU General Public License, version 5."])
def test_like_wordings_of_other_licenses_are_left_alone(text):
    assert license_scan.notices(text)[1] == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, len(license_scan._FITTED) - 1), st.integers(0, 30), st.lists(st.integers(0, 12), max_size=3)), min_size=1, max_size=3), st.randoms(use_true_random=False))
def test_every_template_is_fitted_to_every_stretch(parts, rng):
    """Against all templates over all words, without looking first for where one may fit."""
    words = []
    for k, start, out in parts:
        own = license_scan._FITTED[k][2][start : start + 25]
        words += [rng.choice([0, 0, 7, 12]) for _ in range(rng.randint(0, 4))] + [w for i, w in enumerate(own) if i not in out]
    got = sorted(license_scan.found_in(np.array(words, dtype=np.int32).tobytes()))
    want = []
    for k, (_, _, own, named, most) in enumerate(license_scan._FITTED):
        if len(own) - most <= len(words):
            want += [(d, k, s, e) for d, s, e in license_scan.fits(words, own, most) if named <= set(words[s:e]) and not {w for w in words[s:e] if w in license_scan._TELL} - named]
    assert got == sorted(want)


def test_the_first_in_rank_is_taken():
    """Of all fits of a text with several notices: by bytes saved less those of words that differ, never overlapping."""
    text = "x Released under the MIT License. Licensed under the Apache License, Version 2.0; you may not use this file. Licensed under CC BY-SA 4.0 y"
    starts, ends, numbers = license_scan.words_of(text)
    ranked = []
    for d, k, a, e in license_scan.found_in(numbers.tobytes()):
        stretch = text[starts[a] : license_scan._STOP.match(text, ends[e - 1]).end()]
        gain = license_scan.saved(stretch, k)
        if gain > 0:
            ranked.append((6 * d - gain, d, license_scan._FITTED[k][0], a, e))
    taken = []
    for _, _, name, a, e in sorted(ranked):
        if all(e <= s or a >= t for s, t, _ in taken):
            taken.append((a, e, name))
    assert [x[2] for x in license_scan.notices(text)[1]] == [n for *_, n in sorted(taken)] == ["MIT", "Apache-2.0", "CC-BY-SA-4.0"]


_EVIL = license_scan._GRANT.replace("THE SOFTWARE IS PROVIDED", "The Software shall be used for Good, not Evil. THE SOFTWARE IS PROVIDED")


@pytest.mark.parametrize("text, names", [
    (license_scan._MIT_0, ["MIT-0"]),
    ("MIT No Attribution\n\nCopyright A. Person\n\n" + license_scan._MIT_0, ["MIT-0"]),
    (f"{license_scan._MAY_USE} {license_scan._RETAIN} {license_scan._ADVERTISING} {license_scan._NO_NAMES} {license_scan._NO_WARRANTY}", ["BSD-4-Clause"]),
    (_EVIL, []),  # a clause of nine words makes it another license, whose first words don't make it the one again
    ("# SPDX-License-Identifier: MIT", ["MIT"]),
    ("// SPDX-License-Identifier: GPL-3.0-or-later", ["GPL-3.0"]),
    ("license = 'LGPL-2.1-only'", ["LGPL-2.1"]),
    ("License: Apache-2.0", ["Apache-2.0"]),
    ("MIT License\n\nCopyright (c) 2021 A. Person", ["MIT"]),
    ("Apache License\n  Version 2.0, January 2004", ["Apache-2.0"]),
    ("It has no license. MIT researchers said so.", []),
    ("SPDX-License-Identifier: GPL-4.0", []),
    ("Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation\nLicense, Version 1.3 or any later version published by the Free Software Foundation; with no Invariant Sections", ["GFDL-1.3"]),
])
def test_near_relatives_and_statements(text, names):
    assert [x[2] for x in license_scan.notices(f"before\n{text}\nafter")[1]] == names


def test_every_template_has_a_sign_and_is_itself():
    """No template is passed over, and each full wording of a license is that license's."""
    for name, texts in license_scan.TEMPLATES.items():
        for text in texts:
            assert license_scan._SIGN.search(text), text
            assert {x[2] for x in license_scan.notices(text)[1]} == {name}, text


def test_a_page_of_legal_words_takes_a_second():
    """Words of all templates in no order, twenty thousand of them, and forty texts of one license."""
    words = [w for texts in license_scan.TEMPLATES.values() for t in texts for w in t.split()]
    page = " ".join(random.Random(3).choices(words, k=20_000))
    for text, most in ((page, 3), ("\n".join(f"file {k}\n{license_scan._GRANT}" for k in range(40)), 3)):
        began = time.monotonic()
        license_scan.notices(text)
        assert time.monotonic() - began < most


def test_licenses_of_a_table_are_those_of_its_texts(odd):
    rows = license_scan.find_licenses(odd).collect()
    want = Counter()
    for (i, t), n in texts_of(odd).items():
        blocks, found = license_scan.notices(t)
        want[(i, blocks, len(found), ",".join(sorted({f[2] for f in found})), ",".join(f"{f[2]}:{f[0]}:{f[1]}" for f in found))] += n
    assert Counter((r.doc_id, r.n_blocks, r.n_found, r.licenses, r.spans) for r in rows) == want
