"""Quality rules: counts over the whole text, and a calibrated classifier of hashed n-grams.

The classifier is a logistic regression over hashed words, pairs of words and runs of 3 and 4 characters.
It is trained on a bounded sample of labelled rows; one fold of that sample is kept back to calibrate its
probabilities. Texts are then scored in Arrow batches and held against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text_features
from .common import smaller_batches, text_or_empty
from .learning import calibration, fitted, sigmoid, training_rows

#: At most so many labelled rows teach the classifier: the bound of its sample.
SAMPLE = 4000
#: Features of each family are 2**BITS; a text is kept from this probability of good quality.
BITS, THRESHOLD = 11, 0.3
#: Rounds and weight of the squared penalty of the fit; the fold that calibrates.
ROUNDS, PENALTY, CALIBRATION_FOLD = 400, 1e-4, 1
LEAST_WORDS, MOST_REPEATED = 50, 50

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three words found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, count()), dtype=np.int64, count=n)
    pair = ids[:-1] * n + ids[1:]
    if n > 1 << 21:  # three ids no longer fit one key
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair[:-1] * n + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(n - 2, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    data = text.encode()
    words = data.split()
    raw = np.frombuffer(data, dtype=np.uint8)
    symbols = int(np.count_nonzero(_SYMBOL[raw]))
    chars = int(np.count_nonzero((raw & 0xC0) != 0x80)) - int(np.count_nonzero(text_features.SPACE[raw]))
    lines = [line for line in data.split(b"\n") if line.split(None, 1)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def _fit(rows: list) -> tuple[np.ndarray, float, float] | None:
    """Weights (the last is the bias), slope and offset; None where the sample lacks one of the labels."""
    x = np.stack([f for f, _, _ in rows])
    y, own = np.array([y for _, y, _ in rows], dtype=np.float32), np.array([f for _, _, f in rows]) == CALIBRATION_FOLD
    if len(set(y[~own])) < 2:
        return None
    fit, target = x[~own], y[~own]
    weight = np.where(target > 0, 0.5 / target.mean(), 0.5 / (1 - target).mean()).astype(np.float32)
    w, bias = np.zeros(x.shape[1], dtype=np.float32), np.float32(0)
    ahead, ahead_bias, step = w, bias, 1 / (0.25 * 3 * weight.max() + PENALTY)
    for k in range(ROUNDS):  # accelerated gradient descent: rows have squared length 2, and 1 for the bias
        off = weight * (sigmoid(fit @ ahead + ahead_bias) - target).astype(np.float32) / len(target)
        new, new_bias = ahead - step * (fit.T @ off + PENALTY * ahead), ahead_bias - step * off.sum()
        ahead, ahead_bias = new + (k / (k + 3)) * (new - w), new_bias + (k / (k + 3)) * (new_bias - bias)
        w, bias = new, new_bias
    back = own if len(set(y[own])) == 2 else ~own
    slope, offset = calibration((x[back] @ w + bias).astype(np.float64), y[back])
    return np.append(w, bias), slope, offset


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float, float] | None:
    return fitted(training_rows(docs, labels, "quality", sample), lambda text: text_features.document(text, BITS), _fit)


def probability(model: tuple[np.ndarray, float, float] | None, text: str) -> float:
    """The calibrated chance of good quality; 1 where no model could be trained."""
    if model is None:
        return 1.0
    w, slope, offset = model
    return float(sigmoid(slope * (text_features.document(text, BITS) @ w[:-1] + w[-1]) + offset))


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, probability.

    Whole texts are counted and scored. A null text counts as an empty one and fails for want of words.
    Without labels of both kinds there is no model (a warning says so), and the base rules alone decide, with probability 1. Repeated rows each give a
    row, a null doc_id stays null, other columns are ignored, an empty table gives an empty one.
    """
    model = train(docs, labels, sample)
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in smaller_batches(whole, "text", 8 << 20):
                rows = [_verdict(model, t.as_py(), threshold) for t in batch["text"]]
                kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=[c.split()[0] for c in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, schema)


def _verdict(model, text: str, threshold: float) -> tuple:
    found = counts(text)
    failed = found[0] < LEAST_WORDS or 100 * found[4] > MOST_REPEATED * found[0]
    chance = probability(model, text)
    return *found, failed, not failed and chance >= threshold, chance


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the rules and the classifier keep, with all their columns."""
    model = train(docs, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in smaller_batches(whole, "text", 8 << 20):
                yield batch.filter(pa.array([_verdict(model, t.as_py() or "", threshold)[6] for t in batch["text"]], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
