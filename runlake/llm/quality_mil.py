"""A quality classifier by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded from hashed words and runs of characters; a gated
attention weighs the passages; the weighted sum is scored. Encoder, attention and scorer are learned
together from the labels of whole documents, on a bounded sample outside the held-out fold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text_features
from .common import smaller_batches, text_or_empty
from .learning import HELD_OUT, calibration, fitted, fold, sigmoid, training_rows, within

#: At most so many labelled rows teach the model, of no more than so many passages together: the bounds of its sample of
#: rows, 130 MB in the task that fits. A row that is taken is learnt from whole. Scores are made of all passages.
SAMPLE, SAMPLE_PASSAGES = 3000, 60_000
#: Words of a passage, 2**BITS features of each family, sizes of the encoding and of the attention.
PASSAGE, BITS, CODE, GATE = 128, 9, 24, 12
EPOCHS, BATCH, RATE, PENALTY, CALIBRATION_FOLD, SEED = 12, 64, 0.01, 1e-5, 1, 7
#: A document is predicted good from this score.
THRESHOLD = 0.3

Model = dict[str, np.ndarray]


def _start() -> Model:
    rng, width = np.random.default_rng(SEED), (2 << BITS) + text_features.SHAPE
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    return {"E": normal(width, CODE, scale=0.3), "e": np.zeros(CODE, np.float32), "V": normal(CODE, GATE, scale=0.3), "U": normal(CODE, GATE, scale=0.3), "a": normal(GATE, scale=0.3), "c": np.zeros(CODE, np.float32), "b": np.zeros(1, np.float32)}


def forward(m: Model, x: np.ndarray, bag: np.ndarray) -> dict[str, np.ndarray]:
    """The score of each bag (before calibration) and what led to it; ``bag`` holds where each bag starts."""
    return pooled(m, *encoded(m, x), bag)


def encoded(m: Model, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The encoding of each passage, and the two sides of its gated attention."""
    code = np.tanh(x @ m["E"] + m["e"])
    return code, np.tanh(code @ m["V"]), sigmoid(code @ m["U"])


def pooled(m: Model, code: np.ndarray, open_: np.ndarray, gate: np.ndarray, bag: np.ndarray) -> dict[str, np.ndarray]:
    raw = (open_ * gate) @ m["a"]
    sizes = np.diff(np.append(bag, len(code)))
    raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, bag), sizes))
    weight = raw / np.repeat(np.add.reduceat(raw, bag), sizes)
    mean = np.add.reduceat(weight[:, None] * code, bag, axis=0)
    return {"code": code, "open": open_, "gate": gate, "weight": weight, "pooled": mean, "sizes": sizes, "score": mean @ m["c"] + m["b"][0]}


def gradients(m: Model, x: np.ndarray, bag: np.ndarray, target: np.ndarray, importance: np.ndarray) -> Model:
    f = forward(m, x, bag)
    off = (importance * (sigmoid(f["score"]) - target) / len(target)).astype(np.float32)
    each = np.repeat(off, f["sizes"])
    d_pooled = each[:, None] * m["c"]
    d_weight = (f["code"] * d_pooled).sum(1)
    mean = np.repeat(np.add.reduceat(f["weight"] * d_weight, bag), f["sizes"])
    d_raw = f["weight"] * (d_weight - mean)
    d_both = d_raw[:, None] * m["a"]
    d_open, d_gate = d_both * f["gate"] * (1 - f["open"] ** 2), d_both * f["open"] * f["gate"] * (1 - f["gate"])
    d_code = (f["weight"][:, None] * d_pooled + d_open @ m["V"].T + d_gate @ m["U"].T) * (1 - f["code"] ** 2)
    return {"E": x.T @ d_code, "e": d_code.sum(0), "V": f["code"].T @ d_open, "U": f["code"].T @ d_gate, "a": (f["open"] * f["gate"]).T @ d_raw, "c": f["pooled"].T @ off, "b": np.array([off.sum()])}


def _fit(rows: list) -> Model | None:
    """Adam over batches of documents in a fixed order; None where the sample lacks one of the labels."""
    y, own = np.array([y for _, y, _ in rows], dtype=np.float32), np.array([f for _, _, f in rows]) == CALIBRATION_FOLD
    taught = np.flatnonzero(~own)
    if len(set(y[taught])) < 2:
        return None
    rate = y[taught].mean()
    m, rng = _start(), np.random.default_rng(SEED)
    first, second = ({n: np.zeros_like(v) for n, v in m.items()} for _ in range(2))
    k = 0
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(taught), max(1, len(taught) // BATCH)):
            x, bag = _bags([rows[i][0] for i in part])
            k += 1
            for n, g in gradients(m, x, bag, y[part], np.where(y[part] > 0, 0.5 / rate, 0.5 / (1 - rate))).items():
                g = g + PENALTY * m[n]
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.999 * second[n] + 0.001 * g * g
                m[n] = (m[n] - RATE * (first[n] / (1 - 0.9**k)) / (np.sqrt(second[n] / (1 - 0.999**k)) + 1e-8)).astype(np.float32)
    back = np.flatnonzero(own) if len(set(y[own])) == 2 else taught
    scores = np.concatenate([forward(m, *_bags([rows[i][0] for i in part]))["score"] for part in np.array_split(back, max(1, len(back) // BATCH))])
    m["calibration"] = np.array(calibration(scores.astype(np.float64), y[back]))
    return m


def _bags(features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(features).astype(np.float32), np.cumsum([0, *(len(f) for f in features[:-1])])


def encode(text: str) -> np.ndarray:
    """All passages of a text."""
    return np.concatenate([rows.astype(np.float16) for rows in text_features.passages(text, BITS, PASSAGE)])


def taught(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """The rows to learn from: as many whole documents as SAMPLE_PASSAGES passages hold, of at most ``sample``."""
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    return within(training_rows(docs, labels, "quality", sample), F.greatest(F.ceil(words / PASSAGE), F.lit(1)), SAMPLE_PASSAGES)


def score(model: Model | None, text: str) -> tuple[float, int, float]:
    """The calibrated score, the number of passages, and the weight of the one that counts most."""
    rows = text_features.passages(text, BITS, PASSAGE)
    if model is None:
        return 0.5, sum(map(len, rows)), 1.0
    code, open_, gate = (np.concatenate(x) for x in zip(*(encoded(model, x) for x in rows)))
    f = pooled(model, code, open_, gate, np.array([0]))
    slope, offset = model["calibration"]
    return float(sigmoid(slope * float(f["score"][0]) + offset)), len(code), float(f["weight"].max())


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, n_passages, top_weight.

    Scores come from the text alone. A null text counts as an empty one: a single passage without words,
    which gets a score like any other. Without labels of both kinds every score is 0.5, and a warning says so. A null doc_id is
    in no fold (held_out false). Repeated rows each give a row, other columns are ignored, an empty table
    gives an empty one.
    """
    model = fitted(taught(docs, labels, sample), encode, _fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in smaller_batches(whole, "text", 8 << 20):
                rows = [score(model, t.as_py()) for t in batch["text"]]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), (pa.float64(), pa.int64(), pa.float64()), strict=True)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", "score", "n_passages", "top_weight"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, score double, n_passages long, top_weight double")
    held = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_passages", "top_weight")
