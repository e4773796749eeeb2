"""What the trained operators share: bounded training samples, and one task that fits a model."""

from __future__ import annotations

import pickle
import warnings
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import spooled

#: Bits of the hash by which the sample is found.
PART_BITS = 14
#: Folds by crc32 of the id's text; rows of fold HELD_OUT never teach anything.
FOLDS, HELD_OUT = 5, 0


def fold(doc_id: F.Column) -> F.Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)).cast("int")


def within(rows: DataFrame, size: F.Column, most: int) -> DataFrame:
    """Of a bounded sample the rows whose sizes add up to ``most``, in the order of their ids' hashes; a larger row is passed over."""
    rows = spooled(rows, "sample")
    sized = rows.select("doc_id", size.alias("size")).filter(F.col("size") <= most)
    running = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    return rows.join(F.broadcast(sized.withColumn("running", running).filter(F.col("running") <= most).select("doc_id")), "doc_id")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """doc_id, text, label and fold of at most ``most`` labelled documents outside the held-out fold.

    The sample is those of smallest hash among the ids that both tables have, so it doesn't depend on
    partitioning, nor on labels of other documents. It is bounded by ``most`` whatever the input, which is why it
    may be broadcast. Rows without an id or label are passed over; of repeated labels one (the least) counts, of
    documents that repeat an id the one of the least text.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter("doc_id is not null and label in (0, 1)").filter(fold(F.col("doc_id")) != HELD_OUT)
    known = known.groupBy("doc_id").agg(F.min("label").alias("label")).join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    known = spooled(known.withColumn("part", F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - PART_BITS)), "labelled")
    # the parts of the hashes that the sample lies in, so that no task sorts more than the sample and one part
    parts = known.groupBy("part").count().orderBy("part").collect()  # 2**PART_BITS rows at most
    reached = np.searchsorted(np.cumsum([r["count"] for r in parts]), most)
    last = parts[min(int(reached), len(parts) - 1)]["part"] if parts else -1
    chosen = known.filter(F.col("part") <= last).orderBy("part", F.xxhash64("doc_id"), "doc_id").limit(most).drop("part")
    # one text an id, chosen before the shuffle, or a document repeated without end would have no bound
    taught = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return taught.withColumn("fold", fold(F.col("doc_id")))


def fitted(rows: DataFrame, encode: Callable[[str], np.ndarray], fit: Callable[[list], object]) -> object | None:
    """Encode the sample's texts in parallel, fit in one task over the bounded sample, return the small model.

    ``fit`` gets (features, label, fold) in the order of doc_id and may return None, which is warned of. What
    ``encode`` returns for all rows must have a bound, whatever the texts' lengths: one task holds all of the sample.
    """

    def encoded(batches):
        for batch in batches:
            data = [pickle.dumps(encode(t.as_py()), protocol=5) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], batch["fold"], pa.array(data, pa.binary())], names=["doc_id", "label", "fold", "x"])

    def trained(batches):
        held = sorted((i, y, f, x) for b in batches for i, y, f, x in zip(*(b[c].to_pylist() for c in ("doc_id", "label", "fold", "x")), strict=True))
        model = fit([(pickle.loads(x), y, f) for _, y, f, x in held]) if held else None
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model, protocol=5)], pa.binary())], names=["model"])

    done = rows.mapInArrow(encoded, "doc_id long, label int, fold int, x binary").repartition(1).mapInArrow(trained, "model binary").collect()
    model = pickle.loads(bytes(done[0]["model"])) if done else None
    if model is None:
        warnings.warn("no model: the labelled documents of the training folds lack one of the two labels", stacklevel=3)
    return model


def sigmoid(x: np.ndarray | float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def calibration(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Platt's scaling: slope and offset, by Newton's method with his smoothed targets."""
    positive, n = labels.sum(), len(labels)
    target = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (n - positive + 2))
    ab = np.array([1.0, 0.0])
    x = np.stack([scores, np.ones(n)], axis=1)
    for _ in range(50):
        p = sigmoid(x @ ab)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * (ab - [1.0, 0.0]))
        ab -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(ab[0]), float(ab[1])
