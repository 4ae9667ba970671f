"""Text classes by a multinomial model over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.session import settle

BASE = 31
SCALE = 10_000
# Labels whose counts a training task holds before it hands them on.
HELD = 64
# Runs of a text that are worked on together.
PIECE = 1 << 16


def gram_slots(text: str | None, n: int, slots: int) -> np.ndarray:
    """The slot of each run of ``n`` code points of ``text``, A-Z lower-cased; fewer code points have none."""
    if text is None or len(text) < n:
        return np.zeros(0, dtype=np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    points = np.where((points >= 65) & (points <= 90), points + 32, points)
    runs = len(points) - n + 1
    found = np.zeros(runs, dtype=np.int64)
    for k in range(n):
        found = found * BASE + points[k : k + runs]
    return found % slots


def slot_hits(text: str | None, n: int, slots: int) -> np.ndarray:
    """Occurrences per slot; a long text is taken in pieces, so its arrays stay small."""
    hits = np.zeros(slots, dtype=np.int64)
    for at in range(0, len(text or ""), PIECE):
        hits += np.bincount(gram_slots(text[at : at + PIECE + n - 1], n, slots), minlength=slots)
    return hits


def gram_counts(df: DataFrame, label: str, text: str, n: int = 3, slots: int = 4096) -> DataFrame:
    """``label, slot, hits``: occurrences per label and slot, documents per label under slot -1.

    Tasks count whole Arrow batches first, so the shuffle moves at most one row per task,
    label and slot however many texts a label has. Rows without a label do not count.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def rows() -> pa.RecordBatch:
            labels, places, hits = [], [], []
            for name, found in held.items():
                used = np.flatnonzero(found)
                labels.append(np.full(len(used), name, dtype=object))
                places.append(used - 1)
                hits.append(found[used])
            held.clear()
            whole = [np.concatenate(x) for x in (labels, places, hits)]
            return pa.RecordBatch.from_arrays(
                [pa.array(whole[0], pa.string()), pa.array(whole[1], pa.int32()), pa.array(whole[2], pa.int64())],
                names=["label", "slot", "hits"],
            )

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                if name not in held:
                    if len(held) == HELD:
                        yield rows()
                    held[name] = np.zeros(slots + 1, dtype=np.int64)
                held[name][0] += 1
                held[name][1:] += slot_hits(body.as_py(), n, slots)
        if held:
            yield rows()

    rows = df.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text")).filter("label is not null")
    per_task = rows.mapInArrow(count, "label string, slot int, hits long")
    return per_task.groupBy("label", "slot").agg(F.sum("hits").alias("hits"))


@dataclass
class GramModel:
    """Whole-number weights: ``round(SCALE * ln p)``, so a score does not depend on the order of addition."""

    labels: list[str]
    prior: np.ndarray
    weights: np.ndarray
    n: int

    def add_class(self, df: DataFrame, text: str, out: str = "predicted") -> DataFrame:
        """``df`` with the label of the highest score, the first by name on a tie.

        A text with no n-gram gets the commonest label; a model without labels gives null.
        """
        labels, prior, weights, n = self.labels, self.prior, self.weights, self.n

        @F.arrow_udf("string")
        def best(texts: pa.Array) -> pa.Array:
            if not labels:
                return pa.nulls(len(texts), pa.string())
            slots = weights.shape[1]
            picked = []
            for body in texts:  # one text at a time as a Python string
                hits = slot_hits(body.as_py(), n, slots)
                picked.append(labels[int(np.argmax(prior + weights @ hits))])
            return pa.array(picked, pa.string())

        return df.withColumn(out, best(F.col(text).cast("string")))


def fit_grams(
    df: DataFrame, label: str, text: str, n: int = 3, slots: int = 4096, max_labels: int = 1000
) -> GramModel:
    """A multinomial model with one added to each count, fitted by one aggregate.

    Only the model reaches the driver: ``max_labels`` times ``slots`` numbers at most, more labels are an error.
    """
    counts = settle(gram_counts(df, label, text, n, slots), "gram-counts")
    labels = [r["label"] for r in counts.filter("slot = -1").select("label").limit(max_labels + 1).collect()]
    if len(labels) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    labels.sort()
    return _model(labels, counts.collect() if labels else [], n, slots)


def _model(labels: Sequence[str], rows, n: int, slots: int) -> GramModel:
    at = {name: i for i, name in enumerate(labels)}
    hits = np.zeros((len(labels), slots), dtype=np.int64)
    docs = np.zeros(len(labels), dtype=np.int64)
    for name, slot, found in rows:
        if slot < 0:
            docs[at[name]] = found
        else:
            hits[at[name], slot] = found
    share = (hits + 1) / (hits.sum(axis=1, keepdims=True) + slots)
    prior = docs / max(int(docs.sum()), 1)
    return GramModel(list(labels), _scaled(prior), _scaled(share), n)


def _scaled(p: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * np.log(p) + 0.5).astype(np.int64)
