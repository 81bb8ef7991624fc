"""Quality classifier: naive Bayes support vectors over n-gram indicators.

A document's features are the n-grams it holds, each counted once, hashed to a fixed number of columns:
n-grams of its bytes, and n-grams of ditto marks, which tell for each word whether it repeats the one
before. Class log-count ratios scale the indicators; a linear hinge-loss model on the scaled features is
fitted by dual coordinate descent, and its margin is turned into a probability by a logistic curve fitted
on rows the model has not seen. All of this is fitted on a bounded sample of labelled rows; every text is
scored, whole, in one pass and without moving.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailscope.llm.common import hash_sample, only_named, whole_text
from retailscope.llm.langid import in_fold
from retailscope.sources.shared import materialize

COLUMN_BITS = 16
ORDERS = (1, 2, 3, 4)
SMOOTHING = 1.0
MAX_LABELLED_ROWS = 20_000  # labelled rows the class counts are taken from, half of each class where there are enough
MAX_FIT_ROWS = 6000  # rows of the hinge-loss fit, taken from those
PENALTY = 0.05
EPOCHS = 12
SEED = 6
STRETCH = 1 << 20
DITTO_WORDS = 4
DITTO_SEED = 0x5BD1E995


def grams(text: bytes, held: np.ndarray) -> np.ndarray:
    """The sorted columns of a text's n-grams. ``held`` is scratch space, all False before and after.

    The whole text takes part, a bounded stretch at a time. Letters are taken in their own case: shouting
    is a sign of its own.
    """
    for start in range(0, len(text), STRETCH):
        data = np.frombuffer(text[max(0, start - max(ORDERS) + 1) : start + STRETCH], dtype=np.uint8).astype(np.uint32)
        value = np.zeros(len(data), dtype=np.uint32)
        for order in ORDERS:
            n = len(data) - order + 1
            if n <= 0:
                break
            value = value[:n] * np.uint32(0x9E3779B1) + data[order - 1 :] + np.uint32(order)
            mixed = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            held[mixed >> np.uint32(32 - COLUMN_BITS)] = True
    words = text.split()
    ditto = np.fromiter(map(bytes.__eq__, words, words[1:]), dtype=np.uint8, count=max(0, len(words) - 1))
    marks = np.ones(len(ditto), dtype=np.uint32)
    for order in range(DITTO_WORDS):
        marks = marks[: max(0, len(ditto) - order)] * np.uint32(2) + ditto[order:]
        mixed = (marks + np.uint32(DITTO_SEED)) * np.uint32(0x85EBCA6B)
        held[(mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - COLUMN_BITS)] = True
    columns = np.flatnonzero(held)
    held[columns] = False
    return columns


def packed(columns: np.ndarray) -> bytes:
    """Sorted columns in at most one bit for each that exists: as numbers where they are few, else as a bit set."""
    if 2 * len(columns) < (1 << COLUMN_BITS) // 8:
        return columns.astype("<u2").tobytes()
    held = np.zeros(1 << COLUMN_BITS, dtype=bool)
    held[columns] = True
    return np.packbits(held).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if len(data) < (1 << COLUMN_BITS) // 8:
        return np.frombuffer(data, dtype="<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, dtype=np.uint8)).view(bool))


class PackedRows(Sequence):
    """The columns of many texts, 8 KB a text at most, unpacked one at a time."""

    def __init__(self, rows: list[bytes]):
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> np.ndarray:
        return unpacked(self.rows[i])

    def where(self, mask: np.ndarray) -> PackedRows:
        return PackedRows([self.rows[i] for i in np.flatnonzero(mask)])


@dataclass
class Model:
    weights: np.ndarray  # already times the log-count ratios
    offset: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def class_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows per label, and rows per label and column, over all of ``labelled`` (text, label).

    A task sends one number per label and column it saw; Spark adds them up, and the sums that come back
    are bounded by the number of columns.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << COLUMN_BITS, dtype=bool)
        counts, rows = np.zeros((2, 1 << COLUMN_BITS), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for batch in batches:
            for text, label in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("label").to_pylist()):
                counts[label][grams(text, held)] += 1
                rows[label] += 1
        for label in (0, 1):
            seen = np.flatnonzero(counts[label])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen) + 1, label, dtype=np.int32)), pa.array(np.append(seen, -1).astype(np.int32)),
                 pa.array(np.append(counts[label][seen], rows[label]))],
                ["label", "column", "n"],
            )

    total = (
        labelled.select("text", "label").mapInArrow(count, "label int, column int, n bigint")
        .groupBy("label", "column").agg(F.sum("n").alias("n")).toPandas()
    )
    counts, rows = np.zeros((2, 1 << COLUMN_BITS)), np.zeros(2)
    label, column, n = (total[c].to_numpy() for c in ("label", "column", "n"))
    rows[label[column < 0]] = n[column < 0]
    counts[label[column >= 0], column[column >= 0]] = n[column >= 0]
    return rows, counts


def fit_rows(labelled: DataFrame, most: int) -> tuple[list[int], PackedRows]:
    """Labels and columns of the rows of ``labelled`` with the smallest hashes, ``most`` of each label.

    Tasks read the whole texts, however long; only their packed columns come back.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << COLUMN_BITS, dtype=bool)
        for batch in batches:
            rows = [packed(grams(text, held)) for text in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("draw"), pa.array(rows, pa.binary())], ["draw", "columns"])

    signs, columns = [], []
    for label in (0, 1):
        own = labelled.where(F.col("label") == label).withColumn("draw", F.xxhash64("doc_id", "text"))
        draws = own.select("draw").orderBy("draw").limit(most)  # numbers only, so choosing moves no texts
        last = draws.agg(F.max("draw")).first()[0]
        if last is not None:
            chosen = own.where(F.col("draw") <= last).select("draw", "text").mapInArrow(pack, "draw bigint, columns binary")
            rows = sorted((r["draw"], bytes(r["columns"])) for r in chosen.limit(most).collect())  # bounded by most
            signs += [label] * len(rows)
            columns += [row for _, row in rows]
    return signs, PackedRows(columns)


def dual_descent(features: Sequence[np.ndarray], signs: np.ndarray, ratios: np.ndarray, costs: np.ndarray) -> np.ndarray:
    """Weights of the squared-hinge support vector machine on the scaled, length-one features; the last is the offset."""
    weights, offset, squares = np.zeros(len(ratios)), 0.0, ratios * ratios
    lengths = [max(np.sqrt(squares[columns].sum() + 0.25), 1e-12) for columns in features]
    alpha, draw = np.zeros(len(features)), np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        for i in draw.permutation(len(features)):
            columns = features[i]
            values, constant = ratios[columns] / lengths[i], 0.5 / lengths[i]
            slack = 0.5 / costs[i]
            gradient = signs[i] * (weights[columns] @ values + offset * constant) - 1 + alpha[i] * slack
            fresh = max(0.0, alpha[i] - gradient / (1.0 + slack))
            if fresh != alpha[i]:
                change = (fresh - alpha[i]) * signs[i]
                weights[columns] += change * values
                offset += change * constant
                alpha[i] = fresh
    return np.append(weights, offset)


def margins(features: Sequence[np.ndarray], weights: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    scaled, squares = weights[:-1] * ratios, ratios * ratios
    return np.array([
        (scaled[c].sum() + 0.5 * weights[-1]) / max(np.sqrt(squares[c].sum() + 0.25), 1e-12) for c in features
    ])


def logistic_curve(margin: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve from margins to probabilities, by Newton steps with a small penalty."""
    x, y = np.column_stack([margin, np.ones(len(margin))]), positive.astype(float)
    b = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        b = b - np.linalg.solve(hessian, x.T @ (p - y) + 1e-3 * (b - [1.0, 0.0]))
    return float(b[0]), float(b[1])


def fit(labelled: DataFrame, totals: dict[int, int], max_fit_rows: int = MAX_FIT_ROWS) -> tuple[Model, np.ndarray] | None:
    """Fit on ``labelled`` (doc_id, text, label); None if a class is missing.

    The class counts use all rows given; the hinge-loss fit and its curve use at most ``max_fit_rows``, chosen
    by the hash of their ids and texts whatever their length, half of them from each class where there are
    enough. ``totals`` are the rows per label that exist, which set the share of label 1.
    """
    rows, counts = class_counts(labelled)
    if not rows.all():
        return None
    shares = (counts + SMOOTHING) / (rows + 2 * SMOOTHING)[:, None]
    ratios = np.log(shares[1] / shares[0])
    sample, features = fit_rows(labelled, max_fit_rows // 2)
    positive = np.array(sample) == 1
    signs = np.where(positive, 1.0, -1.0)
    costs = np.where(positive, len(signs) / positive.sum(), len(signs) / (~positive).sum()) * PENALTY
    # the curve sees margins from models fitted without the row; its shift then follows the true class shares
    # the only row of a class has to teach both models
    apart = np.arange(len(signs)) % 2 == 0
    lone = np.where(positive, positive.sum(), (~positive).sum()) == 1
    outside = np.zeros(len(signs))
    for half in (apart, ~apart):
        taught = ~half | lone
        weights = dual_descent(features.where(taught), signs[taught], ratios, costs[taught])
        outside[half] = margins(features.where(half), weights, ratios)
    slope, shift = logistic_curve(outside, positive)
    shift += float(np.log(totals[1] / totals[0]) - np.log(positive.sum() / (~positive).sum()))
    weights = dual_descent(features, signs, ratios, costs)
    return Model(weights[:-1] * ratios, 0.5 * weights[-1], slope, shift), ratios * ratios


def score_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, held_out_fold: int = 0,
    id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
    max_labelled_rows: int = MAX_LABELLED_ROWS,
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    Labels of ids in the held-out fold are never read; of the others at most ``max_labelled_rows`` train, so
    that no text has to move to meet its label. ``score`` is the probability of label 1 for the
    whole text, null counting as empty; an empty text has the score of the model's offset. ``predicted`` is 1 from
    ``threshold`` on. Null ids or labels teach nothing; labels other than 0 and 1 are ignored, and an id
    labelled or listed several times counts each time. Without training rows of both classes every score
    is 0.5.
    """
    rows = only_named(docs, doc_id=id_column, text=text_column).select("doc_id", whole_text().alias("text"))
    known = only_named(labels, doc_id=id_column, label=label_column).where(
        F.col("label").isin(0, 1) & ~in_fold("doc_id", folds, held_out_fold)
    )
    known = known.where(F.col("doc_id").isNotNull()).select("doc_id", F.col("label").cast("int").alias("label"))
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    fitted = None
    if len(totals) == 2:
        most = max_labelled_rows // 2
        one, other = (hash_sample(known.where(F.col("label") == c), most, "doc_id") for c in (0, 1))
        sample = F.broadcast(one.unionByName(other))  # at most max_labelled_rows ids
        fitted = fit(materialize(rows.join(sample, "doc_id"), "quality-training"), totals)
    model, squares = fitted or (None, None)

    def score(texts: pa.Array) -> pa.Array:
        if model is None:
            return pa.array(np.full(len(texts), 0.5))
        held = np.zeros(1 << COLUMN_BITS, dtype=bool)
        margin = np.empty(len(texts))
        for i, text in enumerate(texts.cast(pa.binary()).to_pylist()):
            columns = grams(text, held)
            margin[i] = (model.weights[columns].sum() + model.offset) / max(np.sqrt(squares[columns].sum() + 0.25), 1e-12)
        return pa.array(model.probability(margin))

    scored = rows.withColumn("score", F.arrow_udf(score, "double")("text"))
    return scored.select(
        "doc_id", in_fold("doc_id", folds, held_out_fold).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
