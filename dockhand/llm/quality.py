"""Quality classifier: naive Bayes support vectors over n-gram indicators.

A text is the set of its byte n-grams (orders 1 to 4), hashed to ``1 << BITS``
features, and of its runs of one word. Naive Bayes log-count ratios of the two classes scale the
indicators, and a linear hinge-loss model is fitted on them by dual coordinate
descent; a logistic curve on rows kept out of the fit turns margins into
probabilities in which both classes weigh the same. The fit takes at most
``SAMPLE`` labelled rows of each class (those with the smallest hash of their
id, in one task); every whole text is scored.

Defined results: a null or empty text has no features and gets the score of
the intercept; a label row with a null label or without a document is not learned from; a document with several labels has the highest; without rows of both
classes every score is the share of label 1 (0.5 without labels); an empty
table gives no rows; other columns pass by unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import fold, text_of

BITS = 18
ORDERS = (1, 2, 3, 4)
SAMPLE = 5_000
THRESHOLD = 0.3
FOLDS = 5
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 15
CHUNK = 1 << 20
REPEATS = (3, 5, 8)
FEATURES = (1 << BITS) + len(REPEATS)


def _hashed(codes: np.ndarray, order: int) -> np.ndarray:
    mixed = codes * np.uint32(2654435761) + np.uint32(order * 0x9E3779B9 & 0xFFFFFFFF)
    mixed ^= mixed >> np.uint32(15)
    return (mixed * np.uint32(2246822519)) >> np.uint32(32 - BITS)


def _byte_features(raw: bytes) -> np.ndarray:
    """Feature numbers of the byte n-grams; long texts are taken in overlapping chunks."""
    if len(raw) > CHUNK:
        step = CHUNK - max(ORDERS) + 1
        return np.unique(np.concatenate([_byte_features(raw[at : at + CHUNK]) for at in range(0, len(raw), step)]))
    one = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    two = (one[:-1] << np.uint32(8)) | one[1:]
    three = (two[:-1] << np.uint32(8)) | one[2:]
    four = (two[:-2] << np.uint32(16)) | two[2:] if len(one) > 3 else one[:0]
    return np.unique(np.concatenate([_hashed(c, n) for n, c in zip(ORDERS, (one, two, three, four), strict=True)]))


def features(raw: bytes) -> np.ndarray:
    """Distinct feature numbers of a text in UTF-8.

    Besides byte n-grams these are word n-grams up to renaming of words: that a word stands
    ``REPEATS`` times in a row, whichever word it is.
    """
    words = raw.split()
    same = bytes(map(eq, words, words[1:]))
    runs = [(1 << BITS) + i for i, n in enumerate(REPEATS) if b"\x01" * (n - 1) in same]
    return np.concatenate([_byte_features(raw), np.array(runs, dtype=np.uint32)])


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """log of (share of feature j in class 1) / (share in class 0), both smoothed."""
    counts = [np.full(FEATURES, smoothing), np.full(FEATURES, smoothing)]
    for row, label in zip(rows, labels, strict=True):
        counts[label][row] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def _vector(row: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Values of the scaled indicators, as a unit vector."""
    values = ratios[row]
    norm = np.sqrt(values @ values)
    return values / norm if norm > 0 else values


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, cost: float = COST, epochs: int = EPOCHS, seed: int = 1
) -> np.ndarray:
    """Weights (the last is the intercept) of the L1-loss linear SVM in its dual form."""
    signs = np.where(labels == 1, 1.0, -1.0)
    weights, alphas = np.zeros(FEATURES + 1), np.zeros(len(rows))
    share = np.bincount(labels, minlength=2) / len(labels)
    upper = cost * 0.5 / share[labels]  # both classes weigh the same
    lengths = np.array([v @ v for v in values]) + 1.0
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(rows)):
            row, value, sign = rows[i], values[i], signs[i]
            gradient = sign * (weights[row] @ value + weights[-1]) - 1.0
            new = min(max(alphas[i] - gradient / lengths[i], 0.0), upper[i])
            step = (new - alphas[i]) * sign
            if step:
                weights[row] += step * value
                weights[-1] += step
                moved = max(moved, abs(step))
                alphas[i] = new
        if moved < 1e-3:
            break
    return weights


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton steps on smoothed targets with equal class weights."""
    n1, n0 = max(int(labels.sum()), 1), max(int((1 - labels).sum()), 1)
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(labels == 1, 0.5 / n1, 0.5 / n0)
    x = np.column_stack([margins, np.ones(len(margins))])
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + 1e-6 * at
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        at = at - step * min(1.0, 5.0 / max(float(np.abs(step).max()), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return float(max(at[0], 1e-3)), float(at[1])


class Model:
    """Ratios, weights with the intercept last, and the logistic curve."""

    def __init__(self, ratios: np.ndarray, weights: np.ndarray, slope: float, offset: float):
        self.ratios, self.weights = ratios.astype(np.float32), weights.astype(np.float32)
        self.slope, self.offset = slope, offset

    def margin(self, raw: bytes) -> float:
        row = features(raw)
        values = self.ratios[row]
        norm = float(np.sqrt(values @ values))
        return (float(values @ self.weights[row]) / norm if norm > 0 else 0.0) + float(self.weights[-1])

    def score(self, raw: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(raw) + self.offset, -30, 30))))


def _train(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ratios = log_count_ratios(rows, labels)
    return ratios, dual_coordinate_descent(rows, [_vector(row, ratios) for row in rows], labels)


def fit(texts: list[bytes], labels: np.ndarray) -> Model:
    """The model of all rows; its curve from the margins of rows that a fold's model has not seen."""
    rows = [features(t) for t in texts]
    part = np.empty(len(rows), dtype=np.int64)
    for label in (0, 1):  # both classes in every fold
        of_label = np.flatnonzero(labels == label)
        part[of_label] = np.arange(len(of_label)) % FOLDS
    margins, seen = np.zeros(len(rows)), np.zeros(len(rows), dtype=bool)
    for fold_number in range(FOLDS):
        inner, outer = np.flatnonzero(part != fold_number), np.flatnonzero(part == fold_number)
        if len({*labels[inner]}) < 2:
            continue
        ratios, weights = _train([rows[i] for i in inner], labels[inner])
        margins[outer] = [weights[rows[i]] @ _vector(rows[i], ratios) + weights[-1] for i in outer]
        seen[outer] = True
    ratios, weights = _train(rows, labels)
    if len({*labels[seen]}) < 2:
        margins, seen = np.array([weights[r] @ _vector(r, ratios) + weights[-1] for r in rows]), np.ones(len(rows), dtype=bool)
    return Model(ratios, weights, *logistic(margins[seen], labels[seen]))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model | float:
    """The model, or the share of label 1 where one class is missing.

    ``docs`` (doc_id, text) and ``labels`` (doc_id and the label). The rows of the fit are bounded by
    ``2 * sample`` and lie in one task; the driver gets the weights, whose number is fixed.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    n = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows at most
    if len(n) < 2:
        return float(next(iter(n), 0.5))
    prior = n[1] / (n[0] + n[1])
    order = F.xxhash64("doc_id", F.lit(11))
    chosen = [known.filter(F.col("label") == c).orderBy(order, "doc_id").limit(sample) for c in (0, 1)]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").cast("binary").alias("text"))
    rows = rows.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")  # at most 2 * sample ids

    def learn(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(parts)
        if not parts:
            return
        got = pd.concat(parts, ignore_index=True)
        if got["label"].nunique() < 2:
            return
        got = got.sort_values("order", ignore_index=True)
        got = got.drop_duplicates("doc_id", ignore_index=True)
        m = fit(list(got["text"]), got["label"].to_numpy(dtype=np.int64))
        yield pd.DataFrame(
            {"ratios": [m.ratios.tobytes()], "weights": [m.weights.tobytes()], "slope": [m.slope], "offset": [m.offset]}
        )

    one = rows.select("doc_id", "text", "label", order.alias("order")).repartition(1)
    found = one.mapInPandas(learn, "ratios binary, weights binary, slope double, offset double").collect()  # one row
    if not found:
        return prior
    r = found[0]
    return Model(np.frombuffer(r.ratios, np.float32), np.frombuffer(r.weights, np.float32), r.slope, r.offset)


def with_scores(docs: DataFrame, model: Model | float, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text as column ``out``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    raw = "__raw_text"
    rows = docs.withColumn(raw, text_of(text).cast("binary"))

    def score(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in source:
            at = batch.schema.get_field_index(raw)
            scores = [
                m if isinstance(m, float) else m.score(t.as_buffer().to_pybytes()) if t.is_valid else m.score(b"")
                for t in batch.column(at)
            ]
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [c for i, c in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], names=[*names, out])

    schema = docs.schema.add(out, "double")
    return rows.mapInArrow(score, schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Rows with a fold of 0 are never learned from."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = train(rows, labels.filter(fold(F.col("doc_id")) != 0))
    scored = with_scores(rows, model)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
