"""Quality classifier: naive Bayes support vectors on n-gram indicators.

A text is the set of n-grams it holds: runs of three bytes, and runs of one to three word shapes (case,
digits, last character, length, and how far back the same word stood). Every indicator is scaled by
its class log-count ratio

    r = log((1 + count in label 1) / total in label 1) - log((1 + count in label 0) / total in label 0)

rows are brought to length one, and a linear model with hinge loss is fitted by dual coordinate
descent. A part of the sample is left out of the fit and turns margins into probabilities. The fit sees
a bounded sample of labelled rows and runs in one task; every text is scored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.words import Block, blocks, mixed

BYTE_BITS, SHAPE_BITS = 16, 15
SIZE = (1 << BYTE_BITS) + (1 << SHAPE_BITS)
BACK = 12  # words looked back for the same word


@dataclass
class Model:
    """``weights`` and squared ``ratios`` of all indicators, the bias, and slope and offset of the probability."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, found: np.ndarray) -> float:
        z = self.slope * self.margin(found) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def margin(self, found: np.ndarray) -> float:
        length = float(np.sqrt(self.squares[found].sum()))
        return float(self.weights[found].sum()) / length + self.bias if length else self.bias


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 10_000,
    threshold: float = 0.3,
    folds: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    Rows whose crc32(id as text) leaves 0 modulo ``folds`` are held out: their labels are never read.
    Of the other labelled rows about ``sample_rows`` are learned from, chosen by a hash of the id. Only the
    text enters a score. Defined cases: null and empty text get the score of a text without n-grams; a
    null id is held out; rows with a null label, and labels without a text, are not learned from; of
    several labels of one id the smallest counts; if one class has no rows, every score is the share of
    label 1 (0.5 without any label); no document, no row; further columns are not read.
    """
    model = fit(docs, labels, sample_rows, folds, id_col, text_col, label_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), _held_out(id_col, folds).alias("held_out"), F.col(text_col).cast("string").alias("text")
    )
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    scored = rows.mapInArrow(_score_rows(model), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def good_documents(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 10_000,
    threshold: float = 0.3,
    folds: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all columns as they are; no shuffle.

    Scores and defined cases as in ``quality_scores``.
    """
    model = fit(docs, labels, sample_rows, folds, id_col, text_col, label_col)

    names = docs.columns
    text = names.index(text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(f) for f in indicators(batch.column(text).cast(pa.large_string()))])
            yield batch.filter(pa.array(scores >= threshold, pa.bool_()))

    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])  # names with dots cannot be looked up
    return plain.mapInArrow(rows, plain.schema).toDF(*names)


def _held_out(id_col: str, folds: int):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(True))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 10_000,
    folds: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """The model from a bounded sample of labelled rows that are not held out."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    known = known.filter(F.col("y").isin(0, 1) & ~_held_out("doc_id", folds))
    part = max(1, -(-known.count() // sample_rows))
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(part)) == 0
    known = known.filter(chosen).groupBy("doc_id").agg(F.min("y").alias("y"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter(chosen)
    kind = texts.join(known, "doc_id").schema["doc_id"].dataType.simpleString()
    rows = texts.join(known, "doc_id").select("doc_id", "y", "text").mapInArrow(_indicator_rows, f"doc_id {kind}, y int, found binary")
    rows = rows.repartition(1)  # the bounded sample alone meets in one task; texts are read by many
    (model,) = rows.mapInArrow(_fit_rows, _MODEL).collect()
    unpack = lambda b: np.frombuffer(b, np.float32)
    return Model(unpack(model.weights), unpack(model.squares), model.bias, model.slope, model.offset)


_MODEL = "weights binary, squares binary, bias double, slope double, offset double"


# --- indicators ------------------------------------------------------------------------------


def indicators(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text, the sorted numbers of the n-grams it holds."""
    seen = np.zeros(SIZE, bool)
    for block in blocks(column):
        three = _byte_runs(block.data)
        shapes = _shapes(block)
        for i in range(len(block)):
            start, stop = block.bounds[i], block.bounds[i + 1]
            seen[three[start : max(start, stop - 2)]] = True
            mine = shapes[block.first[i] : block.first[i + 1]]
            for n in (1, 2, 3):
                seen[_shape_runs(mine, n)] = True
            found = np.flatnonzero(seen)
            seen[found] = False
            yield found


def _byte_runs(data: np.ndarray) -> np.ndarray:
    if len(data) < 3:
        return np.zeros(0, np.uint32)
    d = data.astype(np.uint32)
    value = d[:-2] | (d[1:-1] << np.uint32(8)) | (d[2:] << np.uint32(16))
    return (value * np.uint32(2654435761)) >> np.uint32(32 - BYTE_BITS)


def _shapes(block: Block) -> np.ndarray:
    """A number for the shape of each word."""
    n = len(block.starts)
    if n == 0:
        return np.zeros(0, np.uint64)
    first, last = block.data[block.starts].astype(np.uint64), block.data[block.ends - 1].astype(np.uint64)
    upper = np.concatenate([[0], np.cumsum((block.data >= 65) & (block.data <= 90))])
    digit = np.concatenate([[0], np.cumsum((block.data >= 48) & (block.data <= 57))])
    size = block.ends - block.starts
    uppers, digits = upper[block.ends] - upper[block.starts], digit[block.ends] - digit[block.starts]
    case = np.where(uppers == 0, 0, np.where(2 * uppers >= size, 2, 1)).astype(np.uint64)
    letter = ((last | 32) >= 97) & ((last | 32) <= 122)
    end = np.where(letter | (last >= 128), 0, last).astype(np.uint64)
    symbol = np.where((first < 128) & ~(((first | 32) >= 97) & ((first | 32) <= 122)), first, 0).astype(np.uint64)
    words, text = block.word_hashes(), np.repeat(np.arange(len(block)), np.diff(block.first))
    back = np.zeros(n, np.uint64)
    for k in range(min(BACK, n - 1), 0, -1):
        same = (words[k:] == words[:-k]) & (text[k:] == text[:-k])
        back[k:][same] = k
    length = np.minimum(size, 16).astype(np.uint64) // np.uint64(4)
    code = case | (np.minimum(digits, 1).astype(np.uint64) << np.uint64(2)) | (length << np.uint64(3)) | (back << np.uint64(8))
    return mixed(code | (end << np.uint64(16)) | (symbol << np.uint64(24)))


def _shape_runs(shapes: np.ndarray, n: int) -> np.ndarray:
    if len(shapes) < n:
        return np.zeros(0, np.int64)
    h = np.full(len(shapes) - n + 1, n, np.uint64)
    for k in range(n):
        h = mixed(h ^ shapes[k : len(shapes) - n + 1 + k])
    return (h >> np.uint64(64 - SHAPE_BITS)).astype(np.int64) + (1 << BYTE_BITS)


def _indicator_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [f.astype(np.uint32).tobytes() for f in indicators(batch.column("text"))]
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "y": batch.column("y"), "found": pa.array(found, pa.binary())})


def _score_rows(model: Model) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(f) for f in indicators(batch.column("text"))], np.float64)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": scores})

    return rows


# --- fitting ---------------------------------------------------------------------------------


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, labels, found = [], [], []
    for batch in batches:
        ids += batch.column("doc_id").to_pylist()
        labels += batch.column("y").to_pylist()
        found += [np.frombuffer(f.as_buffer(), np.uint32).copy() for f in batch.column("found")]
    order = sorted(range(len(ids)), key=lambda i: (ids[i], labels[i]))  # any arrival order gives one model
    model = fit_indicators([found[i] for i in order], np.array([labels[i] for i in order], np.int64))
    yield pa.record_batch(
        {
            "weights": pa.array([model.weights.astype(np.float32).tobytes()], pa.binary()),
            "squares": pa.array([model.squares.astype(np.float32).tobytes()], pa.binary()),
            "bias": [model.bias],
            "slope": [model.slope],
            "offset": [model.offset],
        }
    )


def fit_indicators(found: list[np.ndarray], y: np.ndarray, cost: float = 1.0, passes: int = 12, seed: int = 1) -> Model:
    """Log-count ratios, dual coordinate descent on three quarters of the rows, probabilities from the rest."""
    ones = int(y.sum())
    if ones == 0 or ones == len(y):
        share = ones / len(y) if len(y) else 0.5
        odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return Model(np.zeros(SIZE), np.zeros(SIZE), 0.0, 0.0, float(odds))
    fitted = np.arange(len(y)) % 4 != 3
    if len(set(y[fitted])) < 2 or len(set(y[~fitted])) < 2:
        fitted = np.ones(len(y), bool)
    counts = np.ones((2, SIZE))
    for i in np.flatnonzero(fitted):
        counts[y[i], found[i]] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    rows = [ratios[f] / max(float(np.sqrt((ratios[f] ** 2).sum())), 1e-12) for f in found]
    weights, bias = _dual_descent([found[i] for i in np.flatnonzero(fitted)], [rows[i] for i in np.flatnonzero(fitted)], y[fitted], cost, passes, seed)
    model = Model(weights * ratios, ratios**2, bias, 1.0, 0.0)
    rest = np.flatnonzero(~fitted) if not fitted.all() else np.arange(len(y))
    model.slope, model.offset = _probabilities(np.array([model.margin(found[i]) for i in rest]), y[rest])
    return model


def _dual_descent(found, rows, y, cost: float, passes: int, seed: int) -> tuple[np.ndarray, float]:
    """min 1/2 |w|^2 + sum of C_i hinge(1 - s_i (w x_i + b)), one dual variable at a time.

    The bias is the weight of a constant 1. Costs weigh both classes alike.
    """
    sign = 2.0 * y - 1
    limit = np.where(y == 1, cost * len(y) / (2 * max(1, y.sum())), cost * len(y) / (2 * max(1, (1 - y).sum())))
    alpha, weights, bias = np.zeros(len(y)), np.zeros(SIZE), 0.0
    rng = np.random.default_rng(seed)
    squares = [float(x @ x) + 1.0 for x in rows]
    for _ in range(passes):
        moved = 0.0
        for i in rng.permutation(len(y)):
            slope = sign[i] * (float(weights[found[i]] @ rows[i]) + bias) - 1
            new = min(max(alpha[i] - slope / squares[i], 0.0), limit[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                alpha[i] = new
                weights[found[i]] += step * rows[i]
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def _probabilities(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over margins, by Newton's method with smoothed targets."""
    ones = int(y.sum())
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    x = np.stack([margins, np.ones(len(y))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (p - target) + np.array([1e-3 * beta[0], 0.0])
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])
