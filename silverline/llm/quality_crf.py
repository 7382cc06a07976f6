"""Quality classifier: a linear-chain CRF over the lines of a document.

Every line is good or bad. Its score comes from features of the line and of its
neighbours; a transition matrix ties neighbouring labels. The forward-backward
marginals of "good", weighted by line length, give the document's quality.

Training uses document labels as labels of all its lines, from a bounded sample
of ``TRAIN_DOCS`` whole documents; if these have more than ``DRIVER_LINES``
lines, each step's gradient is summed on Spark. Scoring takes whole texts too:
features are sums over bytes and words of each line.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from silverline.llm.common import cut
from silverline.llm.wordhash import WordHasher, joined, text_slabs

TRAIN_DOCS = 4000
DRIVER_LINES = 256_000   # lines that the driver learns from by itself
SLAB_LINES = 32_000      # lines whose gradient a task takes at once
STEPS = 250
DECAY = 1e-3            # L2 penalty
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0

# Classes of bytes: letters, capitals, digits, blanks, sentence marks, exclamation marks, bars, other marks, non-ASCII.
_CLASSES = 9


def byte_classes() -> np.ndarray:
    kind = np.full(256, 7, np.uint8)
    kind[128:] = 8
    for chars, k in ((b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2),
                     (b" \t\n\x0b\x0c\r", 3), (b".,;:?'\"()-", 4), (b"!", 5), (b"|", 6)):
        kind[list(chars)] = k
    return kind


def line_features(texts: list[bytes], hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of the texts, lines of each text, and weight (bytes + 1) of each line."""
    buffer, _ = joined(texts)
    feeds = np.flatnonzero(buffer == 10)
    n = len(feeds)
    starts = np.concatenate([[0], feeds[:-1] + 1])
    length = (feeds - starts).astype(np.float64)
    kind = byte_classes()[buffer]
    line_of = np.zeros(len(buffer), np.int64)
    line_of[feeds[:-1] + 1] = 1
    np.cumsum(line_of, out=line_of)
    counts = np.bincount(line_of * _CLASSES + kind, minlength=n * _CLASSES).reshape(n, _CLASSES).astype(np.float64)
    counts[:, 3] -= 1                                     # the line feed itself
    first, end, word = hasher.words(buffer)
    at = line_of[first]
    n_words = np.bincount(at, minlength=n).astype(np.float64)
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (at[1:] == at[:-1])
    _, index = np.unique(word + at.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), return_index=True)
    distinct = np.bincount(at[index], minlength=n)
    last = kind[end - 1] if len(end) else np.zeros(0, np.uint8)
    marked = np.bincount(at, weights=np.isin(last, (5, 6, 7)), minlength=n)
    stops = np.bincount(at, weights=last == 4, minlength=n)
    one, words = np.maximum(length, 1), np.maximum(n_words, 1)
    letters = np.maximum(counts[:, 0] + counts[:, 1] + counts[:, 8], 1)
    ratios = np.stack([
        counts[:, 1] / letters, counts[:, 2] / one, counts[:, 4] / one, counts[:, 5] / one, counts[:, 6] / one,
        counts[:, 7] / one, marked / words, stops / words, np.bincount(at, weights=again, minlength=n) / words,
        1 - distinct / words], 1)
    sizes = np.stack([np.log1p(n_words) / 5, np.minimum(length / words, 30) / 10, length == 0, n_words == 1, n_words <= 3], 1)
    features = np.concatenate([ratios, ratios > 0.03, ratios > 0.15, ratios > 0.5, sizes], 1)
    lines = np.fromiter((t.count(b"\n") + 1 for t in texts), np.int64, len(texts))
    return features.astype(np.float32), lines, length + 1


def with_neighbours(features: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """A constant, the line's features, the previous line's and the next one's (0 beyond the text)."""
    n, ends = len(features), np.cumsum(lines)
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    before[(ends - lines)] = 0
    after[ends - 1] = 0
    return np.concatenate([np.ones((n, 1), np.float32), features, before, after], 1)


def forward_backward(unary: np.ndarray, lines: np.ndarray, transition: np.ndarray):
    """Marginals of label 1, expected transitions (2 x 2) and log-partition of all texts.

    unary: log score of label 1 against label 0, one a line. Texts advance
    together, longest first, so a step works on those that still have lines.
    """
    order = np.argsort(-lines, kind="stable")
    start = (np.cumsum(lines) - lines)[order]
    size = lines[order]
    step_scores = np.exp(transition)
    alpha = np.empty((len(unary), 2))
    scale = np.empty(len(unary))
    weight = np.stack([1 / (1 + np.exp(np.clip(unary, -50, 50))), 1 / (1 + np.exp(-np.clip(unary, -50, 50)))], 1)
    live = len(size)
    most = int(size[0]) if live else 0
    lives = np.searchsorted(-size, -np.arange(most), side="left")       # texts with more lines than t
    for t in range(most):
        at = start[:lives[t]] + t
        a = weight[at] if t == 0 else (alpha[at - 1] @ step_scores) * weight[at]
        z = a.sum(1)
        alpha[at], scale[at] = a / z[:, None], z
    beta = np.ones((len(unary), 2))
    expected = np.zeros((2, 2))
    for t in range(most - 1, 0, -1):
        at = start[:lives[t]] + t
        ahead = weight[at] * beta[at] / scale[at][:, None]
        expected += np.einsum("ni,nj->ij", alpha[at - 1], ahead) * step_scores
        beta[at - 1] = ahead @ step_scores.T
    good = alpha[:, 1] * beta[:, 1]
    return good / (good + alpha[:, 0] * beta[:, 0]), expected, float(np.log(scale).sum())


@dataclass(frozen=True)
class Crf:
    weights: np.ndarray       # of the features, for label 1
    transition: np.ndarray    # 2 x 2 log scores

    def marginals(self, features: np.ndarray, lines: np.ndarray) -> np.ndarray:
        return forward_backward(with_neighbours(features, lines) @ self.weights, lines, self.transition)[0]


def _gradient(theta: np.ndarray, x: np.ndarray, y: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Gradient of the log-likelihood, summed over the texts."""
    inner = np.ones(len(y), bool)
    inner[np.cumsum(lines) - lines] = False
    seen = np.array([[np.sum(inner & (y == 0)), 0], [0, np.sum(inner & (y == 1))]], float)
    p, expected, _ = forward_backward(x @ theta[:-4], lines, theta[-4:].reshape(2, 2))
    return np.concatenate([x.T @ (y - p), (seen - expected).ravel()])


def _climb(gradient, width: int, texts: int, steps: int = STEPS, decay: float = DECAY) -> Crf:
    """Adam on the mean over ``texts`` of ``gradient(theta)``."""
    theta = np.zeros(width + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        g = gradient(theta) / max(texts, 1) - decay * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Crf(theta[:-4], theta[-4:].reshape(2, 2))


def fit(features: np.ndarray, lines: np.ndarray, labels: np.ndarray, steps: int = STEPS, decay: float = DECAY) -> Crf:
    """Maximum likelihood by Adam; ``labels`` (0 or 1) hold for all lines of a text."""
    x = with_neighbours(features, lines).astype(np.float64)
    y = np.repeat(labels, lines).astype(np.float64)
    return _climb(lambda theta: _gradient(theta, x, y, lines), x.shape[1], len(lines), steps, decay)


def _sum_gradients(theta: np.ndarray, width: int, batches):
    total = np.zeros_like(theta)

    def add(texts, labels):
        lines = np.array([len(t) for t in texts])
        x = with_neighbours(np.concatenate(texts), lines).astype(np.float64)
        total[:] += _gradient(theta, x, np.repeat(labels, lines).astype(np.float64), lines)

    for batch in batches:
        texts, labels, held = [], [], 0
        for quality, features in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            texts.append(np.frombuffer(features.as_buffer(), np.float32).reshape(-1, width))
            labels.append(quality)
            held += len(texts[-1])
            if held >= SLAB_LINES:
                add(texts, labels)
                texts, labels, held = [], [], 0
        if texts:
            add(texts, labels)
    yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["gradient"])


def fit_on_spark(sample: DataFrame, width: int, texts: int, steps: int = STEPS) -> Crf:
    """``fit`` of rows (quality, features), with a job a step: only sums of gradients come to the driver."""
    slim = sample.select("quality", "features")

    def gradient(theta):
        rows = slim.mapInArrow(partial(_sum_gradients, theta, width), "gradient array<double>").collect()
        return np.sum([r["gradient"] for r in rows], 0)

    return _climb(gradient, 3 * width + 1, texts, steps)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learnt from: crc32 of the id as text, mod 5, is 0 (null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def _sample_features(batches):
    hasher = WordHasher()
    for batch in batches:
        for part, texts in text_slabs(batch):
            features, lines, _ = line_features(texts, hasher)
            at, rows = 0, []
            for n in lines:
                rows.append(features[at:at + n].tobytes())
                at += n
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lines, pa.int64()), pa.array(rows, pa.binary())],
                                             ["doc_id", "quality", "lines", "features"])


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Crf:
    """CRF from all lines of at most ``most`` labelled documents that are not held out, chosen by hash.

    Several labels of one document give their mean, rounded. Null labels, ids
    and documents without a label are not used. Without any labelled document
    all weights are 0 and every score is one half.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.round(F.avg("quality")).cast("int").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)      # bounds the broadcast
    sample = cut(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
                 .mapInArrow(_sample_features, "doc_id long, quality int, lines long, features binary"), "crf-sample")
    size = sample.agg(F.count(F.lit(1)).alias("texts"), F.sum("lines").alias("lines")).first()
    width = line_features([b""], WordHasher())[0].shape[1]
    if not size["texts"]:
        return Crf(np.zeros(3 * width + 1), np.zeros((2, 2)))
    if size["lines"] > DRIVER_LINES:
        return fit_on_spark(sample, width, size["texts"])
    rows = sample.select("doc_id", "quality", "features").toPandas().sort_values(["doc_id", "features"])
    parts = [np.frombuffer(x, np.float32).reshape(-1, width) for x in rows["features"]]
    return fit(np.concatenate(parts), np.array([len(p) for p in parts]), rows["quality"].to_numpy())


def _score(model: Crf, batches):
    hasher = WordHasher()
    for batch in batches:
        for part, texts in text_slabs(batch):
            features, lines, weight = line_features(texts, hasher)
            good = model.marginals(features, lines)
            at = np.cumsum(lines) - lines
            score = np.clip(np.add.reduceat(good * weight, at) / np.add.reduceat(weight, at), 0, 1)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], [*part.schema.names, "_score"])


def score_documents(docs: DataFrame, model: Crf) -> DataFrame:
    """``docs`` with ``_score``: the length-weighted mean marginal of its lines, 0 to 1.

    Null and empty texts have one empty line, which the model scores. All
    columns stay; the scores come from the text alone.
    """
    schema = StructType([*docs.schema.fields, StructField("_score", DoubleType())])
    return docs.mapInArrow(partial(_score, model), schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document (repeated rows each)."""
    slim = docs.select("doc_id", "text")
    scored = score_documents(slim, train(slim, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"),
                         (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
