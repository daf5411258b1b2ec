"""Document quality by a linear-chain conditional random field over lines.

Each line is good or bad. Its features are surface statistics of the line itself, of the line before and of the line
after; the chain adds a weight for each pair of neighbouring labels. Training maximises the conditional likelihood of
line labels (each labelled document's lines carry its label) with an L2 penalty; scoring runs forward-backward and
averages the marginals P(good), weighted by the lines' lengths. A logistic curve fitted on the training documents' own
averages turns the average into the chance of label 1, so that a threshold means the same for any mixture of lines.

Training uses a bounded sample of labelled rows: the ``max_train_docs`` least by hash, documents of over
``max_train_lines`` lines left out of training only. Its features (a few numbers per line) are gathered on the driver;
scoring covers every line of every text, batch by batch, with no state but the weights.

Defined results: null, empty and blank texts have no line with content and get the training documents' share of good
ones; without any labelled training row every weight is zero and every score 0.5; repeated rows score alike; null labels
do not train; extra columns are kept and not looked at; score and feature code never sees labels, language or source.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .wordscan import IS_SPACE, Block, blocks, doc_of, span_hashes

MAX_TRAIN_DOCS = 4000
MAX_TRAIN_LINES = 100
#: Steps of training and its L2 penalty.
STEPS, PENALTY = 150, 1e-4

# The byte classes that the line features count.
_CLASSES = (b"#*$%&<>", b"|", b"!?", b"0123456789", b".,;:", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"/=_~^@\\[]{}")
FEATURES = len(_CLASSES) + 8
WIDTH = 3 * FEATURES + 3

_FLAGS = np.zeros((len(_CLASSES), 256), np.int8)
for _i, _c in enumerate(_CLASSES):
    _FLAGS[_i, list(_c)] = 1


def _per_span(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    c = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=c[1:])
    return c[ends] - c[starts]


def own_features(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features [lines, FEATURES], weight of each line in characters, first line of each text)."""
    starts, ends, first = block.lines()
    data = block.data
    solid = _per_span(~IS_SPACE[data], starts, ends)
    w_starts, w_ends, w_first = block.words()
    w0, w1 = np.searchsorted(w_starts, starts), np.searchsorted(w_starts, ends)
    words = w1 - w0
    w_hash = span_hashes(data, w_starts, w_ends)
    again = np.zeros((2, len(w_hash)), bool)  # words equal to the one, or to the second one, before
    for back in (1, 2):
        again[back - 1, back:] = w_hash[back:] == w_hash[:-back]
        for edge in range(back):
            at = w_first[:-1] + edge
            again[back - 1, at[at < w_first[1:]]] = False
    size = np.maximum(solid, 1).astype(np.float32)
    own = np.zeros((len(starts), FEATURES), np.float32)
    for i in range(len(_CLASSES)):
        own[:, i] = np.sqrt(_per_span(_FLAGS[i][data], starts, ends) / size)
    k = len(_CLASSES)
    own[:, k] = np.log1p(solid) / 5
    own[:, k + 1] = np.log1p(words) / 5
    own[:, k + 2] = np.minimum(solid / np.maximum(words, 1), 40) / 10
    own[:, k + 3] = solid == 0
    doc = doc_of(first)
    h = span_hashes(data, starts, ends)
    order = np.lexsort((h, doc))
    same = np.zeros(len(h), bool)
    same[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    later = np.zeros(len(h), bool)
    later[order[:-1]] = same[order[1:]]
    own[:, k + 4] = (same | later) & (solid > 0)
    own[:, k + 5] = own[:, k + 4] * np.minimum(solid, 200) / 200
    for back in (0, 1):
        own[:, k + 6 + back] = np.sqrt(_per_span(again[back], w0, w1) / np.maximum(words, 1))
    return own, solid.astype(np.float64), first


def line_features(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features with neighbours [lines, WIDTH], weight of each line in characters, first line of each text)."""
    own, weight, first = own_features(block)
    x = np.zeros((len(own), WIDTH), np.float32)
    x[:, :FEATURES] = own
    x[1:, FEATURES : 2 * FEATURES] = own[:-1]
    x[:-1, 2 * FEATURES : 3 * FEATURES] = own[1:]
    x[first[:-1], FEATURES : 2 * FEATURES] = 0
    x[first[1:] - 1, 2 * FEATURES : 3 * FEATURES] = 0
    x[:, -3] = 1
    x[first[:-1], -2] = 1
    x[first[1:] - 1, -1] = 1
    return x, weight, first


def line_scores(block: Block, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(``line_features`` times ``emit``, weight, first line), without the wide table of neighbours' features."""
    own, weight, first = own_features(block)
    before, after = (own @ emit[k * FEATURES : (k + 1) * FEATURES] for k in (1, 2))
    scores = own @ emit[:FEATURES] + emit[-3]
    inner = np.ones(len(own), bool)
    inner[first[:-1]] = False  # lines with one before them in their text
    at = np.flatnonzero(inner)
    scores[at] += before[at - 1]
    scores[at - 1] += after[at]
    scores[first[:-1]] += emit[-2]
    scores[first[1:] - 1] += emit[-1]
    return scores, weight, first


@dataclass
class Crf:
    """``emit``: weights of label good (bad has 0); ``trans[a, b]``: weight of label a followed by b; ``blank``: score of no
    text; ``slope``, ``shift``: the logistic curve of the weighted mean."""

    emit: np.ndarray
    trans: np.ndarray
    blank: float
    slope: float = 0.0
    shift: float = 0.0

    def calibrated(self, mean: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * mean + self.shift)))


def marginals(scores: np.ndarray, trans: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(P(good) of each line, expected pair counts [2, 2], log partition) by forward-backward over all texts at once.

    Step s takes line s of every text that has one; texts stand in falling order of their lines, so these are the first ones
    and everything is kept by line: memory follows the lines, however they are spread over texts.
    """
    good = np.empty(len(scores))
    pairs = np.zeros((2, 2))
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    start = first[:-1][order]
    steps = int(n.max()) if len(n) else 0
    if not steps:
        return good, pairs, 0.0
    width = len(n) - np.searchsorted(np.sort(n), np.arange(steps), "right")  # texts with more than s lines
    fwd = np.empty((len(scores), 2))
    log_z = 0.0
    top = np.maximum(scores, 0)
    e = np.stack([np.exp(-top), np.exp(scores - top)], axis=1)  # scaled emissions of bad, good
    t = np.exp(trans)
    for s in range(steps):
        rows = start[: width[s]] + s
        a = e[rows] if s == 0 else (fwd[rows - 1] @ t) * e[rows]
        z = a.sum(axis=1, keepdims=True)
        fwd[rows] = a / z
        log_z += float(np.log(z).sum() + top[rows].sum())
    back = np.ones((len(n), 2))
    for s in range(steps - 1, -1, -1):
        rows = start[: width[s]] + s
        b = np.ones((width[s], 2))
        if s + 1 < steps and width[s + 1]:
            here = rows[: width[s + 1]]
            eb = e[here + 1] * back[: width[s + 1]]
            b[: width[s + 1]] = eb @ t.T
            joint = fwd[here][:, :, None] * t[None] * eb[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b /= b.sum(axis=1, keepdims=True)
        back[: width[s]] = b
        p = fwd[rows] * b
        good[rows] = p[:, 1] / p.sum(axis=1)
    return good, pairs, log_z


def _logistic(mean: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a small penalty (separable classes stay finite)."""
    z = np.stack([mean, np.ones(len(mean))], axis=1)
    b = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        g = z.T @ (y - p) - 0.1 * b
        h = (z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(2)
        b = b + np.clip(np.linalg.solve(h, g), -5, 5)
    return float(b[0]), float(b[1])


def _means(good: np.ndarray, weight: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted mean of the lines' marginals of each text, and whether the text has any weight."""
    c = np.concatenate([[0], np.cumsum(weight)])
    g = np.concatenate([[0], np.cumsum(weight * good)])
    total = c[first[1:]] - c[first[:-1]]
    return (g[first[1:]] - g[first[:-1]]) / np.maximum(total, 1), total > 0


def train(x: np.ndarray, weight: np.ndarray, first: np.ndarray, labels: np.ndarray, steps: int = STEPS, penalty: float = PENALTY) -> Crf:
    """Adam ascent on the mean conditional log-likelihood of the line labels."""
    n = len(x)
    if not n:
        return Crf(np.zeros(x.shape[1]), np.zeros((2, 2)), 0.5)
    y = np.repeat(labels, np.diff(first)).astype(np.float64)
    inner = np.ones(n, bool)
    inner[first[1:] - 1] = False
    i = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[i].astype(int), y[i + 1].astype(int)), 1)
    emit, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    m, v = np.zeros(emit.size + 4), np.zeros(emit.size + 4)
    for step in range(1, steps + 1):
        good, pairs, _ = marginals(x @ emit, trans, first)
        g = np.concatenate([x.T @ (y - good), (seen - pairs).ravel()]) / n
        g -= penalty * np.concatenate([emit, trans.ravel()])
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        emit += move[:-4]
        trans += move[-4:].reshape(2, 2)
    mean, full = _means(marginals(x @ emit, trans, first)[0], weight, first)
    return Crf(emit, trans, float(labels.mean()), *_logistic(mean[full], labels[full]))


def quality_scores(texts: pa.Array, model: Crf) -> np.ndarray:
    """Length-weighted mean of P(good) over each text's lines."""
    out = np.full(len(texts), model.blank)
    for block in blocks(texts):
        scores, weight, first = line_scores(block, model.emit)
        good, _, _ = marginals(scores, model.trans, first)
        mean, full = _means(good, weight, first)
        part = np.where(full, model.calibrated(mean), model.blank)
        out[block.first_row : block.first_row + block.rows] = part
    return out


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        max_docs: int = MAX_TRAIN_DOCS, max_lines: int = MAX_TRAIN_LINES) -> Crf:
    """Train on the ``max_docs`` labelled rows of least hash (``labels``: doc_id and a 0/1 column)."""
    sample = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("__id"))
        .agg(F.min(label).alias("__y"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(max_docs)
    )
    lines = F.size(F.split(text_or_empty(text), "\n"))
    chosen = docs.join(F.broadcast(sample), F.col(doc_id) == F.col("__id")).where(lines <= max_lines)

    def featured(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                x, weight, first = line_features(block)
                x = np.concatenate([x, weight[:, None].astype(np.float32)], axis=1)
                rows = pa.array(np.arange(block.first_row, block.first_row + block.rows))
                cells = [x[first[r] : first[r + 1]].tobytes() for r in range(block.rows)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(2).take(rows), pa.array(cells, pa.binary())], names=["id", "y", "x"]
                )

    got = (
        chosen.select(F.col(doc_id).cast("string").alias("id"), text_or_empty(text).alias("t"), F.col("__y").cast("int").alias("y"))
        .mapInArrow(featured, "id string, y int, x binary")
        .toArrow()
    ).sort_by([("id", "ascending"), ("y", "ascending")])
    xs = [np.frombuffer(b.as_py(), np.float32).reshape(-1, WIDTH + 1) for b in got.column("x")]
    first = np.concatenate([[0], np.cumsum([len(a) for a in xs])]).astype(np.int64)
    x = np.concatenate(xs) if xs else np.empty((0, WIDTH + 1), np.float32)
    return train(x[:, :-1], x[:, -1].astype(float), first, np.array(got.column("y").to_pylist(), float))


def score_column(model: Crf, text: str = "text") -> Column:
    """Quality of a text column, 0 to 1."""

    @F.arrow_udf("double")
    def quality(texts: pa.Array) -> pa.Array:
        return pa.array(quality_scores(texts, model), pa.float64())

    return quality(F.col(text).cast("string"))
