"""Quality classifier: a linear-chain conditional random field labels every line of a text good or bad.

A line is described by shares of character classes, word lengths and repetition, its own and those of the
lines before and after it. The field is trained on documents with a label, every line bearing its
document's label. A document's score is the mean of its lines' forward-backward marginals for good,
weighted by length, on a logistic scale fitted to the same documents. Labels, language, source and doc_id are no inputs of a score.

Training takes a bounded sample: the `sample` labelled documents outside the held-out fifth that come
first in an order drawn by hashing doc_id, and of each a stretch of at most `most_lines` lines, which begins
where a hash of the text says. Only those lines' features reach the driver: 120 bytes a line, 180 MB at most.

Defined cases: a null text is an empty one, which is one empty line and has a score as any other; the
length of a text is not limited; repeated rows each give a row; labels that repeat a doc_id count once,
by their smallest quality, and documents that repeat one are trained on by their smallest text; null labels are left out; without labels of both kinds the score is the share
of label 1 (0.5 without labels); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, utf8

THRESHOLD = 0.3
#: Classes of bytes: upper case, lower case, digit, white space, symbol, bar, exclamation, sentence mark, other ASCII, other.
CLASSES = 10
CLASS_OF = np.full(256, 9, np.uint8)
CLASS_OF[:128] = 8
for number, chars in enumerate([b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\x0b\x0c\r", b"#*$%&<>@^~=_+{}[]\\/", b"|", b"!", b".,;:?'\"()-"]):
    CLASS_OF[list(chars)] = number
OWN = CLASSES + 9
WIDTH = 3 * OWN + 3


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A row of OWN features for each line, and the lines' lengths in bytes (1 at least)."""
    data = utf8(text)
    codes = np.frombuffer(data, np.uint8)
    ends = np.r_[np.flatnonzero(codes == 10), len(codes)]
    line = np.zeros(len(codes), np.int64)
    line[ends[:-1]] = 1
    line = np.cumsum(line) - line  # a line feed belongs to the line that it ends
    n = len(ends)
    counts = np.bincount(line * CLASSES + CLASS_OF[codes], minlength=n * CLASSES).reshape(n, CLASSES).astype(np.float64)
    length = np.maximum(counts.sum(axis=1), 1)
    lines = data.split(b"\n")
    words = [x.split() for x in lines]
    many = np.array([len(w) for w in words], np.float64)
    safe = np.maximum(many, 1)
    distinct = np.array([len(set(w)) for w in words]) / safe
    marked = np.array([sum(map(w.count, {x for x in set(w) if not x[-1:].isalnum() and x[-1:] < b"\x80"})) if w else 0 for w in words]) / safe
    doubled = np.array([sum(map(bytes.__eq__, w, w[1:])) for w in words]) / safe
    seen: set[bytes] = set()
    repeat = np.array([1.0 if x in seen or seen.add(x) else 0.0 for x in lines])
    shares = counts / length[:, None]
    mean_word = (length - counts[:, 3]) / safe / 20
    extra = [np.log1p(many) / 8, 1 - distinct, doubled, marked, np.minimum(mean_word, 2), repeat, many == 0, shares[:, 0] > 0.3, shares[:, 4:7].sum(axis=1) > 0.02]
    return np.column_stack([np.sqrt(shares), *extra]), length


def neighboured(own: np.ndarray) -> np.ndarray:
    """A row of WIDTH for each line: its own features, the previous and the next line's, a constant and marks of the ends."""
    none = np.zeros((1, OWN))
    ends = np.zeros((len(own), 3))
    ends[:, 0], ends[0, 1], ends[-1, 2] = 1, 1, 1
    return np.hstack([own, np.vstack([none, own[:-1]]), np.vstack([own[1:], none]), ends])


@dataclass
class Model:
    """weights: of label good against bad by feature; moves[a, b]: of label b after label a; scale: slope and
    intercept from a mean marginal's logit to the score's; base: the score where there is no field."""

    weights: np.ndarray
    moves: np.ndarray
    base: float | None = None
    scale: tuple[float, float] = (1.0, 0.0)


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def passes(unary: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log forward and backward tables of (sequences, lines, 2) and the log partition; rows past a length are not valid."""
    n, steps = unary.shape
    score = np.stack([np.zeros_like(unary), unary], axis=2)
    ahead, back = np.empty((n, steps, 2)), np.zeros((n, steps, 2))
    ahead[:, 0] = score[:, 0]
    for t in range(1, steps):
        ahead[:, t] = log_sum(ahead[:, t - 1, :, None] + moves, 1) + score[:, t]
    for t in range(steps - 2, -1, -1):
        new = log_sum(moves + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        back[:, t] = np.where((t + 1 < lengths)[:, None], new, 0)
    return ahead, back, log_sum(ahead[np.arange(n), lengths - 1], 1)


def buckets(lengths: np.ndarray, cells: int = 200_000) -> list[np.ndarray]:
    """Indexes of sequences of like length, so many that padding stays below twice and a bucket below `cells`."""
    out, order = [], np.argsort(lengths, kind="stable")
    while len(order):
        least = lengths[order[0]]
        most = np.searchsorted(lengths[order], 2 * least, side="right")
        most = max(1, min(int(most), cells // int(2 * least) + 1))
        out.append(order[:most])
        order = order[most:]
    return out


def padded(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequences, longest) of values, and of which cells are valid."""
    valid = np.arange(lengths.max())[None, :] < lengths[:, None]
    out = np.zeros(valid.shape)
    out[valid] = values[np.repeat(starts, lengths) + np.concatenate([np.arange(n) for n in lengths])]
    return out, valid


def marginals(unary: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each line of all sequences, one after another, the probability of good."""
    starts, out = np.cumsum(lengths) - lengths, np.empty(len(unary))
    for chosen in buckets(lengths):
        own = lengths[chosen]
        cells, valid = padded(unary, starts[chosen], own)
        ahead, back, total = passes(cells, moves, own)
        out[np.repeat(starts[chosen], own) + np.concatenate([np.arange(n) for n in own])] = np.exp(ahead[:, :, 1] + back[:, :, 1] - total[:, None])[valid]
    return out


def train(features: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, labels: np.ndarray, rounds: int = 120, decay: float = 1e-3) -> Model:
    """Maximum likelihood with a penalty, by adaptive gradient steps over all sequences."""
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(WIDTH), np.zeros((2, 2)), float(labels.mean()) if len(labels) else 0.5)
    starts, parts = np.cumsum(lengths) - lengths, []
    for chosen in buckets(lengths):
        own = lengths[chosen]
        rows = np.repeat(starts[chosen], own) + np.concatenate([np.arange(n) for n in own])
        parts.append((features[rows], own, np.repeat(labels[chosen], own), labels[chosen]))
    theta, first, second = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
    for k in range(1, rounds + 1):
        weights, moves = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
        slope = np.zeros_like(theta)
        for x, own, line_labels, doc_labels in parts:
            cells, valid = padded(x @ weights, np.cumsum(own) - own, own)
            ahead, back, total = passes(cells, moves, own)
            good = np.exp(ahead[:, :, 1] + back[:, :, 1] - total[:, None])[valid]
            slope[:WIDTH] += x.T @ (line_labels - good)
            if cells.shape[1] > 1:
                score = np.stack([np.zeros_like(cells), cells], axis=2)
                both = np.exp(ahead[:, :-1, :, None] + moves + (score + back)[:, 1:, None, :] - total[:, None, None, None])
                expected = (both * valid[:, 1:, None, None]).sum(axis=(0, 1))
                seen = np.zeros((2, 2))
                seen[1, 1], seen[0, 0] = ((own - 1) * doc_labels).sum(), ((own - 1) * (1 - doc_labels)).sum()
                slope[WIDTH:] += (seen - expected).ravel()
        slope = slope / len(features) - decay * theta
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta += 0.15 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    model = Model(theta[:WIDTH], theta[WIDTH:].reshape(2, 2))
    model.scale = logistic(logit(document_means(features @ model.weights, sizes, model.moves, lengths)), labels)
    return model


def document_means(unary: np.ndarray, sizes: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    starts = np.cumsum(lengths) - lengths
    return np.add.reduceat(marginals(unary, moves, lengths) * sizes, starts) / np.add.reduceat(sizes, starts)


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def logistic(x: np.ndarray, labels: np.ndarray, penalty: float = 1.0) -> tuple[float, float]:
    """Slope and intercept of a penalised logistic regression, by Newton's method."""
    rows, theta = np.column_stack([x, np.ones_like(x)]), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ theta, -30, 30)))
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + penalty * np.eye(2)
        theta = theta + np.linalg.solve(hessian, rows.T @ (labels - p) - penalty * theta)
    return float(theta[0]), float(theta[1])


def scores(texts: list[str | None], model: Model) -> np.ndarray:
    if model.base is not None:
        return np.full(len(texts), model.base)
    unary, sizes = [], []
    for text in texts:
        own, size = line_features(text)
        unary.append(neighboured(own) @ model.weights)
        sizes.append(size)
    lengths = np.array([len(x) for x in sizes])
    means = document_means(np.concatenate(unary), np.concatenate(sizes), model.moves, lengths)
    return 1 / (1 + np.exp(-np.clip(model.scale[0] * logit(means) + model.scale[1], -30, 30)))


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def stretch(rows: np.ndarray, text: str | None, most: int) -> np.ndarray:
    """At most `most` consecutive rows, from a place that depends on the text alone."""
    spare = len(rows) - most
    start = zlib.crc32(utf8(text)) % (spare + 1) if spare > 0 else 0
    return rows[start : start + most]


def fitted(docs: DataFrame, labels: DataFrame, sample: int = 3000, most_lines: int = 500) -> Model:
    known = labels.selectExpr("cast(doc_id as long) doc_id", "quality").where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64(F.col("doc_id")), "doc_id").limit(sample)
    # `sample` rows of two numbers: their size is bounded whatever the table's
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality"))

    def batch(columns: dict[str, list]) -> dict[str, object]:
        rows = [stretch(np.column_stack(line_features(t)).astype(np.float32), t, most_lines) for t in columns["text"]]
        return {"doc_id": pa.array(columns["doc_id"], pa.int64()), "quality": pa.array(columns["quality"], pa.int32()), "features": pa.array([x.tobytes() for x in rows], pa.binary())}

    rows = map_batches(texts.selectExpr("doc_id", "text", "cast(quality as int) quality"), batch, "doc_id long, quality int, features binary").collect()
    rows.sort(key=lambda r: r["doc_id"])
    if not rows:
        return Model(np.zeros(WIDTH), np.zeros((2, 2)), 0.5)
    own = [np.frombuffer(r["features"], np.float32).reshape(-1, OWN + 1).astype(np.float64) for r in rows]
    return train(np.vstack([neighboured(x[:, :-1]) for x in own]), np.concatenate([x[:, -1] for x in own]), np.array([len(x) for x in own]), np.array([r["quality"] for r in rows]))


def scored(docs: DataFrame, labels: DataFrame, sample: int = 3000) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fitted(docs, labels, sample)

    def batch(columns: dict[str, list]) -> dict[str, object]:
        values = scores(columns["text"], model)
        return {"doc_id": pa.array(columns["doc_id"], pa.int64()), "score": pa.array(values), "predicted": pa.array((values >= THRESHOLD).astype(np.int32))}

    rows = map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), batch, "doc_id long, score double, predicted int")
    return rows.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame, sample: int = 3000) -> DataFrame:
    """The rows of `docs` that are predicted good, as they are."""
    model = fitted(docs, labels, sample)

    @F.pandas_udf("boolean")
    def good(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(scores([None if t is None or t != t else t for t in texts], model) >= THRESHOLD)

    return docs.where(good("text"))
