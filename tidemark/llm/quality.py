"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad; its features are shares of character classes, word and line lengths and repetition, of the
line and of its neighbours. The field is fitted on a bounded sample of labelled documents, whose lines take the
document's label. A document's quality is the mean of its lines' marginals from forward-backward, weighted by
length, put through a logistic curve fitted on the same sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_BYTES, map_batches, slices, texts

#: Bounds of the fit: labelled documents, and lines of one of them (longer ones are not in the sample).
SAMPLE, SAMPLE_LINES = 4000, 2000
THRESHOLD = 0.3
#: Character classes by byte.
_GROUPS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\x0b\x0c", ".,;:", "!?", "|", "#$%&*@^~<>{}[]\\/=+_", "\"'()-`")
_CLASS = np.full(256, len(_GROUPS), np.uint8)
for _k, _group in enumerate(_GROUPS):
    _CLASS[list(_group.encode())] = _k
_CLASS[128:] = len(_GROUPS) + 1
_CLASSES = len(_GROUPS) + 2
#: Own features of a line: class shares, four ratios to words, upper-case share, word length, log length, repeats the line before, empty, share of words that repeat the word before.
OWN = _CLASSES + 10


def _marks(flat: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A hash of each stretch of bytes; zero bytes do not count."""
    flat, begins = flat[begins[0] :], begins - begins[0]
    place = np.arange(len(flat), dtype=np.uint64) - np.repeat(begins, np.diff(np.append(begins, len(flat)))).astype(np.uint64)
    weighed = flat.astype(np.uint64) * (place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03))
    return np.add.reduceat(weighed ^ (weighed >> np.uint64(29)), begins)


def line_features(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features per line, line lengths in bytes plus 1, lines per text). A text without bytes is one empty line."""
    lines = np.array([t.count(b"\n") + 1 for t in data], np.int64)
    flat = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    ends = np.flatnonzero(flat == 10)
    begins = np.concatenate([[0], ends[:-1] + 1])
    n = ends - begins
    row = np.repeat(np.arange(len(n)), n + 1)
    counts = np.bincount(row * _CLASSES + _CLASS[flat], minlength=len(n) * _CLASSES).reshape(len(n), _CLASSES).astype(np.float64)
    counts[:, len(_GROUPS)] -= 1  # the line's end itself
    size = np.maximum(n, 1)[:, None]
    words = np.maximum(counts[:, 3:4] + (n[:, None] > 0), 1)
    letters = np.maximum(counts[:, 0:1] + counts[:, 1:2], 1)
    marks = np.minimum(counts[:, [2, 5, 6, 7]] / words, 3)
    mark = _marks(flat, begins)
    letter = (_CLASS[flat] != 3) & (flat != 10)
    heads = np.flatnonzero(letter & np.concatenate([[True], ~letter[:-1]]))
    again = np.zeros(len(n))
    if len(heads):
        word, home = _marks(np.where(letter, flat, 0), heads), row[heads]
        same = (word[1:] == word[:-1]) & (home[1:] == home[:-1])
        again = np.bincount(home[1:][same], minlength=len(n))
    again = again[:, None] / words
    first = np.zeros(len(n), bool)
    first[np.cumsum(lines) - lines] = True
    repeats = np.concatenate([[False], (mark[1:] == mark[:-1]) & (n[1:] == n[:-1])]) & ~first & (n > 0)
    features = np.concatenate(
        [counts / size, marks, counts[:, 1:2] / letters, np.minimum(n[:, None] / words, 40) / 10, np.log1p(n)[:, None] / 5, repeats[:, None], (n == 0)[:, None], again], axis=1
    )
    return features.astype(np.float32), n + 1, lines


def with_neighbours(features: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Features of the line, the line before and the line after (zeros at a text's ends), two flags for those ends and a constant."""
    first, last = np.zeros(len(features), bool), np.zeros(len(features), bool)
    first[np.cumsum(lines) - lines] = True
    last[np.cumsum(lines) - 1] = True
    before, after = np.roll(features, 1, axis=0), np.roll(features, -1, axis=0)
    before[first], after[last] = 0, 0
    return np.concatenate([features, before, after, first[:, None], last[:, None], np.ones((len(features), 1))], axis=1).astype(np.float32)


def marginals(emission: np.ndarray, transition: np.ndarray, lines: np.ndarray, pairs: bool = False):
    """P(good) of every line, by scaled forward-backward over all texts at once; with ``pairs`` also the expected transitions.

    ``emission`` is the log weight of good against bad; ``transition`` the 2 x 2 log weights, bad first.
    """
    weight = np.ones((len(emission), 2))
    weight[:, 1] = np.exp(np.clip(emission, -30, 30))
    step = np.exp(transition)
    order = np.argsort(-lines, kind="stable")
    starts = (np.cumsum(lines) - lines)[order]
    active = np.searchsorted(-lines[order], -np.arange(lines.max(initial=0)), side="left")  # texts longer than t lines
    forward, backward = np.empty_like(weight), np.ones_like(weight)
    for t, k in enumerate(active):
        at = starts[:k] + t
        f = weight[at] if t == 0 else (forward[at - 1] @ step) * weight[at]
        forward[at] = f / f.sum(axis=1, keepdims=True)
    for t in range(len(active) - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        b = (weight[at + 1] * backward[at + 1]) @ step.T
        backward[at] = b / b.sum(axis=1, keepdims=True)
    both = forward * backward
    good = both[:, 1] / both.sum(axis=1)
    if not pairs:
        return good
    later = np.ones(len(emission), bool)
    later[np.cumsum(lines) - lines] = False
    at = np.flatnonzero(later)
    joint = forward[at - 1][:, :, None] * step * (weight[at] * backward[at])[:, None, :]
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    return good, joint


@dataclass(frozen=True)
class Model:
    """A fitted field: centre and scale of the features, emission and transition weights, slope and shift of the last curve."""

    centre: np.ndarray
    scale: np.ndarray
    emission: np.ndarray
    transition: np.ndarray
    slope: float
    shift: float

    def lines(self, features: np.ndarray, lines: np.ndarray) -> np.ndarray:
        x = (with_neighbours(features, lines) - self.centre) / self.scale
        return marginals(x @ self.emission, self.transition, lines)

    def score(self, features: np.ndarray, sizes: np.ndarray, lines: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * _pooled(self.lines(features, lines), sizes, lines) + self.shift)))


def _pooled(good: np.ndarray, sizes: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Log odds of the length-weighted mean of marginals."""
    starts = np.cumsum(lines) - lines
    mean = np.clip(np.add.reduceat(good * sizes, starts) / np.add.reduceat(sizes.astype(np.float64), starts), 1e-3, 1 - 1e-3)
    return np.log(mean / (1 - mean))


def fit(features: np.ndarray, sizes: np.ndarray, lines: np.ndarray, labels: np.ndarray, rounds: int = 120, penalty: float = 1e-3, rate: float = 0.1) -> Model:
    """Gradient steps with adaptive rates on the penalised likelihood of the labels, every document weighing the same.

    Without two labels in the sample the model scores one half everywhere.
    """
    x = with_neighbours(features, lines)
    centre, scale = (x.mean(axis=0), np.maximum(x.std(axis=0), 1e-2)) if len(x) else (np.zeros(3 * OWN + 3), np.ones(3 * OWN + 3))
    centre[-1], scale[-1] = 0, 1
    parameters = np.zeros(x.shape[1] + 4)
    if len(np.unique(labels)) < 2:
        return Model(centre, scale, parameters[:-4], np.zeros((2, 2)), 0.0, 0.0)
    x = (x - centre) / scale
    y = np.repeat(labels.astype(np.float64), lines)
    share = np.repeat(1 / lines, lines) / len(lines)
    later = np.ones(len(x), bool)
    later[np.cumsum(lines) - lines] = False
    seen = np.zeros((2, 2))
    for label in (0, 1):
        seen[label, label] = share[later & (y == label)].sum()
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    for k in range(1, rounds + 1):
        good, joint = marginals(x @ parameters[:-4], parameters[-4:].reshape(2, 2), lines, pairs=True)
        expected = (joint * share[later][:, None, None]).sum(axis=0)
        slope = np.concatenate([x.T @ (share * (good - y)), (expected - seen).ravel()]) + penalty * parameters
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        parameters -= rate * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    transition = parameters[-4:].reshape(2, 2)
    pooled = _pooled(marginals(x @ parameters[:-4], transition, lines), sizes, lines)
    curve = np.stack([pooled, np.ones(len(pooled))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(30):  # Newton steps, lightly penalised
        p = 1 / (1 + np.exp(-curve @ w))
        w -= np.linalg.solve(curve.T @ (curve * (p * (1 - p))[:, None]) + 0.1 * np.eye(2), curve.T @ (p - labels) + 0.1 * (w - [1.0, 0.0]))
    return Model(centre, scale, parameters[:-4], transition, float(w[0]), float(w[1]))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from; null ids count as not held out, but have no label either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_lines: int = SAMPLE_LINES) -> Model:
    """Fits on at most ``sample`` labelled documents, chosen by a hash of their id, never held-out ones.

    Labels without id or quality are ignored; of several labels of a document the mean counts, rounded.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
    chosen = known.groupBy("doc_id").agg(F.round(F.avg("quality")).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select("label", "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for label, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
            features, sizes, lines = line_features([text])
            if lines[0] <= most_lines:
                rows.append((label, features.tobytes(), sizes.astype(np.int64).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2))], ["label", "features", "sizes"])

    rows = map_batches(picked, run, "label int, features binary, sizes binary").collect()  # bounded by the two limits
    rows = sorted((tuple(r) for r in rows), key=lambda r: (bytes(r[1]), r[0]))  # the same model whatever the order of tasks
    features = np.frombuffer(b"".join(r[1] for r in rows), np.float32).reshape(-1, OWN)
    sizes = np.frombuffer(b"".join(r[2] for r in rows), np.int64)
    return fit(features, sizes, np.array([len(r[2]) // 8 for r in rows], np.int64), np.array([r[0] for r in rows], np.int64))


def score_texts(model: Model, data: list[bytes]) -> np.ndarray:
    """The score of every text, some at a time: their lines' features and copies of them are most of what a worker holds."""
    return np.concatenate([model.score(*line_features(data[a:b])) for a, b in slices(np.array([len(t) for t in data]), SLICE_BYTES)])


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with ``score`` (0 to 1, higher: better) and ``predicted`` (1 from the threshold on).

    Whole texts are scored, about a million bytes at a time; null and empty texts count as one empty line. Repeated
    rows get equal scores. An empty table gives an empty one. Old columns score and predicted are replaced.
    """
    columns = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    ready = docs.select(*columns)
    at = columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = score_texts(model, texts(batch.column(at)))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found), pa.array((found >= threshold).astype(np.int32))], [*columns, "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ready.schema)
    return map_batches(ready, run, f"{schema}, score double, predicted int")
