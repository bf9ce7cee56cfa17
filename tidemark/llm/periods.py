"""Periodic runs of words, found on the diagonals of a sparse table of earlier occurrences.

A run is a stretch of at least ``max(shortest, repeats * q)`` words with smallest period q that cannot be extended.
Word i continues the diagonal of lag q when word i - q is the same; a diagonal that ends after enough matches is a run.

Which earlier occurrences of a word are worth following: periods are taken in classes (m/2, m], m a power of two, and a
word counts as occurring again only where the m words from it on do. Inside a run of period q <= m the *nearest*
such earlier occurrence lies exactly q words back: a nearer one would give the run a smaller period (Fine and Wilf). So every
place has at most one active lag a class, a diagonal is a maximal stretch of places with one lag, its periods are the
smallest ones without a further test, and a text of n equal words costs n log n, not n squared. Numbers of 2m
words are pairs of numbers of m words, exact, and places whose m words stand once in the document are left out of all
later classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, texts

#: Bytes of text whose words are held at once; a longer text is a slice of its own.
SLICE_BYTES = 3 << 20

Run = tuple[int, int, int]
Prepare = Callable[[int | None, list[bytes]], list[bytes]]


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _numbered(docs: list[list[bytes]]) -> np.ndarray:
    """Numbers of the words of all documents, one after another with -1 after each; equal only in one document."""
    numbers = _Numbers()
    total = sum(map(len, docs)) + len(docs)
    flat, at = np.full(total, -1, np.int64), 0
    for words in docs:
        numbers_of = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        flat[at : at + len(words)] = numbers_of
        at += len(words) + 1
    doc = np.cumsum(flat < 0)
    return np.where(flat < 0, -1, doc * max(len(numbers), 1) + flat)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Dense numbers of the keys, -1 for keys below 0 and keys that occur once."""
    out = np.full(len(keys), -1, np.int64)
    places = np.flatnonzero(keys >= 0)
    if len(places):
        _, number, count = np.unique(keys[places], return_inverse=True, return_counts=True)
        again = count[number] > 1
        out[places[again]] = number[again]
    return out


def _diagonals(number: np.ndarray, width: int, above: int) -> Iterator[tuple[int, int, int]]:
    """(first place, last place, lag) of maximal stretches of places whose nearest earlier occurrence is lag back."""
    places = np.flatnonzero(number >= 0)
    order = places[np.argsort(number[places], kind="stable")]
    same = number[order[1:]] == number[order[:-1]]
    lag = np.where(same, order[1:] - order[:-1], 0)
    fits = (lag > above) & (lag <= width)
    place, lag = order[1:][fits], lag[fits]
    if not len(place):
        return
    by_place = np.argsort(place)
    place, lag = place[by_place], lag[by_place]
    breaks = np.flatnonzero((np.diff(place) != 1) | (np.diff(lag) != 0)) + 1
    starts, ends = np.r_[0, breaks], np.r_[breaks, len(place)] - 1
    yield from zip(place[starts].tolist(), place[ends].tolist(), lag[starts].tolist())


def find_runs(docs: list[list[bytes]], shortest: int = 24, repeats: int = 3) -> list[list[Run]]:
    """(start, length, period) of every run of every document, by start, then period."""
    if repeats < 3 or shortest < repeats:
        raise ValueError("runs have at least three repeats and as many words as repeats")
    found: list[list[Run]] = [[] for _ in docs]
    begins = np.cumsum([0] + [len(d) + 1 for d in docs])
    # The widest power of two that fits the matches of every run, whatever its period.
    matches = min(max(shortest - q, (repeats - 1) * q) for q in range(1, shortest + 1))
    first = 1 << (matches.bit_length() - 1)
    number, width = _repeated(_numbered(docs)), 1
    while (number >= 0).any():
        if width >= first:
            for a, b, q in _diagonals(number, width, 0 if width == first else width // 2):
                length = b - a + width + q
                if length >= max(shortest, repeats * q):
                    doc = int(np.searchsorted(begins, a, side="right")) - 1
                    found[doc].append((a - q - int(begins[doc]), length, q))
        if width >= len(number):
            break
        left, right = number[:-width], number[width:]
        pair = np.where((left >= 0) & (right >= 0), left * (int(number.max()) + 1) + right, -1)
        number = _repeated(np.r_[pair, np.full(width, -1, np.int64)])
        width *= 2
    return [sorted(set(runs), key=lambda r: (r[0], r[2])) for runs in found]


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that some run contains after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length by period, compared exactly; ties: smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _documents(batch: pa.RecordBatch, id_column: str, text: str, prepare: Prepare | None, shortest: int, repeats: int):
    """(words, runs) of every row."""
    raw = texts(batch.column(text))
    ids = batch.column(id_column).to_pylist() if prepare else None
    for a, b in slices(np.array([len(t) + 1 for t in raw]), SLICE_BYTES):
        docs = [t.split() for t in raw[a:b]]
        if prepare:
            docs = [prepare(i, words) for i, words in zip(ids[a:b], docs)]
        yield from zip(docs, find_runs(docs, shortest, repeats))


def collapse_runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shortest: int = 24, repeats: int = 3) -> DataFrame:
    """All rows and columns, with ``runs`` (array of start, length, period, by start and period) and ``collapsed``, the words left
    over joined by one space.

    Words are what ASCII white space parts. Null and empty texts have no runs and an empty ``collapsed``; ids may be null or repeat,
    every row is judged alone. Columns named ``runs`` and ``collapsed`` are replaced. No shuffle; a task holds some MB of text,
    or one text.
    """
    rest = [c for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, left = [], []
            for words, own in _documents(batch, id_column, text, None, shortest, repeats):
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
                left.append(b" ".join(collapse(words, own)))
            columns = [*batch.columns, pa.array(runs, kind), pa.array(left, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "runs", "collapsed"])

    schema = docs.select(*rest, F.lit(None).cast("array<struct<start:bigint,length:bigint,period:bigint>>").alias("runs"), F.lit("").alias("collapsed")).schema
    return docs.select(*rest).mapInArrow(run, schema)


def digests(docs: DataFrame, prepare: Prepare | None = None, shortest: int = 24, repeats: int = 3) -> DataFrame:
    """doc_id, n_runs, the strongest run, and checksums of all runs and of the words left over; texts stay in their tasks.

    ``prepare`` may change a document's words before. Nulls, empty texts and repeated rows as in ``collapse_runs``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, best, listed, left = [], [], [], []
            for words, own in _documents(batch, "doc_id", "text", prepare, shortest, repeats):
                count.append(len(own))
                best.append(strongest(own) or (None, None, None))
                lines = "".join(f"{s},{n},{p}\n" for s, n, p in own)
                listed.append(hashlib.sha256(lines.encode()).hexdigest())
                left.append(hashlib.sha256(b" ".join(collapse(words, own))).hexdigest())
            start, length, period = (pa.array([b[k] for b in best], pa.int64()) for k in range(3))
            milli = pa.array([None if n is None else 1000 * n // p for _, n, p in best], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), start, length, period, milli, pa.array(listed, pa.string()), pa.array(left, pa.string())],
                ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
            )

    narrow = docs.select("doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(
        run, f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    )
