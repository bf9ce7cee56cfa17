"""Substring dedup by relative Lempel-Ziv parsing.

Documents are dealt into blocks of a bounded number of words, and every block is an indexed reference. A document is
parsed greedily against its own block (earlier text only): positions come from an index of word runs of the
window's length, and a factor goes on while the reference does. Factors shorter than a window never matter; windows
that lie across two factors are looked up like all others, so nothing is lost at factor boundaries.

To parse against every other block without pairing all blocks, blocks exchange anchors: the smallest 8-word
hash inside a window, the same wherever the window's words stand. Only windows over anchors that stand in several places
can repeat across blocks; each block sends those it has not already found earlier inside itself, and the
first place of each window is the reference for the rest. So a passage counts once per block, however often it stands there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LAST, free_name, grams, long, map_batches, stored, text_slices, word_hashes

WINDOW, ANCHOR = 20, 8
#: Words of a reference block.
BLOCK = 1_000_000
#: Bytes of text whose words are objects at one time.
SLICE_BYTES = 2 << 20
_ANCHOR_BITS = np.uint64((1 << 40) - 1)


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the least value of every ``width`` consecutive ones, the leftmost of equal ones, by doubling: no copy of a value per window."""
    best, span = np.arange(len(values), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        left, right = best[:-step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        span += step
    return best


def anchors(words: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor hashes of all word positions, position of the anchor of the window at each position)."""
    runs = grams(words, anchor)
    width = window - anchor + 1
    if len(runs) < width:
        return runs, np.zeros(0, np.int64)
    return runs, leftmost_least(runs, width)


def factors(starts: np.ndarray, references: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, number of words) of greedy factors, for windows (positions, ascending) that stand at ``references`` too.

    A factor goes on while position and reference move on together; else another one begins, which may overlap it.
    """
    if not len(starts):
        return starts, starts
    breaks = np.flatnonzero((np.diff(starts) != 1) | (np.diff(references) != 1)) + 1
    first = np.concatenate([[0], breaks])
    last = np.concatenate([breaks, [len(starts)]]) - 1
    return starts[first], starts[last] - starts[first] + window


def parse_block(keys: np.ndarray, ties: np.ndarray, data: list[np.ndarray], window: int, anchor: int) -> list[np.ndarray]:
    """Columns (anchor or -1, key, tie, position, words): factors inside the block, and anchors of its other windows. ``data``: word hashes of each document."""
    order = np.lexsort((ties, keys))
    same = np.concatenate([[False], (np.diff(keys[order]) == 0) & (np.diff(ties[order]) == 0)])
    order = order[~same]  # repeated rows are one document
    parts = [data[i] for i in order]
    n = np.array([len(p) for p in parts], np.int64)
    words = np.concatenate([np.zeros(0, np.uint64), *parts])
    ends = np.cumsum(n)
    doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
    begin = ends - n
    # Positions are 32-bit numbers and what is used up goes at once: the worker shares its memory with the executor.
    own = np.maximum(n - window + 1, 0)
    at = (np.arange(own.sum()) + np.repeat(begin - (np.cumsum(own) - own), own)).astype(np.int32)
    if not len(at):
        return [np.zeros(0, np.int64)] * 5
    values = grams(words, window)[at]
    by = np.argsort(values, kind="stable").astype(np.int32)
    values = values[by]
    fresh = np.concatenate([[True], values[1:] != values[:-1]])
    del values
    reference = np.empty(len(at), np.int32)
    reference[by] = at[by[fresh]][np.cumsum(fresh, dtype=np.int32) - 1]
    del by, fresh
    repeated = reference != at
    # Factors end with their document: make positions of different documents never follow each other.
    starts, refs = at[repeated] + doc[at[repeated]], reference[repeated] + doc[reference[repeated]]
    start, length = factors(starts, refs, window)
    owner = doc[at[repeated]][np.searchsorted(starts, start)] if len(start) else start
    start = start - owner
    hashes, chosen = anchors(words, window, anchor)
    mine = np.unique(chosen[at[~repeated]])
    docs = doc[mine]
    return [
        np.concatenate([np.full(len(start), -1), (hashes[mine] & _ANCHOR_BITS).astype(np.int64)]),
        np.concatenate([keys[order][owner], keys[order][docs]]),
        np.concatenate([ties[order][owner], ties[order][docs]]),
        np.concatenate([start - begin[owner], mine - begin[docs]]),
        np.concatenate([length, np.full(len(mine), anchor)]),
    ]


def _parse(window: int, anchor: int, block: int):
    names = ["anchor", "key", "tie", "position", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            keys, ties = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            out = parse_block(keys, ties, [t for h in held for t in h[2]], window, anchor)
            return pa.RecordBatch.from_arrays([*map(pa.array, out[:3]), *(pa.array(c.astype(np.int32)) for c in out[3:])], names)

        for batch in batches:
            keys, ties = (batch.column(i).to_numpy() for i in (0, 1))
            for a, b, data in text_slices(batch.column(2), SLICE_BYTES):
                parts = [t.split() for t in data]
                ends = np.cumsum([len(p) for p in parts])
                hashes = np.split(word_hashes([w for p in parts for w in p]), ends[:-1])
                del data, parts
                if size and size + int(ends[-1]) > block:
                    yield flush()
                    held, size = [], 0
                held.append((keys[a:b], ties[a:b], hashes))
                size += int(ends[-1])
        if held:
            yield flush()

    return run


def packed(docs: DataFrame, text: str) -> DataFrame:
    """All columns, the text compressed for the shuffles to come: about half of what they make of plain text. Null stays null."""
    at = docs.columns.index(text)
    schema = ", ".join(f"`{f.name}` {'binary' if f.name == text else f.dataType.simpleString()}" for f in docs.schema)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        small = zstandard.ZstdCompressor(level=3)
        data = pa.array([None if t is None else small.compress(t) for t in batch.column(at).cast(pa.binary()).to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays([data if i == at else c for i, c in enumerate(batch.columns)], batch.schema.names)

    return map_batches(docs, run, schema)


def unpacked(column: pa.Array) -> list[bytes]:
    """The texts, empty for null."""
    plain = zstandard.ZstdDecompressor()
    return [b"" if t is None else plain.decompress(t) for t in column.to_pylist()]


def _windows(window: int, anchor: int):
    """Windows over the shared anchors of each document, without those its own block has found to stand earlier."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        hashes, counts, positions = [], [], []
        ties = batch.column(1).to_numpy()
        for tie, text, marks in zip(ties, unpacked(batch.column(2)), batch.column(3)):  # other columns are not looked at
            words = word_hashes(text.split())
            runs, chosen = anchors(words, window, anchor)
            position, length, owner = (marks.values.field(i).to_numpy() for i in range(3))
            marked, known = np.zeros(len(runs), bool), np.zeros(len(chosen) + 1, np.int32)
            marked[position[(length == 0) & (position < len(runs))]] = True  # texts of one id share anchors
            own = (length > 0) & (owner == tie)
            np.add.at(known, position[own], 1)
            np.add.at(known, position[own] + length[own] - window + 1, -1)
            at = np.flatnonzero(marked[chosen] & (np.cumsum(known[:-1]) == 0))
            hashes.append(grams(words, window)[at])
            positions.append(at.astype(np.int32))
            counts.append(len(at))
        keys = np.repeat(batch.column(0).to_numpy(), counts)
        return pa.RecordBatch.from_arrays(
            [long(np.concatenate(hashes)), pa.array(keys), pa.array(np.repeat(ties, counts)), pa.array(np.concatenate(positions))], ["window", "key", "tie", "position"]
        )

    return run


def _apart(key: Column, tie: Column) -> Column:
    """What tells rows without an id apart; 0 for all others."""
    return F.when(key == LAST, tie).otherwise(F.lit(0).cast("long"))


def repeated_spans(keyed: DataFrame, sent: DataFrame, names: list[str], window: int = WINDOW, anchor: int = ANCHOR, block: int = BLOCK) -> DataFrame:
    """``key, tie, spans array<struct<position, words>>`` of documents (key, tie, text) that have words to remove.

    ``sent`` has the same documents with compressed texts and any other columns; ``names``: those of its key, tie, text and what
    tells rows without an id apart. All its columns are read here, so that one shuffle of it serves the caller too.
    """
    parsed = stored(keyed.mapInArrow(_parse(window, anchor, block), "anchor long, key long, tie long, position int, words int"), "parsed", "zstd")
    # Anchors go with ids alone: more of them than needed never change the outcome, as windows are compared whole. Rows
    # without an id are told apart by their texts, or one group would hold the anchors of all of them.
    apart = _apart(F.col("key"), F.col("tie")).alias("apart")
    own = parsed.where("anchor = -1").select("key", "tie", "position", "words")
    held = parsed.where("anchor != -1").select("anchor", "key", apart, "position")
    several = held.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    shared = held.join(several, "anchor").select("key", "apart", "position", F.lit(0).alias("words"), F.lit(0).cast("long").alias("tie"))
    both = shared.union(own.select("key", apart, "position", "words", "tie"))
    marks = both.groupBy("key", "apart").agg(F.collect_set(F.struct("position", "words", "tie")).alias("marks"), F.min("words").alias("least"))
    # Documents that stand in several rows are read once.
    key, tie, text, told = names
    found = free_name(sent.columns, "marks")
    wanted = marks.where("least = 0").select(F.col("key").alias(key), F.col("apart").alias(told), F.col("marks").alias(found))
    picked = sent.join(wanted, [key, told]).dropDuplicates([key, told, tie])
    picked = picked.select(key, tie, text, found, *[c for c in sent.columns if c not in (key, tie, text)])
    windows = map_batches(picked, _windows(window, anchor), "window long, key long, tie long, position int")
    # A rank takes rows as they come: no second copy of a place in the shuffle, none held in memory.
    place = Window.partitionBy("window").orderBy("key", "tie", "position")
    again = windows.select("key", "tie", "position", (F.rank().over(place) > 1).alias("again")).where("again")
    across = again.select("key", "tie", "position", F.lit(window).alias("words"))
    return own.union(across).groupBy("key", "tie").agg(F.collect_list(F.struct("position", "words")).alias("spans"))


def _keep(names: list[str], at: int | None):
    """Counts and what is left, of rows (columns, compressed text, spans); ``at`` is the place of the text among the columns, if it is carried."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns, data = list(batch.columns[:-2]), unpacked(batch.column(len(names) - (at is not None)))
        n, removed, kept = [], [], []
        for text, spans in zip(data, batch.columns[-1]):
            words = text.split()
            n.append(len(words))
            if spans.is_valid and len(spans.values):
                gone = np.zeros(len(words) + 1, np.int32)
                position, length = (spans.values.field(i).to_numpy() for i in (0, 1))
                np.add.at(gone, position, 1)
                np.add.at(gone, position + length, -1)
                stay = np.cumsum(gone[:-1]) == 0
                removed.append(len(words) - int(stay.sum()))
                words = [words[i] for i in np.flatnonzero(stay)]
            else:
                removed.append(0)
            kept.append(b" ".join(words))
        if at is not None:
            whole = batch.column(len(names) - 1)
            columns.insert(at, pa.array([t if v else None for t, v in zip(data, whole.is_valid().to_pylist())], pa.binary()).cast(pa.string()))
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], [*names, "n_words", "n_removed", "kept"]
        )

    return run


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR, block: int = BLOCK, carry_text: bool = True) -> DataFrame:
    """All columns of ``docs`` (the text too, unless ``carry_text`` is off) with ``n_words, n_removed, kept``: the text without words of windows that stand earlier too.

    A window is ``window`` consecutive words (split at white space, unchanged) of one document. It goes if its words also
    start earlier: in a document with a smaller id, or before it in the same one; windows may overlap. ``kept`` is the
    words left, joined by one space. Windows are judged on the input.

    Null and empty texts have no words. Rows with a null id come after all others. Rows of one id and text are one
    document and get the same answer; rows of one id and different texts are ordered by a hash of the text. An
    empty table gives an empty one. Old columns n_words, n_removed and kept are replaced.
    """
    columns = [c for c in docs.columns if c.lower() not in ("n_words", "n_removed", "kept")]
    key, tie, told, own, at, whole = (free_name(columns, n) for n in ("key", "tie", "apart", "spans", "at", "whole"))
    key_of, tie_of = F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)), F.xxhash64(text)
    keyed = docs.select(key_of.alias("key"), tie_of.alias("tie"), F.col(text).alias("text"))
    others = [c for c in columns if c != text]
    names = columns if carry_text else others
    sent = packed(docs.select(*others, key_of.alias(key), tie_of.alias(tie), _apart(key_of, tie_of).alias(told), F.col(text).alias(whole)), whole)
    # Both joins of the texts are by key and what tells rows apart, and both keep all columns and rows: Spark shuffles the texts once.
    sent = sent.where(F.col(key).isNotNull() & F.col(told).isNotNull())  # never null
    found = repeated_spans(keyed, sent, [key, tie, whole, told], window, anchor, block)
    spans = found.select(F.col("key").alias(key), _apart(F.col("key"), F.col("tie")).alias(told), F.col("tie").alias(at), F.col("spans").alias(own))
    same = (sent[key] == spans[key]) & (sent[told] == spans[told]) & (sent[tie].bitwiseXOR(spans[at]) == 0)  # the tie is no key of the join
    ready = sent.join(spans, same, "left").select(*others, sent[whole], spans[own])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    return map_batches(ready, _keep(names, columns.index(text) if carry_text else None), f"{schema}, n_words long, n_removed long, kept string")
