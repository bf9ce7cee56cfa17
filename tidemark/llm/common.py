"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir, scratch_path

#: A-Z to a-z on UTF-8 bytes; other bytes stay.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Bytes of text, one text at the least, whose features or shingles are held at one time.
SLICE_BYTES = 1_000_000
#: Key of rows without a doc_id: they come after all others.
LAST = (1 << 63) - 1

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # public 64-bit mixer constants
ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """The table, written once to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def free_name(taken, name: str) -> str:
    """A column name that clashes with none of the given ones."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows with at most ``most`` units together, one row at least."""
    ends = np.cumsum(lengths)
    a = 0
    while a < len(lengths):
        b = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right"))
        yield a, (b := max(b, a + 1))
        a = b


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text, empty for null."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, row after the last, UTF-8 bytes of their texts) of consecutive rows with at most ``most`` bytes, one row at least.

    Only these texts are objects at one time, however long a batch is.
    """
    data = column.cast(pa.binary())
    for a, b in slices(pc.fill_null(pc.binary_length(data), 0).to_numpy(zero_copy_only=False).astype(np.int64), most):
        yield a, b, texts(data.slice(a, b - a))


class Memo(dict):
    """What ``make`` gives for a key, remembered for the keys met of late: ``most`` of them, and as many that were met before those.

    A full memo becomes the older half, and a key met again comes back from there: frequent keys are made once, however many
    rare ones come between. Keys of ``longest`` letters or more are made each time.
    """

    def __init__(self, most: int, longest: int = 100):
        super().__init__()
        self.most, self.longest, self.older = most, longest, {}

    def make(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(key) < self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class WordHash(dict):
    """64-bit hashes of words, remembered up to a bounded number of words."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: One memo for all operators: workers are reused, and each of them would keep its own.
_WORDS = WordHash()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return _WORDS.of(words)


def mix(h: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values, in a new array."""
    h = h ^ (h >> np.uint64(30))
    h *= M1
    h ^= h >> np.uint64(27)
    h *= M2
    h ^= h >> np.uint64(31)
    return h


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k word hashes, by doubling: few passes whatever k."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, width, total, covered, p = words, 1, None, 0, ODD
    while True:
        if k & width:
            part = power[covered : covered + n]
            total = part.copy() if total is None else total * p + part
            covered += width
        if (width << 1) > k:
            return mix(total)
        power = power[:-width] * p + power[width:]
        p = np.uint64(int(p) * int(p) & 0xFFFFFFFFFFFFFFFF)
        width <<= 1


def long(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def list_of(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of the given links, nodes that are their own root left out."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = index[: len(a)], index[len(a) :]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            break
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        np.minimum.at(root, high, low)
        while (root != (up := root[root])).any():
            root = up
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _forest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = local_forest(*(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of the links ``a, b`` (longs); component: the smallest node reachable.

    Links are first reduced to a forest batch by batch, so hubs shrink before any shuffle. Then large-star and
    small-star steps, by grouped minima and equi joins that adaptive execution can split, until only
    stars are left; every round is a written table. Nulls and self-links are ignored.
    """
    edges = edges.where("a is not null and b is not null and a != b").select(F.col("a").cast("long"), F.col("b").cast("long"))
    links = stored(edges.mapInArrow(_forest_batches, "a long, b long").distinct(), "links")
    for _ in range(rounds):
        ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))).alias("x"))
        # Stars: no node points to two others, or points and is pointed to.
        if ends.groupBy("x.node").agg(F.sum("x.up").alias("up"), F.min("x.up").alias("least")).where("up > 1 or (up = 1 and least = 0)").isEmpty():
            break
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        links = stored(small.select("x.*").where("a != b").distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
