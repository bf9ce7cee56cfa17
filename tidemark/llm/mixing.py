"""Mixing sources to target weights by balanced sampling with the cube method.

A source's documents are all taken target / size times on average: the whole part as copies, the rest as a probability of
one more. The flight moves these probabilities three documents of a source at a time along the null space of its two
constraints, so the expected words and the expected documents stay what they are while one of the three becomes certain. A
document more takes its place. At most two documents of a group stay open; they fly on in larger groups, until at most
two of each source are left. Landing gives up the documents first, then the words, by less than one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, stored

WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a source that fly together at first, and groups that are then put together.
GROUP, FAN = 1 << 11, 256
EPSILON = 1e-9
_KEEP = 2  # documents of a group that no step can settle: as many as there are constraints


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def _numbered_sources(sized: DataFrame) -> DataFrame:
    """``source, source_size, documents, number``: sources by code point, null last, numbered from 0, in as many tasks as Spark likes."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("documents"))
    ordered = checkpointed(sources.orderBy(F.col("source").asc_nulls_last()))
    ordered = ordered.withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.shiftright("place", 33))
    starts, at = [], 0
    for part, n in sorted(ordered.groupBy("part").count().collect()):  # one row a partition of the sorted sources
        starts.append((part, at))
        at += n
    first = sized.sparkSession.createDataFrame(starts, "part long, first long")
    number = F.col("first") + F.col("place").bitwiseAND((1 << 33) - 1)
    return ordered.join(F.broadcast(first), "part").select("source", "source_size", "documents", number.alias("number"))


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = 3) -> DataFrame:
    """``source, source_size, documents, number, target`` for a table of ``source, size``; a written table.

    Sources share the sum of all sizes by weight. A target stops at ``most`` times its source's size and the excess is shared
    again by weight, until none is above. A round is an aggregate of one row; ever more sources are at their limit.
    """
    spark = sized.sparkSession
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("number") % len(weights)).cast("int") + 1)
    sources = stored(_numbered_sources(sized).withColumn("weight", weight), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    full = F.col("source_size") * float(most)
    level, before = 0.0, None
    while True:
        below = full <= F.col("weight") * level
        held = sources.agg(F.count_if(below).alias("k"), F.sum(F.when(below, F.col("source_size"))).alias("held"), F.sum(F.when(~below, F.col("weight"))).alias("free")).first()
        if held["k"] == before or not held["free"]:
            break
        before, level = held["k"], max(level, (total - most * (held["held"] or 0)) / held["free"])
    return sources.select("source", "source_size", "documents", "number", F.when(below, full).otherwise(F.col("weight") * level).alias("target"))


def _step(chances: list[float], move: list[float], u: float) -> None:
    """Moves the chances along +-``move`` until one of them is 0 or 1, either way with the odds that keep all means."""
    up = [(1 - p) / v if v > 0 else -p / v for p, v in zip(chances, move) if v]
    down = [p / v if v > 0 else (p - 1) / v for p, v in zip(chances, move) if v]
    far, back = min(up), min(down)
    way = far if u * (far + back) < back else -back
    for i, v in enumerate(move):
        p = chances[i] + way * v
        chances[i] = 0.0 if p < EPSILON else 1.0 if p > 1 - EPSILON else p


def fly(sizes: list[float], chances: list[float], odds: list[float], land: bool) -> list[int]:
    """Moves ``chances`` in place; returns the places that stay open, at most two, none if the group lands."""
    active: list[int] = []
    for new in range(len(sizes)):
        if not 0 < chances[new] < 1:
            continue
        active.append(new)
        if len(active) > _KEEP:
            i, j, k = active
            x, y, z = sizes[i], sizes[j], sizes[k]
            move = [y - z, z - x, x - y] if not x == y == z else [1.0, -1.0, 0.0]
            own = [chances[i], chances[j], chances[k]]
            _step(own, move, odds[new])
            chances[i], chances[j], chances[k] = own
            active = [a for a in active if 0 < chances[a] < 1]
    if land:
        if len(active) == 2:
            i, j = active
            own = [chances[i], chances[j]]
            _step(own, [sizes[j], -sizes[i]], odds[j])
            chances[i], chances[j] = own
        for a in active:
            chances[a] = float(chances[a] >= 0.5)
        return []
    return active


def _flight(units: DataFrame, land: bool) -> DataFrame:
    """``units`` (row, number, parts, size, key, chance) after flights inside (number, key modulo parts), in order of size.

    A task reads its groups one after another and holds a batch and two documents.
    """
    salt = F.pmod("key", "parts")
    dealt = units.withColumn("salt", salt).repartition("number", "salt").sortWithinPartitions("number", "salt", F.desc("size"), "key")
    names = dealt.columns
    where = names.index("chance")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if open_rows is None else [*open_rows.to_batches(), batch])
            number, group, key = (rows[c].to_numpy() for c in ("number", "salt", "key"))
            sizes, chances = rows["size"].to_numpy().astype(float), rows["chance"].to_numpy().tolist()
            odds = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(float) / (1 << 53)
            ends = np.r_[np.flatnonzero((np.diff(number) != 0) | (np.diff(group) != 0)) + 1, len(number)]
            begin, stay = 0, []
            for end in ends.tolist():
                part, last = chances[begin:end], end == len(number)
                stay = [begin + i for i in fly(sizes[begin:end].tolist(), part, odds[begin:end].tolist(), land and not last)]
                chances[begin:end] = part
                begin = end
            rows = rows.set_column(where, "chance", pa.array(chances))
            gone = np.ones(len(chances), bool)
            gone[stay] = False
            open_rows = rows.take(pa.array(stay, pa.int64()))
            yield from rows.filter(pa.array(gone)).combine_chunks().to_batches()
        if open_rows is not None and open_rows.num_rows:
            if land:
                chances = open_rows["chance"].to_pylist()
                odds = [((int(k) & ((1 << 64) - 1)) * 0x9E3779B97F4A7C15 >> 11 & ((1 << 53) - 1)) / (1 << 53) for k in open_rows["key"].to_pylist()]
                fly([float(x) for x in open_rows["size"].to_pylist()], chances, odds, True)
                open_rows = open_rows.set_column(where, "chance", pa.array(chances))
            yield from open_rows.combine_chunks().to_batches()

    return dealt.mapInArrow(run, dealt.schema).drop("salt")


def mix(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, most: int = 3, keep: list[str] | None = None) -> DataFrame:
    """All rows, with ``size`` (words), ``source_size``, ``target``, ``copies`` (0 to ``most``) and ``taken`` (size times copies).

    A source's taken words differ from its target by less than its longest open document, its copies from their
    expected number by at most two. The same rows give the same answer however they are dealt out: groups, their order
    and the odds depend on id, text and size alone; rows equal in these may change places. Null ids are fine, a null text has no words;
    documents without words are taken 0 times and count in no total. Null is a source of its own, the last. ``keep`` names the
    columns to carry (all); those named like a result are replaced. An empty table gives an empty one.
    """
    results = ("size", "source_size", "target", "copies", "taken")
    kept = [c for c in (keep or docs.columns) if c.lower() not in results]
    sized = docs.select(
        F.struct(*kept).alias("row"), F.col(source).cast("string").alias("source"), word_count(text).alias("size"), F.xxhash64(id_column, text).alias("key")
    )
    sized = stored(sized, "sized")
    shares = targets(sized.select("source", "size"), weights, most)
    rate = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = sized.alias("d").join(shares.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    units = joined.select("row", "number", "documents", "source_size", "target", "size", "key", F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("chance"))
    largest = shares.agg(F.max("documents")).first()[0] or 0
    parts, landed = max(1, -(-largest // GROUP)), []
    group = float(GROUP)
    while True:
        last = parts == 1
        split = F.greatest(F.lit(1), F.ceil(F.col("documents") / group)).cast("long")
        flown = stored(_flight(units.withColumn("parts", split), last), "flown")
        settled = F.col("chance").isin(0.0, 1.0)
        landed.append(flown.where(settled))
        if last:
            break
        units, parts, group = flown.where(~settled).drop("parts"), -(-parts // FAN), group * FAN
    whole = landed[0]
    for more in landed[1:]:
        whole = whole.unionByName(more)
    copies = (F.col("whole") + F.col("chance")).cast("long")
    out = whole.select("row", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))
    return out.select("row.*", *results)


def copies_of(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as it is taken, with ``copy`` from 1."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
