"""Near-duplicate documents by min-max hashing.

Under each permutation the smallest and the largest hash of a document's shingles are kept, so half as many
permutations give a signature of the same length, unbiased and with less variance. Bands of the signature propose
pairs; every link is confirmed on whole shingle sets.

Documents with equal sets form a class and are never compared. In a bucket, classes are first compared with the
bucket's smallest class; what that leaves unconnected is compared in blocks with the rest, skipping pairs that are
already connected. So no link is lost, and groups of copies do not grow with their square.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LAST, LOWER, components, grams, list_of, local_forest, long, map_batches, mix, stored, text_slices, word_hashes

BANDS, ROWS = 24, 4
SHINGLE, SIMILARITY = 5, 80
#: Shingles per side of a block when the rest of a bucket is compared.
BLOCK = 400_000


def shingles(data: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts one after another, how many each has)."""
    words = [t.translate(LOWER).split() for t in data]
    n = np.array([len(w) for w in words])
    hashes = word_hashes([w for ws in words for w in ws])
    ends = np.cumsum(n)
    runs = grams(hashes, k)
    sets = []
    for end, m in zip(ends, n):
        if m >= k:
            sets.append(np.unique(runs[end - m : end - k + 1]))
        elif m:
            sets.append(grams(hashes[end - m : end], int(m)))
        else:
            sets.append(runs[:0])
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.array([len(s) for s in sets], np.int64)


def signatures(values: np.ndarray, sizes: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(band hashes, first digest, second digest) of non-empty sets that stand one after another."""
    starts = np.cumsum(sizes) - sizes
    rng = np.random.default_rng(20240229)
    out = np.empty((len(sizes), bands), np.uint64)
    held, column = None, 0
    for _ in range(-(-bands * rows // 2)):
        a, b = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
        turned = values * (a * np.uint64(2) + np.uint64(1))
        turned += b
        for side in (np.minimum, np.maximum):
            part = mix(side.reduceat(turned, starts))
            band, row = divmod(column, rows)
            column += 1
            if band < bands:
                held = part + np.uint64(band) if row == 0 else mix(held) + part
                if row == rows - 1:
                    out[:, band] = mix(held)
    one = np.add.reduceat(mix(values), starts) + sizes.astype(np.uint64)
    two = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), starts)
    return out, mix(one), two


def sign(docs: DataFrame, text: str, k: int, bands: int, rows: int, carry: list[str]) -> DataFrame:
    """The carried columns with ``n_shingles``, ``class`` and ``bands`` (null without words) and ``twin``, a second digest."""
    picked = docs.select(*carry, text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, parts = [], []
        for _, _, data in text_slices(batch.column(batch.num_columns - 1)):
            values, sizes = shingles(data, k)
            n.append(sizes)
            full = sizes[sizes > 0]
            if len(full):
                parts.append(signatures(values, full, bands, rows))
        n = np.concatenate(n)
        empty = n == 0
        columns = [np.zeros((len(n), bands), np.uint64), np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)]
        if parts:
            for column, found in zip(columns, zip(*parts)):
                column[~empty] = np.concatenate(found)
        offsets = np.concatenate([[0], np.cumsum(np.where(empty, 0, bands))])
        lists = list_of(columns[0][~empty].ravel().view(np.int64), offsets)
        keys = [pa.array(c.view(np.int64), mask=empty) for c in columns[1:]]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n), *keys, lists], [*carry, "n_shingles", "class", "twin", "bands"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return map_batches(picked, run, f"{schema}, n_shingles long, class long, twin long, bands array<long>")


def _sets(docs: DataFrame, text: str, k: int) -> DataFrame:
    """``class, shingles`` (sorted) of every text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, keys, sizes = [], [], []
        for _, _, data in text_slices(batch.column(0)):
            v, n = shingles(data, k)
            one = np.add.reduceat(mix(v), np.cumsum(n) - n) + n.astype(np.uint64)
            values.append(v), sizes.append(n), keys.append(mix(one))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return pa.RecordBatch.from_arrays([long(np.concatenate(keys)), list_of(np.concatenate(values).view(np.int64), offsets)], ["class", "shingles"])

    return map_batches(docs.select(text), run, "class long, shingles array<long>")


def _shared(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many shingles each of ``left`` has in common with each of ``right``: products of 0/1 matrices, some columns at a time."""
    sides = []
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    for sets in (left, right):
        values, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        column = np.minimum(np.searchsorted(both, values), max(len(both) - 1, 0))
        good = both[column] == values if len(both) else np.zeros(len(values), bool)
        by = np.argsort(column[good], kind="stable")
        sides.append((row[good][by], column[good][by]))
    out = np.zeros((len(left), len(right)), np.float32)
    for a in range(0, len(both), width):
        dense = []
        for sets, (row, column) in zip((left, right), sides):
            i, j = np.searchsorted(column, [a, a + width])
            part = np.zeros((len(sets), min(width, len(both) - a)), np.float32)
            part[row[i:j], column[i:j] - a] = 1
            dense.append(part)
        out += dense[0] @ dense[1].T
    return out


def _compare(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A spanning forest of the links of one block: classes outside the unit's largest component against all."""
    minor, others = rows[rows["minor"]], rows[~rows["minor"]]
    if not len(minor) or not len(others):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    left, right = ([np.asarray(v, np.int64) for v in side["shingles"]] for side in (minor, others))
    both = _shared(left, right)
    total = np.array([len(v) for v in left])[:, None] + np.array([len(v) for v in right])[None, :]
    near = (100 * both >= percent * (total - both)) & (minor["component"].to_numpy()[:, None] != others["component"].to_numpy()[None, :])
    i, j = np.nonzero(near)
    a, b = local_forest(minor["class"].to_numpy()[i], others["class"].to_numpy()[j])
    return pd.DataFrame({"a": a, "b": b}, dtype="int64")


def links(signed: DataFrame, docs: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """Confirmed links ``a, b`` between classes, enough to connect all classes that links connect.

    ``docs`` has the text and ``pick``, one number per row; ``signed`` has pick, class and bands.
    """
    classes = stored(signed.where("class is not null").groupBy("class").agg(F.min("pick").alias("pick"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n")), "classes")
    inside = classes.select("class", "n", F.explode("bands").alias("bucket"))
    shared = inside.groupBy("bucket").agg(F.min("class").alias("pivot"), F.count("*").alias("size")).where("size > 1").select("bucket", "pivot")
    candidates = stored(inside.join(shared, "bucket"), "candidates")
    wanted = candidates.select("class").distinct().join(classes.select("class", "pick"), "class").select("pick")
    picked = docs.join(wanted, "pick", "left_semi").dropDuplicates(["pick"])  # repeated rows once
    sets = stored(_sets(picked, text, k), "sets")
    pairs = candidates.where("pivot < class").groupBy("class").agg(F.min("pivot").alias("pivot"))
    theirs = sets.select(F.col("class").alias("pivot"), F.col("shingles").alias("others"))
    both = F.size(F.array_intersect("shingles", "others"))
    near = F.lit(100) * both >= F.lit(percent) * (F.size("shingles") + F.size("others") - both)
    first = stored(pairs.join(sets, "class").join(theirs, "pivot").where(near).select(F.col("class").alias("a"), F.col("pivot").alias("b")), "links")
    known = components(first)
    placed = candidates.select("bucket", "class", "n").join(known.select(F.col("node").alias("class"), "component"), "class", "left")
    placed = stored(placed.select("bucket", "class", "n", F.coalesce("component", "class").alias("component")), "placed")
    open_ = placed.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.min("class").alias("head"), F.count("*").alias("size")).where("a != b")
    open_ = stored(open_.select("bucket", "head", F.col("size").cast("double").alias("size")), "open")
    if open_.isEmpty():
        return first
    # Buckets with one smallest class overlap much: they are compared as one unit, or each by itself, whichever is less work.
    inside = placed.join(open_, "bucket")
    apart = open_.groupBy("head").agg(F.sum(F.col("size") * F.col("size")).alias("apart"))
    members = inside.select("head", "class").distinct().groupBy("head").agg(F.count("*").cast("double").alias("m"))
    joint = members.join(apart, "head").select("head", (F.col("m") * F.col("m") <= F.col("apart")).alias("joint"))
    member = inside.join(joint, "head")
    unit = F.when(F.col("joint"), F.col("head")).otherwise(F.col("bucket"))
    member = stored(member.select(unit.alias("unit"), "class", "n", "component").distinct(), "units")
    parts = member.groupBy("unit", "component").agg(F.sum("n").alias("n"))
    sizes = parts.groupBy("unit").agg(F.expr("max_by(component, n)").alias("major"), F.sum("n").alias("all"), (F.sum("n") - F.max("n")).alias("minors"), F.count("*").alias("parts")).where("parts > 1")
    sizes = sizes.select("unit", "major", F.ceil(F.col("minors") / BLOCK).cast("int").alias("down"), F.ceil(F.col("all") / BLOCK).cast("int").alias("across"))
    rows = member.join(sizes, "unit").join(sets, "class").withColumn("minor", F.col("component") != F.col("major"))
    spread = F.xxhash64("class", "unit")
    every = F.sequence(F.lit(0), F.col("across") - 1)
    minor = rows.where("minor").withColumn("across", F.explode(every)).withColumn("down", F.pmod(spread, "down").cast("int"))
    every = F.sequence(F.lit(0), F.col("down") - 1)
    against = rows.withColumn("minor", F.lit(False)).withColumn("down", F.explode(every)).withColumn("across", F.pmod(spread, "across").cast("int"))
    columns = ["unit", "down", "across", "class", "component", "minor", "shingles"]
    more = minor.select(*columns).union(against.select(*columns)).groupBy("unit", "down", "across").applyInPandas(lambda g: _compare(g, percent), "a long, b long")
    return first.union(stored(more, "more"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``<id>, n_shingles, component_id, kept`` for every row.

    Words are split at white space, A-Z lower-cased; a set is the distinct runs of ``k`` words, of fewer words
    the whole sequence. Two documents are linked if 100 * intersection >= percent * union. ``component_id`` is the
    smallest id reachable; ``kept`` marks rows that have it. A pair at exactly four fifths goes unproposed with a chance of
    about 3 in a million with 24 bands of 4.

    Null and empty texts and texts of white space have no shingles and link with nothing. Rows with a null id take
    part; they are kept only in components without any id, and their component_id is null there. Repeated rows are
    copies: all rows with the smallest id are kept. An empty table gives an empty one. Other columns are not carried.
    """
    th, key = F.xxhash64(text), F.coalesce(F.col(id_column).cast("long"), F.lit(LAST))
    keyed = docs.select(F.col(id_column), F.col(text), F.xxhash64(key, th).alias("pick"))
    signed = stored(sign(keyed, text, k, bands, rows, [id_column, "pick"]), "signed")
    joined = components(links(signed, keyed, text, k, percent))
    least = signed.where("class is not null").groupBy("class").agg(F.min(id_column).alias("least"))
    placed = least.join(joined.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    found = placed.join(smallest, "component").select("class", "component_id", F.lit(True).alias("linked"))
    own = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col(id_column))
    out = signed.select(id_column, "n_shingles", "class").join(found, "class", "left")
    return out.select(id_column, "n_shingles", own.alias("component_id"), F.coalesce(F.col(id_column) == own, own.isNull()).alias("kept"))
