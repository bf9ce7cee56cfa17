"""Approximate nearest neighbours by cosine: a robust-pruned directed graph per shard.

Rows are dealt into shards of a fixed expected size. In a shard, greedy searches over the graph so far propose
neighbours, and relaxed pruning keeps those that no kept neighbour is much closer to, so edges point in diverse directions.
Queries come in blocks, pass every shelf of shards, and search each shard's graph with a beam; scores are then exact, in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.vectors import unit, usable

SHARD, DEGREE, BEAM, RELAX = 4096, 32, 64, 1.2
SEARCH_BEAM = 128
#: Queries of a block, and nodes inserted at once.
QUERIES, BATCH = 512, 256
#: Tasks of a search where there are shards enough, and numbers of vectors that one of them holds at most: 16 shards of 64 dimensions.
TASKS, NUMBERS = 32, 1 << 22
_WIDE = 4


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, similarities) of each query's beam, nearest first, -1 where it has fewer; all queries in step.

    Each step expands the ``_WIDE`` nearest nodes of a beam that were not expanded yet.
    """
    n, rows = len(x), np.arange(len(queries))
    nodes = np.full((len(queries), beam), -1, np.int64)
    near = np.full((len(queries), beam), -np.inf, np.float32)
    done = np.ones((len(queries), beam), bool)
    nodes[:, 0], near[:, 0], done[:, 0] = start, queries @ x[start], False
    seen = np.zeros((len(queries), n + 1), bool)
    seen[:, start] = seen[:, n] = True
    active = rows
    while len(active):
        waiting = np.where(done[active], -np.inf, near[active])
        pick = np.argpartition(-waiting, min(_WIDE, beam - 1), axis=1)[:, :_WIDE]
        fine = np.take_along_axis(waiting, pick, axis=1) > -np.inf
        expand = np.where(fine, nodes[active[:, None], pick], n)
        done[active[:, None], pick] = True
        found = graph.take(expand, axis=0).reshape(len(active), -1)
        found = np.where(seen.ravel().take(found + (active * (n + 1))[:, None]), n, found)
        found.sort(axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = n
        row, at = np.nonzero(found < n)  # most are seen already: only the others are compared and sorted
        count = np.bincount(row, minlength=len(active))
        place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        met = found[row, at]
        seen[active[row], met] = True
        more = np.full((len(active), int(count.max(initial=0))), -1, np.int64)
        fresh = np.full(more.shape, -np.inf, np.float32)
        more[row, place], fresh[row, place] = met, np.einsum("ij,ij->i", x.take(met, axis=0), queries.take(active[row], axis=0))
        all_near = np.concatenate([near[active], fresh], axis=1)
        order = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        near[active] = np.take_along_axis(all_near, order, axis=1)
        nodes[active] = np.take_along_axis(np.concatenate([nodes[active], more], axis=1), order, axis=1)
        done[active] = np.take_along_axis(np.concatenate([done[active], more < 0], axis=1), order, axis=1)
        active = active[~done[active].all(axis=1)]
    return nodes, near


def robust_prune(x: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Neighbours of each node out of its candidates (-1: none): nearest first, without those that a kept one is nearer to by ``relax``."""
    n = len(x)
    candidates = np.sort(np.where(candidates == own[:, None], -1, candidates), axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    points = x[np.maximum(candidates, 0)]
    away = 1 - np.einsum("ijk,ik->ij", points, x[own])
    away[candidates < 0] = np.inf
    order = np.argsort(away, axis=1, kind="stable")
    candidates, away = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(away, order, axis=1)
    points = x.take(np.maximum(candidates, 0), axis=0)
    between = 1 - points @ points.transpose(0, 2, 1)
    alive, rows = away < np.inf, np.arange(len(own))
    out = np.full((len(own), degree), n, np.int64)
    for k in range(degree):
        chosen = alive.argmax(axis=1)
        good = alive[rows, chosen]
        if not good.any():
            break
        out[good, k] = candidates[rows, chosen][good]
        alive &= relax * between[rows, chosen] > away
        alive[rows, chosen] = False
        alive[~good] = False
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relax: float = RELAX) -> tuple[np.ndarray, int]:
    """(neighbours of each node, n where there are fewer, and a last row of n; entry point). Unit vectors; always the same for the same rows."""
    n = len(x)
    start = int((x @ x.mean(axis=0)).argmax())
    graph = np.full((n + 1, degree), n, np.int64)
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    at = 1
    while at < n:
        batch = order[at : at + min(BATCH, max(1, at))]
        found, _ = beam_search(x, graph, start, x[batch], beam)
        graph[batch] = robust_prune(x, batch, found, degree, relax)
        source = np.repeat(batch, degree)
        target = graph[batch].ravel()
        source, target = source[target < n], target[target < n]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        heads, first, count = np.unique(target, return_index=True, return_counts=True)
        for a in range(0, len(heads), BATCH):
            h, f, c = heads[a : a + BATCH], first[a : a + BATCH], count[a : a + BATCH]
            wide = np.full((len(h), degree + int(c.max())), -1, np.int64)
            wide[:, :degree] = np.where(graph[h] == n, -1, graph[h])
            row = np.repeat(np.arange(len(h)), c)
            wide[row, degree + np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c)] = source[np.repeat(f, c) + np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c)]
            full = (wide >= 0).sum(axis=1) > degree
            packed = -np.sort(-wide, axis=1)[:, :degree]
            graph[h] = np.where(packed < 0, n, packed)
            if full.any():
                graph[h[full]] = robust_prune(x, h[full], wide[full], degree, relax)
        at += len(batch)
    return graph, start


def _index(degree: int, beam: int, relax: float):
    def run(rows: pa.Table) -> pa.Table:
        x = np.array(rows.column("vector").combine_chunks().flatten().to_numpy()).reshape(len(rows), -1)
        ids = rows.column("id").to_numpy()
        points, which = np.unique(x, axis=0, return_inverse=True)  # copies are one node with several ids
        by = np.lexsort((ids, which.ravel()))
        graph, start = build_graph(unit(points).astype(np.float32), degree, beam, relax)
        starts = np.searchsorted(which.ravel()[by], np.arange(len(points) + 1))
        cells = [points.astype("<f8"), ids[by].astype("<i8"), starts.astype("<i8"), graph.astype("<i4")]
        return pa.table(
            {"width": pa.array([x.shape[1]], pa.int32()), "shard": rows.column("shard").slice(0, 1).combine_chunks(), "start": pa.array([start], pa.int32()),
             **{name: pa.array([c.tobytes()], pa.binary()) for name, c in zip(("points", "ids", "starts", "graph"), cells)}}
        )

    return run


class _Shard:
    """A shard as a search task holds it: its graph, and its points in both precisions."""

    def __init__(self, width: int, start: int, points: np.ndarray, ids: np.ndarray, starts: np.ndarray, graph: np.ndarray):
        self.start, self.ids, self.starts, self.graph = start, ids, starts, graph
        self.exact = unit(points.reshape(-1, width))
        self.x = self.exact.astype(np.float32)

    def search(self, names: np.ndarray, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of the query, id, score) of its k nearest here and all that tie with the last, the query's own id left out."""
        found, _ = beam_search(self.x, self.graph, self.start, queries.astype(np.float32), max(beam, k + 1))
        score = np.full(found.shape, -np.inf)
        for at in range(0, len(found), 64):
            some = found[at : at + 64]
            score[at : at + 64] = (self.exact[np.maximum(some, 0)] * queries[at : at + 64, None]).sum(axis=2)  # the same sum for equal vectors wherever they are
        score[found < 0] = -np.inf
        edge = -np.partition(-score, k, axis=1)[:, k, None]  # the query itself may be among them
        row, place = np.nonzero((score >= edge) & (found >= 0))
        node, score = found[row, place], score[row, place]
        first, count = self.starts[node], self.starts[node + 1] - self.starts[node]
        # Of a node's ids, which are in order, the first k besides the query's own.
        own = np.zeros(len(node), np.int64)
        for j in np.flatnonzero(count > 1):
            copies = self.ids[first[j] : first[j] + count[j]]
            own[j] = np.searchsorted(copies, names[row[j]], "right") - np.searchsorted(copies, names[row[j]])
        taken = np.minimum(count, k + own)
        at = np.repeat(np.arange(len(node)), taken)
        ids = self.ids[first[at] + np.arange(len(at)) - np.repeat(np.cumsum(taken) - taken, taken)]
        other = ids != names[row[at]]
        return row[at][other], ids[other], score[at][other]


def _best(row: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each row by score, then id, equal ones counted once."""
    by = np.lexsort((ids, -score, row))
    new = np.ones(len(by), bool)
    new[1:] = (np.diff(row[by]) != 0) | (np.diff(ids[by]) != 0) | (np.diff(score[by]) != 0)
    by = by[new]
    heads = np.searchsorted(row[by], row[by])
    return by[np.arange(len(by)) - heads < k]


def _search(k: int, degree: int, beam: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Shard] = []
        now = None
        for batch in batches:
            for at in range(batch.num_rows):
                width, shelf, asks, start, points, ids, starts, graph, asked = (batch.column(i)[at] for i in range(9))
                width = width.as_py()
                if (width, shelf.as_py()) != now:
                    held, now = [], (width, shelf.as_py())
                if not asks.as_py():
                    points, ids, starts, graph = (np.frombuffer(c.as_buffer(), t) for c, t in zip((points, ids, starts, graph), ("<f8", "<i8", "<i8", "<i4")))
                    held.append(_Shard(width, start.as_py(), points, ids.copy(), starts.copy(), graph.astype(np.int64).reshape(-1, degree)))
                    continue
                names = asked.values.field("id").to_numpy()
                queries = unit(asked.values.field("vector").flatten().to_numpy().reshape(len(names), width))
                found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
                for shard in held:  # what a shard adds is let go at once, but for the k best
                    found = [np.concatenate(pair) for pair in zip(found, shard.search(names, queries, k, beam))]
                    best = _best(*found, k)
                    found = [f[best] for f in found]
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(names[found[0]], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())], ["query_id", "id", "score"])

    return run


def nearest(
    df: DataFrame, queries: Column, k: int = 5, id_column: str = "vec_id", vector: str = "embedding", shard: int = SHARD,
    degree: int = DEGREE, beam: int = BEAM, search_beam: int = SEARCH_BEAM, relax: float = RELAX,
) -> DataFrame:
    """``query_id, rank, <id>, score``: the k nearest rows found for each row that ``queries`` selects, itself left out.

    Nearest by cosine in double precision, ties to the smaller id. Every row is indexed; recall depends on the beams
    (see the README for measured figures). A row with fewer than k others of its length gets those.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id, take no part.
    Repeated rows of one id: each is a candidate for other queries, none for its own id; one id asks once. Equal vectors
    in a shard are one node, so copies cost nothing. An empty table or no query gives an empty table.
    """
    spark = df.sparkSession
    good = df.where(usable(F.col(vector)) & F.col(id_column).isNotNull())
    kept = good.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("row"))
    rows = stored(kept.withColumn("width", F.size("vector")), "vectors")
    total = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("asks"), F.max("width").alias("width")).first()
    shards, blocks = max(1, math.ceil(total["n"] / shard)), max(1, math.ceil(total["asks"] / QUERIES))
    dealt = rows.select("width", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), "id", "vector")
    graphs = "start int, points binary, ids binary, starts binary, graph binary"
    index = dealt.repartition(2 * shards, "width", "shard").groupBy("width", "shard").applyInArrow(_index(degree, beam, relax), f"width int, shard int, {graphs}")
    index = stored(index, "graphs")
    asked = rows.where("asks").groupBy("id").agg(F.min_by("vector", "row").alias("vector"), F.min_by("width", "row").alias("width"))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    asked = asked.groupBy("width", block).agg(F.collect_list(F.struct("id", "vector")).alias("asked"))
    # A task holds a shelf of shards, and the blocks stream past it. They meet by one exchange: a join might send all blocks, once a shelf, to the driver.
    shelves = max(min(shards, TASKS), math.ceil(shards / max(1, NUMBERS // (shard * max(1, total["width"] or 1)))))
    shelf = F.pmod(F.col("shard"), F.lit(shelves)).alias("shelf")
    names = ["start", "points", "ids", "starts", "graph"]
    held = index.select("width", shelf, F.lit(False).alias("asks"), *names)
    come = asked.select("width", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))).alias("shelf"), F.lit(True).alias("asks"), "asked")
    met = held.unionByName(come, allowMissingColumns=True).repartition(4 * shelves, "width", "shelf").sortWithinPartitions("width", "shelf", "asks")
    found = met.select("width", "shelf", "asks", *names, "asked").mapInArrow(_search(k, degree, search_beam), "query_id long, id long, score double").distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_column), "score")
