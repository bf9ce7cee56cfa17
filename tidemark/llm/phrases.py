"""Collocations from a weighted de Bruijn graph of word grams.

An edge is a gram of the longest length K, between the nodes of its first and its last K - 1 words; its weight is how
often it occurs. Only edges are counted in the text. Every other count is flow: a phrase shorter than K occurs as
often as edges begin with it, plus the times it stands at the end of a piece, where no whole edge begins any more; those
ends are edges cut short (the missing words are null). Nodes that one edge enters and one edge leaves with all of the
node's flow lie inside an unary path; ``paths`` compacts these into one row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices, stored, texts

#: Bytes of text whose grams are counted at once before they travel; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20
#: Rows that leave a task at once.
ROWS = 1 << 15
#: A-Z to a-z, ends of pieces to line feed, tab to space.
FOLD = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 10 + b" ")
#: Language of rows that name none.
NO_LANG = "und"
#: Nodes with at least this share of a sample's edges are dealt out by their next words as well; there are at most 1 / SHARE.
SHARE, SAMPLE, SALTS = 1 / 4000, 0.02, 64


def gram_counts(data: bytes, longest: int) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """(node, next word, count) of all grams that begin at some word of folded text, in the order of their words.

    At the end of a piece the next word is null, then the node has fewer words. Rows in order make the shuffle small.
    """
    whole = pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(np.array([0, len(data)], np.int64)), pa.py_buffer(data)])
    pieces = pc.ascii_split_whitespace(pc.split_pattern(whole, "\n").flatten())
    words, lengths = pieces.flatten(), np.diff(pieces.offsets.to_numpy())
    piece = np.repeat(np.arange(len(lengths)), lengths)
    some = pc.greater(pc.binary_length(words), 0)  # runs of spaces at either end leave empty words
    words, piece = words.filter(some), piece[some.to_numpy(zero_copy_only=False)]
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(1, len(order) + 1)
    vocabulary = pa.concat_arrays([pa.nulls(1, pa.large_string()), coded.dictionary.take(order)])
    number, size, n = rank[coded.indices.to_numpy()], len(vocabulary), len(words)
    columns = [number]
    for k in range(1, longest):
        ahead = np.zeros(n, np.int64)
        if k < n:
            ahead[: n - k] = np.where(piece[k:] == piece[: n - k], number[k:], 0)
        columns.append(ahead)
    key, top = columns[0], size
    for c in columns[1:]:
        if top * size >= 1 << 62:
            seen, key = np.unique(key, return_inverse=True)
            top = len(seen)
        key, top = key * size + c, top * size
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    parts = [vocabulary.take(pa.array(c[first])) for c in columns]
    node = pc.binary_join_element_wise(*parts[:-1], pa.scalar(" ", pa.large_string()), null_handling="skip")
    return node.cast(pa.string()), parts[-1].cast(pa.string()), count


def _grams(docs: DataFrame, longest: int) -> DataFrame:
    """``gram, next, n``: grams counted slice by slice. ``gram`` is the node, a part (empty) and the language, with tabs between: one key is less to shuffle than three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, raw = batch.column(0).to_pylist(), texts(batch.column(1))
            for a, b in slices(np.array([len(t) + 1 for t in raw]), SLICE_BYTES):
                for own in sorted(set(lang[a:b])):
                    data = b"\n".join([t for t, x in zip(raw[a:b], lang[a:b]) if x == own]).translate(FOLD)
                    node, following, count = gram_counts(data, longest)
                    for at in range(0, len(count), ROWS):
                        gram = pc.binary_join_element_wise(node.slice(at, ROWS), f"\t\t{own}", "")
                        yield pa.RecordBatch.from_arrays([gram, following.slice(at, ROWS), pa.array(count[at : at + ROWS].astype(np.int32))], ["gram", "next", "n"])
                    del node, following, count, data
                    pa.default_memory_pool().release_unused()

    narrow = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "gram string, next string, n int")


def _broad(docs: DataFrame, longest: int) -> list[tuple]:
    """Grams of nodes with a large share of the edges, by a sample. They decide where rows go, never what is counted."""
    sample = _grams(docs.sample(SAMPLE, seed=11), longest)
    counted = stored(sample.groupBy("gram").agg(F.count("*").alias("rows")), "sampled-nodes")
    total = counted.agg(F.sum("rows")).first()[0] or 0
    return [(r["gram"],) for r in counted.where(F.col("rows") >= max(2.0, total * SHARE)).collect()]


def graph(docs: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """``lang, node, part, flow, next``: nodes (words joined by a space) with their flow and their edges of weight ``least`` or more (word, weight).

    A node is one row, but nodes with very many edges are several, by ``part`` (else null), each with its share of the flow; an
    edge is in one of them, whole. A node of fewer than K - 1 words ended its piece. A written table.
    """
    grams = _grams(docs, longest)
    broad = _broad(docs, longest)
    if broad:
        known = docs.sparkSession.createDataFrame(broad, "gram string").withColumn("broad", F.lit(True))
        part = F.pmod(F.xxhash64("next"), F.lit(SALTS)).cast("string")
        dealt = F.concat(F.substring_index("gram", "\t", 1), F.lit("\t"), part, F.substring("gram", F.instr("gram", "\t") + 1, F.length("gram")))
        grams = grams.join(F.broadcast(known), "gram", "left").select(F.when(F.col("broad"), dealt).otherwise(F.col("gram")).alias("gram"), "next", "n")
    # One shuffle: all edges of a node's part meet, so edges and nodes are added up where they are.
    edges = grams.repartition("gram").groupBy("gram", "next").agg(F.sum("n").alias("n"))
    strong = F.when(F.col("next").isNotNull() & (F.col("n") >= least), F.struct(F.col("next").alias("word"), F.col("n").alias("weight")))
    nodes = edges.groupBy("gram").agg(F.sum("n").alias("flow"), F.collect_list(strong).alias("next"))
    at = F.split("gram", "\t", 3)
    part = F.when(at[1] != "", at[1].cast("int"))
    return stored(nodes.select(at[2].alias("lang"), at[0].alias("node"), part.alias("part"), "flow", "next"), "phrase-graph", "zstd")


def _words(phrase: str = "phrase"):
    return F.length(phrase) - F.length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1


def counts(nodes: DataFrame, words: int, longest: int, least: int) -> DataFrame:
    """``lang, phrase, n`` of all phrases of that many words that occur ``least`` times or more."""
    if words == longest:
        return nodes.select("lang", "node", F.explode("next").alias("x")).select("lang", F.concat_ws(" ", "node", "x.word").alias("phrase"), F.col("x.weight").alias("n"))
    size = _words("node")
    if words == longest - 1:  # nodes of one part are complete
        whole = nodes.where((size == words) & (F.col("part").isNotNull() | (F.col("flow") >= least)))
    else:
        whole = nodes.where(size >= words)
    return whole.groupBy("lang", F.substring_index("node", " ", words).alias("phrase")).agg(F.sum("flow").alias("n")).where(F.col("n") >= least)


def _held(known: dict[int, DataFrame], words: int, longest: int) -> DataFrame | None:
    """``lang, phrase, longer``: how often the strongest longer phrase around each phrase occurs."""
    around = [
        known[i].select("lang", F.substring_index(F.substring_index("phrase", " ", s + words), " ", -words).alias("phrase"), F.col("n").alias("longer"))
        for i in range(words + 1, longest + 1) for s in range(i - words + 1)
    ]
    return reduce(DataFrame.unionByName, around).groupBy("lang", "phrase").agg(F.max("longer").alias("longer")) if around else None


def paths(known: dict[int, DataFrame], longest: int = 3) -> DataFrame:
    """``lang, phrase, words, n``: the edges of ``known`` (phrases by number of words) with unary paths compacted, one row a path.

    A node is inside a path if one edge enters and one leaves it with all its flow. Every edge learns its path's last edge
    by pointer jumping: as many equi joins as the longest path has binary digits, each a written table. No path is
    a cycle, as the first node of a piece has more flow than enters it.
    """
    edges = known[longest].select("lang", F.split("phrase", " ").alias("edge"), "n")
    head = lambda c: F.slice(c, 1, longest - 1)
    tail = lambda c: F.slice(c, 2, longest - 1)
    enters = edges.groupBy("lang", tail(F.col("edge")).alias("node")).agg(F.max("n").alias("most_in"))
    leaves = edges.groupBy("lang", head(F.col("edge")).alias("node")).agg(F.max_by(F.col("edge"), F.col("n")).alias("to"), F.max("n").alias("most_out"))
    flows = known[longest - 1].select("lang", F.split("phrase", " ").alias("node"), F.col("n").alias("flow"))
    inner = flows.join(enters, ["lang", "node"]).join(leaves, ["lang", "node"]).where("most_in = flow and most_out = flow").select("lang", "node", "to")
    jumps = edges.withColumn("node", tail(F.col("edge"))).join(inner, ["lang", "node"], "left")
    jumps = stored(jumps.select("lang", "edge", "n", F.coalesce("to", "edge").alias("to"), F.when(F.col("to").isNull(), 0).otherwise(1).alias("hops")), "jumps")
    while True:
        ahead = jumps.where("hops > 0").select("lang", F.col("edge").alias("to"), F.col("to").alias("beyond"), F.col("hops").alias("more"))
        if jumps.where("hops > 0").join(ahead, ["lang", "to"], "left_semi").isEmpty():
            break
        far = jumps.join(ahead, ["lang", "to"], "left")
        jumps = stored(far.select("lang", "edge", "n", F.coalesce("beyond", "to").alias("to"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops")), "jumps")
    chain = F.reverse(F.array_sort(F.collect_list(F.struct("hops", "edge"))))
    whole = jumps.groupBy("lang", "to").agg(chain.alias("chain"), F.max("n").alias("n"))
    words = F.concat(F.slice(F.col("chain")[0]["edge"], 1, longest - 1), F.transform("chain", lambda x: F.element_at(x["edge"], -1)))
    listed = whole.select("lang", words.alias("list"), "n")
    return listed.select("lang", F.concat_ws(" ", "list").alias("phrase"), F.size("list").alias("words"), "n")


def known_phrases(docs: DataFrame, longest: int = 3, least: int = 10) -> tuple[dict[int, DataFrame], DataFrame]:
    """Phrases with their counts, a written table for each number of words, and ``lang, total`` words."""
    nodes = graph(docs, longest, least)
    known = {j: stored(counts(nodes, j, longest, least), f"phrases-{j}") for j in range(1, longest + 1)}
    return known, nodes.groupBy("lang").agg(F.sum("flow").alias("total"))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, inside: int = 50, top: int | None = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of phrases of 2 to ``longest`` words that occur ``least`` times or more, by language.

    a: occurrences of the phrase; l, r: of the parts of its lowest-scoring cut (ties: the shortest first part); n: of all
    words of the language; score: floor(10^6 a a / (l r)), exact in decimals of 38 digits. Phrases that a longer one holds which
    occurs at least ``inside`` percent as often are left out: nodes inside unary paths, whose edges have all their flow,
    and others. ``top`` is the length of the report for a language, by score, a and the phrase's bytes; None: all.
    A null language is ``und``, a null text is empty; ids and other columns are not read, repeated rows count each.
    An empty table gives no rows.
    """
    known, totals = known_phrases(docs, longest, least)
    found = []
    for j in range(2, longest + 1):
        rows = known[j].withColumnRenamed("n", "a")
        if (held := _held(known, j, longest)) is not None:
            rows = rows.join(held, ["lang", "phrase"], "left").where("longer is null or cast(longer as decimal(19,0)) * 100 < cast(a as decimal(19,0)) * %d" % inside)
        cuts = []
        for k in range(1, j):
            rows = rows.withColumns({"first": F.substring_index("phrase", " ", k), "rest": F.substring_index("phrase", " ", k - j)})
            first = known[k].select("lang", F.col("phrase").alias("first"), F.col("n").alias(f"l{k}"))
            rest = known[j - k].select("lang", F.col("phrase").alias("rest"), F.col("n").alias(f"r{k}"))
            rows = rows.join(first, ["lang", "first"]).join(rest, ["lang", "rest"])
            square = "cast(a as decimal(19,0)) * cast(a as decimal(19,0)) * cast(1000000 as decimal(7,0))"
            score = F.expr(f"{square} div (cast(l{k} as decimal(19,0)) * cast(r{k} as decimal(19,0)))")
            cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        cut = cuts[0] if j == 2 else F.array_min(F.array(*cuts))
        found.append(rows.withColumn("cut", cut).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    ranked = reduce(DataFrame.unionByName, found)
    if top is not None:  # first among parts of a language, so that few rows of it meet
        ranked = ranked.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))).where(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
