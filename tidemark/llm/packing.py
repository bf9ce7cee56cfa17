"""Packing of token sequences by non-negative least squares over shallow combinations of lengths.

Documents are cut into full windows and a rest. The histogram of rests goes to the driver (one count per length
class, so its size is fixed); there, combinations of up to three classes that fill a window are enumerated, their
repeat counts solved against the histogram by non-negative least squares, and rounded down. Executors then deal
the rests of a class to the combinations by rank, and pack what is left greedily, one rest after another, cut
where a window ends.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Memo, map_batches, slices, stored

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
WINDOW = 4096
#: Tokens of a length class: rests of a class count as its longest.
CLASS = 16
#: Bytes of text, one text at the least, that are tokenised at one time.
SLICE = 4_000_000
#: Code points that are white space to Python and not to the tokenizer, and texts of added tokens.
_ODD = re.compile("[\x1c-\x1f]|<\\|(?:start|end)oftext\\|>")
#: A word of letters whose lower case and normal form need no context, and marks after it that form one piece; either may lack.
_SIMPLE = re.compile(r"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]*)([!-&(-/:-@\[-`{-~]*)")
#: Bytes as the characters that byte-level vocabularies write for them: printable ones themselves, the rest from 256 on.
_PRINTED = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
_BYTES = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}


class _Chunks(Memo):
    """Ids of white-space separated chunks as 16-bit numbers, remembered up to a bounded number of chunks."""

    def __init__(self, path: str, most: int = 300_000):
        from tokenizers import Tokenizer

        super().__init__(most)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.code = np.dtype(self.kind).char

    def make(self, chunk: str) -> bytes:
        simple = _SIMPLE.fullmatch(chunk) if len(chunk) < self.longest else None
        if not simple:
            return self.whole(chunk)
        word, marks = simple[1].lower(), simple[2]
        if marks == chunk or word == chunk:
            return self.piece(chunk)
        # Words stand beside different marks and in different case: their parts are chunks of their own here.
        return self[word] + self[marks] if marks else self[word]

    def piece(self, piece: str) -> bytes:
        """Ids of one piece that is lower-cased already."""
        written = piece if piece.isascii() else "".join(map(_BYTES.__getitem__, piece.encode()))
        return array(self.code, [t.id for t in self.model.tokenize(written)]).tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, data: pa.Array) -> list[bytes]:
        """Ids of every text (none null). Each distinct chunk of them is looked up once, however often it stands there.

        The tokenizer never joins across white space, so chunks between it can be encoded one by one.
        """
        odd = pc.match_substring_regex(data, _ODD.pattern)
        chunks = pc.utf8_split_whitespace(pc.if_else(odd, "", data))
        coded = chunks.flatten().dictionary_encode()
        ids = [self[x] for x in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind().itemsize
        at = coded.indices.to_numpy()
        ends = np.cumsum(size[at])
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat((np.cumsum(size) - size)[at] - ends + size[at], size[at])
        values = np.frombuffer(b"".join(ids), self.kind)[place]
        first = chunks.offsets.to_numpy()
        bounds = np.concatenate([[0], ends])[first - first[0]].tolist()
        out = [values[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self.whole(data[i].as_py())
        return out


@lru_cache(2)
def chunks(path: str) -> _Chunks:
    return _Chunks(path)


def tokenise(docs: DataFrame, path: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, row, doc_tokens, ids``: every document's ids and the end id, 16 bits each where the vocabulary allows.

    ``row`` names the row, so repeated and null doc_ids stay apart. Null texts count as empty: the end id alone.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = chunks(path)
        end = np.array([end_id], coder.kind).tobytes()
        column = pc.fill_null(batch.column(1), "")
        sizes = pc.binary_length(column).to_numpy().astype(np.int64)
        ids = [x + end for a, b in slices(sizes, SLICE) for x in coder.encode_all(column.slice(a, b - a))]
        n = np.array([len(x) for x in ids], np.int64) // coder.kind().itemsize
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n), pa.array(ids, pa.binary())], ["doc_id", "row", "doc_tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return map_batches(rows, run, f"doc_id {kind}, row long, doc_tokens long, ids binary")


def combinations(classes: int) -> np.ndarray:
    """All combinations of one to three classes, as columns of counts per class, whose sizes sum to ``classes`` exactly."""
    made = []
    for a in range(1, classes + 1):
        if a == classes:
            made.append((a,))
        for b in range(a, classes - a + 1):
            if a + b == classes:
                made.append((a, b))
            elif (c := classes - a - b) >= b:
                made.append((a, b, c))
    out = np.zeros((classes + 1, len(made)))
    for k, parts in enumerate(made):
        for p in parts:
            out[p, k] += 1
    return out


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 with least ||a x - b||, by active sets; no more entries of x than rows of a are above 0."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, np.abs(b).max(initial=0))
    for _ in range(rounds):
        slope = np.where(free, -np.inf, a.T @ (b - a @ x))
        if slope.max(initial=-np.inf) <= tolerance:
            break
        free[slope.argmax()] = True
        while free.any():
            at = np.flatnonzero(free)
            own = a[:, at]
            z = np.linalg.solve(own.T @ own + 1e-10 * np.eye(len(at)), own.T @ b)  # dependent columns stay solvable
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            low, old = z <= 0, x[at]
            step = (old[low] / np.maximum(old[low] - z[low], 1e-300)).min()
            x[at] = np.maximum(old + step * (z - old), 0)
            drop = at[low & (x[at] <= 1e-12)]
            drop = drop if len(drop) else at[low][:1]
            x[drop] = 0
            free[drop] = False
    return x


def plan(histogram: np.ndarray) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(rows, number of planned sequences). A row: class, first rank, last rank (exclusive), first sequence, place.

    The rests of a class with these ranks go one each to consecutive sequences, at that place of the combination. Never
    more than there are: counts are rounded down, then cut to what the classes still have.
    """
    classes = len(histogram) - 1
    a = combinations(classes)
    used = a[:, (a[histogram == 0] == 0).all(axis=0)] if (histogram == 0).any() else a
    scale = max(1.0, histogram.max())
    x = np.floor(non_negative_least_squares(used[1:], histogram[1:] / scale) * scale + 1e-6).astype(np.int64)
    left, rows, sequence = histogram.astype(np.int64).copy(), [], 0
    for k in np.argsort(-x, kind="stable"):
        need = used[:, k].astype(np.int64)
        at = np.flatnonzero(need)
        times = int(min(x[k], (left[at] // need[at]).min()))
        if times <= 0:
            continue
        place = 0
        for c in at[::-1]:
            for _ in range(need[c]):
                rank = int(histogram[c] - left[c])
                rows.append((int(c), rank, rank + times, sequence, place))
                left[c] -= times
                place += 1
        sequence += times
    return rows, sequence


def _numbered(df: DataFrame, group: str, buckets: int, order: str = "row") -> DataFrame:
    """Adds ``rank``, gapless from 0 within each group, and no task holds a whole group: buckets of rows, then their starts.

    The table of starts has at most groups x buckets rows, both fixed.
    """
    dealt = df.withColumn("bucket", F.pmod(F.xxhash64(order), F.lit(buckets)))
    before = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(group, "bucket").agg(F.count("*").alias("size"))
    starts = sizes.select(group, "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy(group, "bucket").orderBy(order)
    numbered = dealt.withColumn("inside", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(starts), [group, "bucket"]).withColumn("rank", F.col("inside") + F.col("begin")).drop("bucket", "inside", "begin")


def _offsets(df: DataFrame, length: str, buckets: int) -> DataFrame:
    """Adds ``at``: the sum of ``length`` over all rows before, in an order by hashed buckets; gapless like ``_numbered``."""
    dealt = df.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    sizes = dealt.groupBy("bucket").agg(F.sum(length).alias("size"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin"))  # at most ``buckets`` rows
    inside = Window.partitionBy("bucket").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.withColumn("inside", F.coalesce(F.sum(length).over(inside), F.lit(0)))
    return summed.join(F.broadcast(starts), "bucket").withColumn("at", F.col("inside") + F.col("begin")).drop("bucket", "inside", "begin")


def pieces(lengths: DataFrame, window: int = WINDOW, width: int = CLASS, buckets: int = 4096) -> DataFrame:
    """``row, start, length, sequence_id, offset`` of every piece, for ``lengths``: row (unique), doc_tokens.

    Full windows of a document are sequences of their own. Empty documents (no tokens) have no pieces.
    """
    spark = lengths.sparkSession
    lengths = lengths.where("doc_tokens > 0")
    classes = window // width
    full = F.floor(F.col("doc_tokens") / window)
    rest = F.col("doc_tokens") % window
    rests = lengths.select("row", (F.col("doc_tokens") - rest).alias("start"), rest.alias("length")).where("length > 0")
    rests = rests.withColumn("class", F.ceil(F.col("length") / width).cast("int"))
    histogram = np.zeros(classes + 1, np.int64)
    for r in rests.groupBy("class").count().collect():  # one row per class
        histogram[r["class"]] = r["count"]
    rows, planned = plan(histogram)
    schema = "class int, first long, last long, sequence long, place int"
    table = spark.createDataFrame(rows, schema)  # at most three rows per combination kept, of which there are no more than classes
    dealt = stored(_deal(_numbered(rests, "class", max(1, buckets // classes)), table), "dealt")
    inside = Window.partitionBy("sequence").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    combined = dealt.where("sequence is not null").select(
        "row", "start", "length", F.col("sequence").alias("sequence_id"), F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset")
    )
    # What is left: one after another, cut where a window ends.
    left = _offsets(dealt.where("sequence is null").select("row", "start", "length"), "length", buckets)
    first, last = F.floor(F.col("at") / window), F.floor((F.col("at") + F.col("length") - 1) / window)
    cut = left.withColumn("w", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("at"), F.col("w") * window)
    end = F.least(F.col("at") + F.col("length"), (F.col("w") + 1) * window)
    greedy = cut.select(
        "row", (F.col("start") + begin - F.col("at")).alias("start"), (end - begin).alias("length"),
        (F.col("w") + planned).alias("sequence_id"), (begin - F.col("w") * window).alias("offset"),
    )
    rest_sequences = dealt.where("sequence is null").agg(F.coalesce(F.ceil(F.sum("length") / window), F.lit(0)).alias("n"))
    base = planned + rest_sequences.first()["n"]
    whole = lengths.select("row", full.alias("windows")).where("windows > 0")
    counted = _offsets(whole, "windows", buckets)
    filled = counted.withColumn("w", F.explode(F.sequence(F.lit(0).cast("long"), F.col("windows") - 1))).select(
        "row", (F.col("w") * window).alias("start"), F.lit(window).cast("long").alias("length"),
        (F.col("at") + F.col("w") + base).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return combined.union(greedy).union(filled)


def _deal(ranked: DataFrame, table: DataFrame) -> DataFrame:
    """Adds ``sequence`` and ``place`` (null: left over). A class has few rows in the plan, kept as one sorted array."""
    plans = table.groupBy("class").agg(F.array_sort(F.collect_list(F.struct("last", "first", "sequence", "place"))).alias("plan"))
    hit = F.get(F.filter("plan", lambda p: (F.col("rank") >= p["first"]) & (F.col("rank") < p["last"])), F.lit(0))
    found = ranked.join(F.broadcast(plans), "class", "left").withColumn("hit", F.when(F.col("plan").isNotNull(), hit))
    return found.select("row", "start", "length", (F.col("hit.sequence") + F.col("rank") - F.col("hit.first")).alias("sequence"), F.col("hit.place").alias("place"))


def pack(docs: DataFrame, window: int = WINDOW, path: str = VOCABULARY, end_id: int = END_ID, width: int = CLASS, buckets: int = 4096) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: every piece with its ids (binary, 32 bits each, little-endian).

    Each id of every document lies in exactly one piece; offsets in a sequence are gapless from 0 and lengths sum to at most
    ``window``. Null texts count as empty (the end id alone). Null and repeated doc_ids and repeated rows are packed row by
    row. An empty table gives an empty one. Other columns are not carried.
    """
    tokens = stored(tokenise(docs, path, end_id), "tokens")
    placed = pieces(tokens.select("row", "doc_tokens"), window, width, buckets)
    # The pieces of a row meet its ids once. A row's pieces are as many as its tokens fill windows.
    lists = placed.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("cuts"))
    joined = tokens.join(lists, "row").select("doc_id", "doc_tokens", "ids", "cuts")
    kind = docs.schema["doc_id"].dataType.simpleString()
    small = chunks(path).kind

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, total, out, numbers = [], [], [], []
        for d, n, ids, cuts in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
            values = np.frombuffer(ids.as_buffer(), small)
            for c in cuts:
                doc.append(d.as_py())
                total.append(n)
                numbers.append((c["start"], c["length"], c["sequence_id"], c["offset"]))
                out.append(values[c["start"] : c["start"] + c["length"]].astype("<u4").tobytes())
        start, length, sequence, offset = np.array(numbers, np.int64).reshape(-1, 4).T
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, batch.column(0).type), *map(pa.array, (start, length)), pa.array(out, pa.binary()), pa.array(total, pa.int64()), *map(pa.array, (sequence, offset))],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )

    return map_batches(joined, cut, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digests(packed: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
