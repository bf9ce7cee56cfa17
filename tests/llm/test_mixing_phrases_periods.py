"""Mixing, collocations and periodic runs against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute
from check_queries import compare, database
from pyspark.sql import functions as F

from tidemark.llm import mixing, periods, phrases
from tidemark.llm.common import stored
from tidemark.llm.queries import QUERIES, with_planted_run

SF_DIR = "/root/testdata/sf0.001"


def words_of(text) -> list[bytes]:
    return (text or "").encode().split()


# --- periodic runs ----------------------------------------------------------------------------


def plain_runs(words, shortest=24, repeats=3):
    n, out = len(words), set()
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            own = words[start : i + q]
            if len(own) >= max(shortest, repeats * q) and all(any(own[k] != own[k + e] for k in range(len(own) - e)) for e in range(1, q)):
                out.add((start, len(own), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(words):
    runs = plain_runs(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(150):
        docs = []
        for _ in range(rng.randint(0, 4)):
            words = []
            while rng.random() < 0.8:
                block = [rng.choice([b"a", b"b", b"c", b"d"][: rng.choice([2, 4])]) for _ in range(rng.randint(1, rng.choice([2, 5, 40])))]
                words += (block * rng.randint(1, 9))[: rng.randint(1, 200)]
            docs.append(words)
        shortest, repeats = rng.choice([(24, 3), (3, 3), (10, 4), (24, 5), (7, 3)])
        assert periods.find_runs(docs, shortest, repeats) == [plain_runs(d, shortest, repeats) for d in docs]


def test_runs_of_a_long_text_are_found_in_little_time():
    assert periods.find_runs([[b"a"] * 300_000, [], [b"a", b"b"] * 100_000]) == [[(0, 300_000, 1)], [], [(0, 200_000, 2)]]
    block = [b"%d" % i for i in range(50_000)]
    assert periods.find_runs([block * 3 + block[:7]]) == [[(0, 150_007, 50_000)]]


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "la " * 24), (4, "la " * 24), (5, "la " * 23), (None, "x y " * 30), (None, None),
    (6, "Ünï é\x0b" * 20 + "中"), (7, "a\x1cb " * 30), (8, ("p q r " * 9) + ("s t " * 15) + "end"), (9, ("u " * 30 + "v ") * 4),
]


def test_collapsed_runs_of_odd_texts(spark):
    frame = spark.createDataFrame([(i, t, "old", 5) for i, t in ODD], "doc_id long, text string, runs string, n_runs int")
    got = periods.collapse_runs(frame).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "n_runs", "runs", "collapsed"}
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(ODD)
    for r in got:
        runs = plain_runs(words_of(r["text"]))
        assert [tuple(x) for x in r["runs"]] == runs
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        assert r["collapsed"].encode() == b" ".join(w for i, w in enumerate(words_of(r["text"])) if i not in gone)
    assert periods.collapse_runs(frame.limit(0)).count() == 0 and periods.digests(frame.limit(0)).count() == 0


def test_digests_of_odd_texts(spark):
    frame = spark.createDataFrame(ODD, "doc_id long, text string")
    assert Counter(tuple(r) for r in periods.digests(frame).collect()) == Counter((i, *plain_digest(words_of(t))) for i, t in ODD)


def test_periodic_runs_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for doc_id, text in docs:
        words = words_of(text)
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert words == with_planted_run(doc_id, words_of(text))
        want.append((doc_id, *plain_digest(words)))
    assert sum(w[1] > 0 for w in want) > 5
    assert sorted(tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()) == sorted(want)


# --- collocations -----------------------------------------------------------------------------


def plain_collocations(rows, longest, least, inside, top):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(brute.LOWER)):
            words = [w for w in re.split(r"[ \t]", piece) if w]
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        often = {p: a for p, a in f.items() if a >= least}
        around = Counter()
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i : i + k]] = max(around[p[i : i + k]], a)
        for p, a in often.items():
            if len(p) > 1 and not 100 * around[p] >= inside * a:
                score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                found.append((score, a, " ".join(p), l, r))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, l, r, total[lang], s) for i, (s, a, p, l, r) in enumerate(found[:top])]
    return sorted(out)


def _texts(rng) -> list:
    common = "the of and a To in IS that".split()
    rows = [(None, None), ("en", ""), (None, " .\n; "), ("und", "the of the of. the of"), ("en", "É é\tÉ é, \x1c x\x1c y! 中文 中文"), ("en", "one")]
    license_line = "all rights reserved by the very long name of this work"
    for _ in range(160):
        words = [rng.choice(common) if rng.random() < 0.7 else "w" + str(rng.randint(0, 30)) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", " \r\n", "? "]) for w in words)
        rows.append((rng.choice(["en", "de", None]), text + (license_line if rng.random() < 0.3 else "")))
    return rows + rows[-3:] * 2


@pytest.mark.parametrize(("longest", "least", "inside", "top"), [(3, 10, 50, 2000), (3, 2, 90, 7), (2, 3, 50, None), (4, 3, 60, 50)])
def test_collocations_equal_brute_force(spark, longest, least, inside, top):
    rows = _texts(random.Random(longest))
    frame = spark.createDataFrame([(i, x, t, "k", 3) for i, (x, t) in enumerate(rows)], "doc_id long, lang string, text string, phrase string, n int").repartition(3)
    got = phrases.collocations(frame, longest, least, inside, top).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, longest, least, inside, top)


def test_broad_nodes_and_small_slices_change_nothing(spark, monkeypatch):
    rows = _texts(random.Random(9))
    frame = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(phrases, "SLICE_BYTES", 500)
    monkeypatch.setattr(phrases, "SAMPLE", 1.0)
    monkeypatch.setattr(phrases, "SHARE", 1e-3)
    assert phrases.graph(frame, 3, 2).where("part is not null").count() > 50
    assert sorted(map(tuple, phrases.collocations(frame, 3, 2, 50, None).collect())) == plain_collocations(rows, 3, 2, 50, None)


def test_unary_paths_are_one_row(spark):
    line, other = "all rights reserved by the name of this work", "a quite different sentence follows here"
    frame = spark.createDataFrame([("en", f"{line}. {other}")] * 12 + [("en", "reserved by")], "lang string, text string")
    known, _ = phrases.known_phrases(frame)
    # "reserved by" stands alone once more, so the path ends before and begins after that node.
    want = {("all rights reserved by", 4, 12), ("reserved by the name of this work", 7, 12), (other, 6, 12)}
    assert {tuple(r[1:]) for r in phrases.paths(known).collect()} == want


def test_collocations_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], "doc_id long, lang string, text string")).count() == 0


def test_products_beyond_64_bits_are_exact(spark):
    big = 3_000_000_007
    frame = spark.createDataFrame([(big, big + 11, big + 5)], "a long, l1 long, r1 long")
    got = frame.select(
        F.expr("cast(a as decimal(19,0)) * cast(a as decimal(19,0)) * cast(1000000 as decimal(7,0)) div (cast(l1 as decimal(19,0)) * cast(r1 as decimal(19,0)))")
    ).first()[0]
    assert got == 10**6 * big * big // ((big + 11) * (big + 5))


@pytest.mark.parametrize("folder", [SF_DIR, "/root/testdata/sf0.01"])
def test_collocations_query_equals_sql(spark, folder):
    assert compare(spark, database(folder), "op12_phrase_graph", folder) is None


# --- mixing -----------------------------------------------------------------------------------


def plain_targets(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full, given = sum(sizes.values()), set(), {}
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(most * sizes[s] for s in full)
        given = {s: Fraction(most * sizes[s]) if s in full else Fraction(rest * weight[s], sum(weight[x] for x in free)) for s in order}
        above = {s for s in free if given[s] > most * sizes[s]}
        if not above:
            return given
        full |= above


def check_mix(rows, got, most=3):
    """``rows``: (id, source, text); ``got`` has the id, source and results."""
    sizes = [len(words_of(t)) for _, _, t in rows]
    by_source = Counter()
    for (_, s, _), n in zip(rows, sizes):
        by_source[s] += n
    want = plain_targets(by_source)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((i, s, n) for (i, s, _), n in zip(rows, sizes))
    taken, copies = Counter(), Counter()
    for r in got:
        target, whole = float(want[r["source"]]), by_source[r["source"]]
        assert r["source_size"] == whole and np.isclose(r["target"], target, rtol=1e-12)
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= most
        if r["size"]:
            assert np.floor(target / whole - 1e-9) <= r["copies"] <= np.ceil(target / whole + 1e-9)
        taken[r["source"]] += r["taken"]
        copies[r["source"]] += r["copies"]
    for s, whole in by_source.items():
        own = [n for (_, x, _), n in zip(rows, sizes) if x == s and n]
        if own:
            assert abs(taken[s] - want[s]) <= max(own)
            assert abs(copies[s] - want[s] / whole * len(own)) <= 2
    return taken, want


def _sources(rng) -> list:
    rows = [(1, None, None), (2, "a", ""), (None, "a", "one two"), (3, "empty", " \n"), (4, "Zeta", "w " * 4000), (4, "Zeta", "w " * 4000)]
    for i in range(5, 1500):
        source = rng.choice(["a", "a", "a", "a", "b", "É", "z", None, "c%d" % (i % 5)])
        rows.append((i, source, " ".join(["x"] * int(rng.lognormvariate(3, 1)))))
    return rows


def test_mix_is_balanced_and_repeats_itself(spark, monkeypatch):
    rows = _sources(random.Random(5))
    frame = spark.createDataFrame([(i, s, t, "old", 7) for i, s, t in rows], "doc_id long, source string, text string, taken string, number int")
    answers = []
    for parts in (2, 5):
        got = mixing.mix(frame.repartition(parts)).collect()
        assert {"text", "number", "target"} <= set(got[0].asDict()) and len(got[0]) == 9
        check_mix(rows, got)
        answers.append(Counter((r["doc_id"], r["source"], r["size"], r["taken"]) for r in got))
    assert answers[0] == answers[1]
    monkeypatch.setattr(mixing, "GROUP", 20)
    monkeypatch.setattr(mixing, "FAN", 3)
    check_mix(rows, mixing.mix(frame, keep=["doc_id", "source"]).collect())


def test_mix_query_and_its_copies(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "text").collect()]
    source = {i: s for i, s, _ in rows}
    got = [{**r.asDict(), "source": source[r["doc_id"]]} for r in QUERIES["op11_cube_mixing"](spark, SF_DIR).collect()]
    taken, _ = check_mix(rows, got)
    again = QUERIES["op11_cube_mixing"](spark, SF_DIR).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)
    real = mixing.copies_of(stored(mixing.mix(docs), "mixed"))
    assert real.agg(F.sum(mixing.word_count("text"))).first()[0] == sum(taken.values())


def test_targets_stop_and_are_reshared(spark):
    sizes = {"a": 10, "b": 1000, "c": 1, "d": 3, "e": 0, "f": 40, None: 7}
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(np.isclose(got[s], float(want[s])) for s in sizes)
    assert np.isclose(sum(got.values()), sum(sizes.values())) and got["a"] == 30 and got["e"] == 0


def test_mix_of_nothing_and_of_empty_texts(spark):
    schema = "doc_id long, source string, text string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    got = mixing.mix(spark.createDataFrame([(1, "a", None), (2, None, "")], schema)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2


def test_flights_keep_words_and_documents():
    rng = np.random.default_rng(3)
    sizes, chances = rng.integers(1, 500, 2000).astype(float).tolist(), [0.37] * 2000
    left = mixing.fly(sizes, chances, rng.random(2000).tolist(), land=False)
    assert len(left) <= 2 and all(c in (0.0, 1.0) for i, c in enumerate(chances) if i not in left)
    assert np.isclose(np.dot(sizes, chances), 0.37 * sum(sizes)) and np.isclose(sum(chances), 740)


def test_every_document_keeps_its_chance():
    sizes = [5.0, 5.0, 9.0, 1.0, 30.0]
    rng = np.random.default_rng(0)
    mean = np.zeros(5)
    for _ in range(4000):
        chances = [0.3] * 5
        mixing.fly(sizes, chances, rng.random(5).tolist(), land=False)
        mean += np.array(chances) / 4000
    assert np.abs(mean - 0.3).max() < 0.03
