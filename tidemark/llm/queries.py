"""One query per operator of this package over its whole table, and SQL where SQL can state the rows."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, bpe, lm, minhash, mixing, packing, periods, phrases, quality, sharding, substrings, urls, vectors
from tidemark.llm.common import table

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 by doc_id."""
    docs = table(spark, sf_dir, "documents")
    size, crc = sharding.text_digest(F.col("text"))
    placed = sharding.shard(docs.select("doc_id", size.alias("size"), crc.alias("text_crc32")), "doc_id", 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules, else by its host's share of bad pages."""
    judged = urls.judge_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "bad_share", "good_share")


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.digests(packing.pack(table(spark, sf_dir, "documents")))


@query
def op5_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents on two-word shingles, similarity 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 20-word windows that stand earlier too."""
    docs = table(spark, sf_dir, "documents")
    kept = substrings.remove_repeats(docs.select("doc_id", "text"), carry_text=False)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op10_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op2_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of one label, cosine 0.98 or more."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


@query
def op7_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every vector whose id is divisible by 50."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op3_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under the attention model, and under word counts."""
    return lm.score(table(spark, sf_dir, "documents"))


def with_planted_run(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """In a tenth of the documents, by their ids, the words from some place on become repeats of the first of them."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document's words, and what is left without their repeats."""
    return periods.digests(table(spark, sf_dir, "documents"), prepare=with_planted_run)


@query
def op11_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, and how many of their words a mix of sources by weights 5, 2, 1 takes."""
    return mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op12_phrase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of every language, phrases of two and three words."""
    return phrases.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, inside=50, top=2000)


ORACLE["op12_phrase_graph"] = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, words FROM (
    SELECT coalesce(lang, 'und') AS lang,
           list_filter(regexp_split_to_array(unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[\x20\x09]'),
             lambda x: x <> '') AS words
    FROM documents)),
placed AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces),
ones AS (SELECT lang, words[i] AS x, count(*) AS f FROM placed GROUP BY 1, 2),
twos AS (SELECT lang, words[i] AS x, words[i + 1] AS y, count(*) AS f FROM placed WHERE i + 1 <= len(words) GROUP BY 1, 2, 3 HAVING count(*) >= 10),
threes AS (SELECT lang, words[i] AS x, words[i + 1] AS y, words[i + 2] AS z, count(*) AS f FROM placed WHERE i + 2 <= len(words)
           GROUP BY 1, 2, 3, 4 HAVING count(*) >= 10),
around AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM threes UNION ALL SELECT lang, y, z, f FROM threes) GROUP BY 1, 2, 3),
cuts AS (
  SELECT t.lang, t.x || ' ' || t.y AS phrase, 1 AS k, t.f AS a, p.f AS l, q.f AS r
  FROM twos t JOIN ones p ON p.lang = t.lang AND p.x = t.x JOIN ones q ON q.lang = t.lang AND q.x = t.y
  LEFT JOIN around o ON o.lang = t.lang AND o.x = t.x AND o.y = t.y
  WHERE o.f IS NULL OR 100 * o.f < 50 * t.f
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, 1, t.f, p.f, q.f
  FROM threes t JOIN ones p ON p.lang = t.lang AND p.x = t.x JOIN twos q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, 2, t.f, p.f, q.f
  FROM threes t JOIN twos p ON p.lang = t.lang AND p.x = t.x AND p.y = t.y JOIN ones q ON q.lang = t.lang AND q.x = t.z),
scored AS (SELECT *, CAST((CAST(a AS HUGEINT) * a * 1000000) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM ones GROUP BY 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
