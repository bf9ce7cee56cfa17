"""Corpus pipeline: quality, near duplicates, repeated passages, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` applies them one
after another to ``documents``, each reading what the one before has written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import minhash, packing, quality, substrings
from tidemark.llm.common import LAST, free_name, stored, table


def _aside(docs: DataFrame, *taken: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its own columns of the given names under others, and the way back: operators replace columns of these names."""
    away = {c: free_name([*docs.columns, *taken], f"own_{c}") for c in docs.columns if c.lower() in taken}
    return docs.withColumnsRenamed(away), {new: old for old, new in away.items()}


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3, learned from the labels that are not held out; all columns as they are, whatever their names.

    Null and empty texts are scored like others, rows with a null id take part and repeated rows get equal answers. An empty table gives an empty one.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    own, back = _aside(docs, "score", "predicted")
    return quality.score(own, model).where("predicted = 1").drop("score", "predicted").withColumnsRenamed(back).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8): the one with the smallest doc_id.

    Documents without words stand alone and stay. Of repeated rows of the smallest id one stays; rows of one id with
    different texts that link with nothing all stay. Without any id in a group, one row stays.
    """
    row, key = free_name(docs.columns, "row"), free_name(docs.columns, "key")
    # Rows of one id and text are told apart only where they would all be kept.
    fixed = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias(key)
    groups = minhash.near_duplicates(fixed.select(row, "text"), id_column=row)
    grouped = fixed.select(row, order).join(groups.where("n_shingles > 0").select(row, "component_id"), row)
    kept = grouped.groupBy("component_id").agg(F.min(F.struct(key, row)).alias("first")).select(F.col(f"first.{row}").alias(row))
    alone = groups.where("n_shingles = 0").select(row)
    return fixed.join(kept.union(alone), row, "left_semi").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 20-word windows that stand earlier too; n_chars follows. Texts with nothing to remove stay as they are.

    A document that loses all its words stays with an empty text. Null texts stay null, rows without an id come after all
    others, and columns named like the operator's own stay as they are. An empty table gives an empty one.
    """
    own, back = _aside(docs, "n_words", "n_removed", "kept")
    cut = substrings.remove_repeats(own)
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.char_length("kept").cast(kind)).otherwise(F.col("n_chars"))
    return cut.withColumns(new).drop("n_words", "n_removed", "kept").withColumnsRenamed(back).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: every piece of every document, with a checksum of its ids.

    Null texts count as empty; null and repeated ids are packed row by row; other columns are not carried. An empty table gives no rows.
    """
    return packing.digests(packing.pack(docs))


STAGES = [
    ("quality classifier", keep_good),
    ("near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("packing", pack),
]

#: A fitted model and a tokenizer decide here, which SQL can't express; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
