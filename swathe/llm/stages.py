"""Stages of the corpus pipeline: documents in, documents out, packed pieces last."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swathe.llm import packing, secrets, simhash, toxicity
from swathe.llm.common import ship, stored, table
from swathe.llm.queries import toxicity_model


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is not predicted toxic; the lexicon is learnt from ``labels`` outside the held-out quarter."""
    ship(spark)
    named = _safe(docs)
    scored = toxicity.score(named, toxicity_model(spark, docs, sf_dir))
    return _restored(scored.where("predicted = 0"), docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word Jaccard of 0.8 or more), that of the smallest id.

    Where a row is repeated, or ids are repeated or null, hashes of the words tell
    the rows apart; of equal ones one row stays.
    """
    ship(spark)
    found = stored(simhash.near_copies(_safe(docs)), "found")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    shared = stored(found.groupBy("doc_id").count().where("doc_id is null or count > 1").select("doc_id"), "shared")
    dropped = found.where(~stays & F.col("doc_id").isNotNull()).select("doc_id")
    if shared.isEmpty():
        return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    gone = dropped.unionAll(shared.where("doc_id is not null"))
    alone = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti").select(*docs.columns)
    kept = found.where(stays).select(F.col("doc_id").alias("kept_id"), F.col("mark").alias("kept_mark")).distinct()
    safe = _safe(docs)
    several = safe.join(shared.withColumnRenamed("doc_id", "shared_id"), F.col("doc_id").eqNullSafe(F.col("shared_id")), "left_semi")
    prints = simhash.marks(several)
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("mark") == F.col("kept_mark"))
    once = prints.join(kept, same, "left_semi").dropDuplicates(["doc_id", "mark"])
    return alone.unionAll(_restored(once, docs))


def secrets_blanked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found in a text replaced by a mark."""
    ship(spark)
    return secrets.blank(docs, secrets.learn(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens."""
    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def _safe(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but the id and the text under names that no operator adds."""
    return docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(f"_kept_{i}") for i, c in enumerate(docs.columns)))


def _restored(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"_kept_{i}").alias(c) for i, c in enumerate(docs.columns)))
