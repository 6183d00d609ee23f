"""From raw documents to packed sequences: toxic documents go, one document of
each group of near copies stays, secrets are blanked, the rest is packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from swathe.llm import stages
from swathe.llm.common import stored, table

#: Each function takes (spark, docs, sf_dir).
STAGES = [
    ("toxicity", stages.without_toxic),
    ("simhash_near_dedup", stages.one_of_each_group),
    ("secret_scan", stages.secrets_blanked),
    ("best_fit_packing", stages.packed),
]

#: A learnt lexicon, XXH64, learnt automata and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
