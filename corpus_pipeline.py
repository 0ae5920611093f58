"""The training-data pipeline: five stages over ``documents``, each stored before the next.

quality rules, line dedup, near duplicates, benchmark decontamination, mixing.  The last
stage draws at random by a seeded tree, which SQL cannot express.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plymill.llm import contamination, jaccard, lines, mixing, quality
from plymill.llm.graphs import stored

STAGES = [
    ("quality_rules", quality.stage),
    ("line_dedup", lines.stage),
    ("ngram_jaccard_join", jaccard.stage),
    ("benchmark_decontamination", contamination.stage),
    ("source_mixing", mixing.stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed documents: their columns with shard, epoch, words and order_key."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stored(step(spark, docs, sf_dir), name)
    return docs
