"""A corpus from raw documents to packed sequences, stage by stage.

Every stage reads what its predecessor has written, so that an executor lost later costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mediatide.llm import bin_packing, hamming_dedup, language_id, line_dedup, source_mixing
from mediatide.llm.common import store, table

STAGES = [
    ("language identification", language_id.stage),
    ("line deduplication", line_dedup.stage),
    ("near-duplicate removal", hamming_dedup.stage),
    ("source mixing", source_mixing.stage),
    ("sequence packing", bin_packing.stage),
]

#: Training a network, components of a graph and a packing search have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
