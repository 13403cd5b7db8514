"""Corpus pipeline: rejected documents go, then copies, then near copies; the rest is mixed and packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrylake.llm.common import store
from quarrylake.llm.exact_dedup import keep_first
from quarrylake.llm.mixing import take_mix
from quarrylake.llm.near_dedup import keep_one
from quarrylake.llm.packing import pack_stage
from quarrylake.llm.quality import keep_good

STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", keep_first),
    ("minhash near-dedup", keep_one),
    ("mixing", take_mix),
    ("packing", pack_stage),
]

#: SQL cannot express a trained classifier, sketches or a seeded draw.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
