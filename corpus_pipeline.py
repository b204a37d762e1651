"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.
Its result is written as Parquet below spark.checkpoint.dir and read again, so a
lost executor costs at most the work of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierwork.llm import decontaminate, jaccard, language, mixing, toxicity
from tierwork.session import scratch_path

STAGES = [
    ("toxicity", toxicity.stage),                       # toxic documents go
    ("language", language.stage),                       # documents of no known language go
    ("near_duplicates", jaccard.stage),                 # one document of each group stays
    ("decontamination", decontaminate.stage),           # documents that leak benchmark items go
    ("mixing", mixing.stage),                           # rate and copies towards the target weights
]

# Compression lengths, centroids and the randomised SVD have no SQL form; the tests
# hold run() against a stage-by-stage brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
