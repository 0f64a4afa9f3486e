"""From raw documents to a training mix, stage by stage.

Each stage is a function of (spark, docs, sf_dir) whose result is written as a table and read
again as the next one's documents, so a lost executor costs at most the stage under way. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postflow.llm.common import keep_table
from postflow.llm.decontaminate import remove_contaminated
from postflow.llm.line_dedup import drop_repeated_lines
from postflow.llm.minhash import keep_one_of_each
from postflow.llm.mixing import mix_blocks
from postflow.llm.quality_rules import filter_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_blocks(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near-duplicates", near_copies),
    ("decontamination", benchmark),
    ("mix", mix),
]

# The learned rules, the signatures and the random draws are not SQL; the tests compare each
# stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep_table(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
