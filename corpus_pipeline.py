"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet under the shared folder and the next stage reads that.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.llm.common import materialize, read_table
from sifter.llm.decontam import remove_contaminated
from sifter.llm.line_dedup import dedup_lines
from sifter.llm.packing import pack_documents
from sifter.llm.simhash import keep_one_of_each
from sifter.llm.toxicity import remove_toxic

#: SQL cannot express the trained stage; the stages are tested against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5."""
    return remove_toxic(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of line runs of 50 words or more; n_chars follows an edited text."""
    edited = dedup_lines(docs, min_words=50)
    return edited.withColumn("n_chars", F.when(F.col("n_lines_dropped") > 0, F.length("text").cast("long"))
                             .otherwise(F.col("n_chars"))).drop("n_lines_dropped")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints at three bits: the one with the least doc_id."""
    return keep_one_of_each(docs, shingle=3, distance=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window of ten words."""
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of 4096 ids: one row per piece."""
    return pack_documents(docs, with_ids=False)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
