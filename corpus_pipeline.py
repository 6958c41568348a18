"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last return the
columns of ``documents``. Nulls, empty texts, repeated rows and empty tables are handled as each operator says.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm import decontaminate, line_dedup, mixing, similar, toxicity
from glyphmill.llm.common import remove, shared_dir


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon scores below the threshold stay; it is learned from the labels of this stage's documents."""
    model = toxicity.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where(F.col("_toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents hold go, but for the document of the largest id; n_chars follows the text."""
    out = line_dedup.drop_repeated_lines(docs)
    text = F.when(F.col("_n_dropped") > 0, F.col("_kept")).otherwise(F.col("text"))
    new = {"text": text, "n_chars": F.when(F.col("_n_dropped") > 0, F.length("_kept").cast("long")).otherwise(F.col("n_chars"))}
    return out.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays that op4's fingerprints or a similarity of 0.8 of the shingles connect."""
    return similar.drop_near_duplicates(docs, fingerprints=True)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    out = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.where(F.size("_hit") == 0).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen to meet the sources' target weights, with the epochs in which each takes part."""
    return mixing.mixed(docs).select(*docs.columns, F.col("_epochs").alias("epochs"))


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_lines),
    ("simhash near-dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

#: The toxicity model and the near-duplicates are beyond SQL; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each stage's result is a Parquet table in the shared folder, which goes when the next one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{root}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{root}/{k}")
        if k:
            remove(spark, f"{root}/{k - 1}")
    return docs
