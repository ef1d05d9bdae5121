"""The training-data pipeline over ``documents``: toxicity, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of
``documents``.  ``run`` writes each stage's result to the shared folder and reads it back for the next.

Cases are those of the operators called (NULL and empty texts, repeated rows, empty tables).  A document
that loses all its lines stays with an empty text; empty texts share a fingerprint, so one of them is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.llm.common import table
from pricepanel.llm.linededup import dedup_lines
from pricepanel.llm.mixing import mix_documents
from pricepanel.llm.packing import pack
from pricepanel.llm.simhash import drop_near_duplicates
from pricepanel.llm.toxicity import fit, score_toxicity
from pricepanel.session import cut_lineage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, by a network learnt from the labelled rows among them."""
    scored = score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")), score_col="_toxicity")
    return scored.filter(F.col("_toxicity") < 0.5).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines found in ten documents or more; ``n_chars`` follows the text."""
    kept = dedup_lines(docs, lines_col="_n_lines", dropped_col="_n_dropped")
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (3-word shingles, at most 3 bits)."""
    return drop_near_duplicates(docs, shingle=3, max_bits=3)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by target weights: a document stands as often as it is taken."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its bin, slot and offset."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash", simhash), ("mixing", mixing),
          ("packing", packing)]

#: The learnt toxicity scores have no SQL twin; tests hold run() against brute-force stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
