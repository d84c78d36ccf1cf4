"""The corpus pipeline: from raw documents to token records, each stage on what the one before it kept.

Every stage takes (spark, docs, sf_dir), docs with the columns of `documents`, and gives a DataFrame with those
columns; the last one gives the digest of the records that it wrote and read back. `run` writes each stage's rows to
the shared folder and rereads them, so a lost executor costs one stage at most.

Defined results, stage by stage, of odd rows. Quality rules: a null, empty or wordless text goes, as it has under 50
words; a very long one is scored whole; repeated rows share their verdict. Near duplicates: of repeated rows, and of
texts that link, one row stays, the one with the least id (null ids last, then by a hash of the row); texts without
words link with nothing and stay. Decontamination: a text without words matches nothing and stays; repeated rows share
their fate. Mix: a text without words is taken with its whole copies at most; a null source is a source; equal ranks
fall back on a hash. Records: a null text is the end id alone, null ids come first. An empty table gives no rows in any
stage, and columns other than id, text and source can have any name and value, but for `_row`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnwheel.llm import decontaminate, jaccard, mixing, quality, records
from tarnwheel.session import marked, ship, sweep, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the model of quality; the model is fitted on a bounded sample of the labelled ones of docs."""
    ship(spark)
    return quality.keep(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (five words, 0.8): the one with the least id."""
    ship(spark)
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any item of the benchmark, whole or at a similarity of 0.8 or more."""
    ship(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken, at most three times."""
    ship(spark)
    return mixing.repeat(docs, odds=mixing.short_odds())


def write_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records, written and read back."""
    ship(spark)
    return records.encoded(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_records),
]

#: SQL can express neither the model nor the tokenizer; tests/llm/test_pipeline.py compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        since = marked()
        docs = written(stage(spark, docs, sf_dir), f"stage-{k}")
        sweep(spark, since, docs)  # the stage's own tables; its rows are written
    return written(STAGES[-1][1](spark, docs, sf_dir), "stage-last")
