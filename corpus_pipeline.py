"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that run() writes
as Parquet in the shared folder and reads again as the next stage's docs. All
but the last return the columns of docs. Nulls, empty and very long texts, ties,
repeated rows, empty tables and extra columns are handled as each operator says.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lakewright.llm import decontaminate, exact_dedup, near_dedup, packing, toxicity
from lakewright.llm.memory import small_batches
from lakewright.llm.queries import tokenizer_path
from lakewright.llm.runtime import materialise, table


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage, in a session that sends Python few rows at a time: one after the other the stages leave little room beside an executor's heap."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject; it is trained on the labelled rows of the whole table."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


@in_small_batches
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


@in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies; documents without words link with nothing and stay."""
    return near_dedup.drop_near_copies(docs)


@in_small_batches
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left and their places in sequences."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("minhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("best-two-fit packing", pack_sequences),
]

#: Toxicity, simhash windows and packing can't be written in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
