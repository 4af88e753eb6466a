"""A corpus pipeline of five stages: toxicity, exact copies, near copies, benchmark passages, packing.

Each stage gets what its predecessor kept and is written as Parquet below ``spark.checkpoint.dir`` before the next
one reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import decontaminate, exact_dedup, jaccard, toxicity
from tallyhouse.llm.queries import pack, table
from tallyhouse.session import work_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold of a classifier that is fitted on all labelled documents of the stage's input."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train(toxicity.labelled(docs, labels), draw=lambda share: toxicity.labelled(docs, labels, share))
    return toxicity.clean(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of equal texts."""
    return exact_dedup.first_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by 80 % of common five-word shingles."""
    return jaccard.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no passage of a benchmark item, judged by their own text: a null or repeated ``doc_id`` makes no difference."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with the ``doc_id`` they come from."""
    return pack(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("jaccard_join", drop_near_copies), ("decontamination", drop_contaminated), ("packing", pack_sequences)]
#: The classifier, the embedding and the tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``.

    Columns of any name pass through the stages as they are. Null and empty texts and rows with a null key stay unless they are copies
    or hold a benchmark passage; of rows repeated with one key and text one stays; a row with a key that near copies drop goes, whatever its
    own text. Empty tables give no rows.
    """
    docs, folder = table(spark, sf_dir, "documents"), work_dir(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
