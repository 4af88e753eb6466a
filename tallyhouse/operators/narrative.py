"""Texts from rows: a template by default, or a generator of the user's own on the executors."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyhouse.config import FAILED_CALL_PREFIX
from tallyhouse.operators.quality import text_check

Generator = Callable[[list[str]], list[str]]


def render(df: DataFrame, text: Column, out: str = "text") -> DataFrame:
    """Add a text built from the columns of the same row."""
    return df.withColumn(out, text)


def generate(df: DataFrame, prompt: str, generator: Generator, out: str = "text", retries: int = 3, wait: float = 2.0) -> DataFrame:
    """Answer prompts batch by batch where the rows are.

    A batch that keeps failing gets a text with the failure prefix, so that the check marks its
    rows for review and the job goes on.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])

    def answer(prompts: list[str]) -> list[str]:
        for attempt in range(retries):
            try:
                return generator(prompts)
            except Exception as error:  # noqa: BLE001 - any failure of the user's generator counts
                failure = f"{FAILED_CALL_PREFIX}: {error}"
                if attempt + 1 < retries:
                    time.sleep(wait * (attempt + 1))
        return [failure] * len(prompts)

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(**{out: answer(frame[prompt].tolist())})

    return df.mapInPandas(batches, schema)


def checked(df: DataFrame, text: str = "text", **rules) -> DataFrame:
    """Replace a text by its cleaned form and add ``llm_check`` and ``llm_check_detail``."""
    found = text_check(F.col(text), **rules)
    return df.withColumns({text: found["text"], "llm_check": found["llm_check"], "llm_check_detail": found["llm_check_detail"]})


def generate_with_retry(df: DataFrame, prompt: str, first: Generator, second: Generator, store: str, text: str = "text", **rules) -> DataFrame:
    """Generate, check, and ask once more for the texts that need review.

    The first round is written to ``store`` and read back: otherwise both branches below would
    run the generator again. What still needs review keeps its mark.
    """
    checked(generate(df, prompt, first, text), text, **rules).write.mode("overwrite").parquet(store)
    done = df.sparkSession.read.parquet(store)
    again = done.where("llm_check = 'REVIEW'").drop(text, "llm_check", "llm_check_detail")
    return done.where("llm_check = 'PASS'").unionByName(checked(generate(again, prompt, second, text), text, **rules))


def insight_rows(bundles: list[DataFrame], summary: Callable[[str], Column]) -> DataFrame:
    """One row per topic: type, summary, key figures as JSON and the check of the summary."""
    out = bundles[0]
    for b in bundles[1:]:
        out = out.unionByName(b)
    return checked(out.withColumn("ai_summary", summary("kpi_json")), "ai_summary", min_words=10)


def latest_batch(df: DataFrame, stamp: str = "generated_at") -> DataFrame:
    return df.where(F.col(stamp) == df.agg(F.max(stamp)).scalar())
