"""Labelling text in batches with a predictor the caller brings."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from casebook.functions import fixed_values as V, text

Predictor = Callable[[Sequence[str]], Sequence[str]]


def prepare(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, summary): rows with text, on one line."""
    return df.where(F.col(column).isNotNull()).select(key, text.one_line(F.col(column)).alias("summary"))


def keyword_predictor(patterns: Sequence[tuple[str, str]] = tuple(V.MOTIVE_PATTERNS)) -> Predictor:
    """The default predictor: the first motive pattern found in the prompt's description."""

    def predict(prompts: Sequence[str]) -> list[str]:
        import re

        compiled = [(name, re.compile(pattern)) for name, pattern in patterns]
        out = []
        for item in prompts:
            described = item.split('Description: "', 1)[-1].rsplit('"\nMotive:', 1)[0].lower()
            out.append(next((name for name, pattern in compiled if pattern.search(described)), "unknown"))
        return out

    return predict


def label_batch(
    df: DataFrame, key: str, predict: Predictor, batch: int = 50, tries: int = 3, fallback: str = "unknown"
) -> DataFrame:
    """(key, predicted_motive) for a prepared frame; a batch that fails ``tries`` times gets the fallback.

    Runs partition by partition on Arrow batches; the predictor travels with the task.
    """
    prompts = df.select(key, text.prompt(F.col("summary")).alias("prompt"))
    schema = T.StructType([prompts.schema[key], T.StructField("predicted_motive", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            labels: list[str] = []
            for start in range(0, len(frame), batch):
                part = list(frame["prompt"].iloc[start : start + batch])
                for _ in range(tries):
                    try:
                        found = list(predict(part))
                    except Exception:
                        continue
                    if len(found) == len(part):  # an answer of another length is a failed try
                        labels += found
                        break
                else:
                    labels += [fallback] * len(part)
            yield pd.DataFrame({key: frame[key], "predicted_motive": labels})

    return prompts.mapInPandas(run, schema)


def write_back(df: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Attach labels by key; rows without one keep NULL."""
    return df.join(labels, key, "left")


def motive_counts(
    df: DataFrame, column: str, patterns: Sequence[tuple[str, str]] = tuple(V.MOTIVE_PATTERNS)
) -> DataFrame:
    """Normalised labels with counts, fewest first."""
    usable = df.where(text.usable_label(F.col(column)))
    return (
        usable.groupBy(text.first_pattern(F.col(column), patterns).alias("motive"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("row_count", "motive")
    )
