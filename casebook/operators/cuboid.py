"""A stored aggregate of the flat star that answers additive questions and grows by batches.

The cuboid holds one row per combination of its levels: incidents, sums, counts of
values, minima of flags, and a sketch of the events. All of these can be merged, so
a batch adds its own cells, a replayed batch replaces them, and a question over fewer
levels is an aggregation of cells instead of a scan of events. Distinct events come
exactly from the incident counts where the fact has one row per event, and within
the sketch's error where it does not.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casebook.session import Folder

#: log2 of the sketch's registers: the standard error is about 1.04 / sqrt(2**12), 1.6 %.
SKETCH = 12
ERROR = 1.04 / 2 ** (SKETCH / 2)


@dataclass(frozen=True)
class Cuboid:
    """Where the cells lie and what they hold."""

    path: str
    levels: Sequence[str]
    measures: Sequence[str]
    flags: Sequence[str] = ()
    event: str = "eventid"

    def cells(self, rows: DataFrame) -> DataFrame:
        """The cells of some rows of the flat star."""
        parts = [F.count(self.event).alias("incidents"), F.hll_sketch_agg(self.event, SKETCH).alias("events")]
        for m in self.measures:
            parts += [F.sum(m).alias(f"sum_{m}"), F.count(m).alias(f"count_{m}")]
        parts += [F.min(f).alias(f"min_{f}") for f in self.flags]
        return rows.groupBy(*self.levels).agg(*parts)

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Store a batch's cells. The same batch again replaces them."""
        self.cells(rows).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The cells of all batches; one combination may stand in several."""
        if not Folder(spark, self.path).names():
            raise FileNotFoundError(self.path)
        return spark.read.parquet(self.path).drop("batch")

    def merged(self, cells: DataFrame, levels: Sequence[str]) -> DataFrame:
        """Cells over fewer levels."""
        parts = [F.sum("incidents").alias("incidents"), F.hll_union_agg("events").alias("events")]
        for m in self.measures:
            parts += [F.sum(f"sum_{m}").alias(f"sum_{m}"), F.sum(f"count_{m}").alias(f"count_{m}")]
        parts += [F.min(f"min_{f}").alias(f"min_{f}") for f in self.flags]
        return cells.groupBy(*levels).agg(*parts)


def incidents() -> Column:
    return F.sum("incidents")


def total(measure: str) -> Column:
    return F.sum(f"sum_{measure}")


def values(measure: str) -> Column:
    return F.sum(f"count_{measure}")


def mean(measure: str) -> Column:
    return total(measure) / F.when(values(measure) != 0, values(measure))


def least(flag: str) -> Column:
    return F.min(f"min_{flag}")


def about_distinct() -> Column:
    """Distinct events, within the sketch's error."""
    return F.hll_sketch_estimate(F.hll_union_agg("events"))

