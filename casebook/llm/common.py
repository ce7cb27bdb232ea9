"""Small pieces that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casebook.session import materialize

BLANKS = r"[\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def split_words(text: Column, separators: str = BLANKS) -> Column:
    """The words between separators; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def small(df: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """Mark a stored frame for broadcast if its counted rows stay within the bound; a larger one is joined by shuffle."""
    return F.broadcast(df) if df.count() <= most_rows else df


def row_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a task holds few long texts at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def carried(documents: DataFrame, *more: Column) -> DataFrame:
    """Whole input rows as the struct ``row`` beside their key doc_id, mark: no input name can clash with a working one."""
    quoted = ["`" + c.replace("`", "``") + "`" for c in documents.columns]
    return documents.select(
        F.struct(*[documents[c] for c in quoted]).alias("row"), documents["doc_id"].alias("doc_id"),
        F.xxhash64(documents["text"]).alias("mark"), *more,
    )


def same_key(id_name: str, mark_name: str) -> Column:
    """The key doc_id, mark equals the two named columns, null ids too."""
    return F.col("doc_id").eqNullSafe(F.col(id_name)) & (F.col("mark") == F.col(mark_name))


def signature_of(df: DataFrame, columns: Sequence[str]) -> tuple[int, int]:
    """Row count and order-free checksum of a stored frame."""
    row = df.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64(*columns)), F.lit(0))).first()
    return row[0], row[1]


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """Connected components of the edges (a, b): one row (node, component) per node with an edge.

    The component is the smallest node in it. Alternates large and small stars, so
    the number of rounds grows with the logarithm of the longest path; each round
    is two aggregations with partial sums and two joins whose hot keys can be split,
    and is written to the shared folder, which cuts the lineage.
    """
    a, b = F.col("a"), F.col("b")
    stars = materialize(
        edges.where(a != b).select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(),
        "edges",
    )
    before = signature_of(stars, ["high", "low"])
    for _ in range(most_rounds if before[0] else 0):
        both = stars.select(F.col("high").alias("a"), F.col("low").alias("b")).union(
            stars.select(F.col("low").alias("a"), F.col("high").alias("b"))
        )
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("high"), F.col("m").alias("low"))
        large = large.distinct()
        lowest = large.groupBy("high").agg(F.min("low").alias("m"))
        met = large.join(lowest, "high")
        small_star = met.select(F.explode(F.array(
            F.struct(F.col("low").alias("high"), F.col("m").alias("low")),
            F.struct(F.col("high").alias("high"), F.col("m").alias("low")),
        )).alias("e")).select("e.high", "e.low").where(F.col("high") != F.col("low"))
        stars = materialize(small_star.distinct(), "stars")
        after = signature_of(stars, ["high", "low"])
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError("components did not settle")
    return stars.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        stars.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )
