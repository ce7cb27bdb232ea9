"""Incremental load: raw files stream through cleaning into a star that grows with them.

Each micro-batch is cleaned, adds the dimension members that no batch before it
had, looks up its ids and appends the events whose keys are not loaded yet.

*Layout.* Every table of the target is partitioned by ``batch``, the fact also by
``bucket``, a hash of the key. A batch compares its keys only with the files of its own
buckets, and inside those only row groups whose key range it meets are read: rows
are stored in key order.

*Replays.* A batch writes nothing but its own partitions and reads nothing but the
others', so a batch that failed half-way and comes again gives the same ids and
the same rows. Members are stored before the facts that name them.

*Stream and batch agree.* All rules look at one row, apart from the capped sample of
imputed values; a load in parts brings the sample's last row (``CleaningRules.sample_cut``).
Ids follow arrival, so they differ from a batch load's; what they stand for does not.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from casebook.operators import warehouse as W
from casebook.operators.ordering import first_per_key
from casebook.plans.cleaning import CleaningRules, clean
from casebook.session import Folder, Passing, Scratch


def read_parts(spark: SparkSession, path: str, schema: T.StructType, *partitions: str) -> DataFrame | None:
    """A table of the target with its partition columns; None before the first batch."""
    if not Folder(spark, path).names():
        return None
    numbers = [T.StructField(p, T.LongType() if p == "batch" else T.IntegerType()) for p in partitions]
    return spark.read.schema(T.StructType([*schema.fields, *numbers])).parquet(path)


# Rows appended once per key


@dataclass(frozen=True)
class Target:
    """A table that takes every key once. More buckets mean fewer files to compare with, and smaller ones."""

    path: str
    key: Sequence[str]
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame | None:
        return read_parts(spark, self.path, schema, "batch", "bucket")

    def loaded_keys(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> DataFrame | None:
        """Keys other batches have loaded, from the files that may hold a key of ``rows``: its buckets, its key range.

        At most ``buckets`` numbers and two keys reach the driver.
        """
        known = self.read(spark, rows.schema)
        if known is None:
            return None
        first = self.key[0]
        met = rows.agg(F.collect_set(self.bucket()).alias("buckets"), F.min(first).alias("low"), F.max(first).alias("high")).first()
        if not met["buckets"]:
            return None
        near = (F.col("batch") != batch_id) & F.col("bucket").isin(sorted(met["buckets"]))
        return known.where(near & F.col(first).between(met["low"], met["high"])).select(*self.key, "bucket")

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Write the rows with new keys to the batch's own partition; ``rows`` are stored and have one row per key."""
        spark = rows.sparkSession
        known = self.loaded_keys(spark, rows, batch_id)
        fresh = rows.withColumn("bucket", self.bucket())
        if known is not None:
            fresh = fresh.join(known.hint("merge"), ["bucket", *self.key], "left_anti")
        ordered = fresh.repartition("bucket").sortWithinPartitions("bucket", *self.key)
        ordered.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/batch={batch_id}")


# Dimensions that grow


@dataclass(frozen=True)
class Star:
    """Where the tables of a growing star lie."""

    path: str
    buckets: int = 64

    @property
    def fact(self) -> Target:
        return Target(f"{self.path}/fact", ["eventid"], self.buckets)

    def members(self, spark: SparkSession, dim: W.Dimension, schema: T.StructType) -> DataFrame | None:
        return read_parts(spark, f"{self.path}/{dim.table}", schema, "batch")


def members_of(cleaned: DataFrame, dim: W.Dimension) -> DataFrame:
    """The distinct members that the cleaned rows bring, by the dimension's own column names."""
    source = W.reconcile(cleaned, dim.source)
    return source.select(*[F.col(c).alias(k) for k, c in dim.keys.items()]).distinct()


def member_schema(cleaned: DataFrame, dim: W.Dimension) -> T.StructType:
    types = members_of(cleaned, dim).schema
    return T.StructType([T.StructField(dim.id_column, T.LongType()), *types.fields])


def grow(star: Star, cleaned: DataFrame, dim: W.Dimension, batch_id: int) -> None:
    """Store the batch's new members of a dimension, numbered after those of the batches before it.

    The first batch, whatever its number, also stores the default member as id 1.
    """
    spark = cleaned.sparkSession
    known = star.members(spark, dim, member_schema(cleaned, dim))
    known = known.where(F.col("batch") < batch_id).drop("batch") if known is not None else None
    if known is None or (batch_id == 0 or known.isEmpty()):
        new = W.build_dimension(W.reconcile(cleaned, dim.source), dim)
    else:
        new = W.late_members(members_of(cleaned, dim), known, dim.id_column, dim.natural_key)
    new.write.mode("overwrite").parquet(f"{star.path}/{dim.table}/batch={batch_id}")


def dimensions_upto(star: Star, cleaned: DataFrame, batch_id: int) -> dict[str, DataFrame]:
    """Every dimension as the batch sees it."""
    spark = cleaned.sparkSession
    found = {}
    for name, dim in W.DIMENSIONS.items():
        members = star.members(spark, dim, member_schema(cleaned, dim))
        found[name] = members.where(F.col("batch") <= batch_id).drop("batch")
    return found


def load_batch(raw: DataFrame, batch_id: int, star: Star, rules: CleaningRules) -> None:
    """One batch, from raw rows to facts. Running it again with the same rows changes nothing."""
    with Passing(raw.sparkSession), Scratch(raw.sparkSession) as keep:
        cleaned, _ = clean(raw, rules)
        cleaned = keep(cleaned.withColumnRenamed("event_id", "eventid"), "cleaned")
        # The dimensions do not depend on each other, so their jobs share the cluster.
        with ThreadPoolExecutor(len(W.DIMENSIONS)) as pool:
            list(pool.map(lambda dim: grow(star, cleaned, dim, batch_id), W.DIMENSIONS.values()))
        fact = keep(W.load_fact(cleaned, dimensions_upto(star, cleaned, batch_id)), "fact")
        star.fact.append(fact, batch_id)


def loaded(spark: SparkSession, star: Star, raw: DataFrame, rules: CleaningRules) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(fact, dimensions) of everything loaded so far; ``raw`` only gives the columns and types of the input."""
    cleaned = clean(raw.limit(0), rules)[0].withColumnRenamed("event_id", "eventid")
    dimensions = {
        name: star.members(spark, dim, member_schema(cleaned, dim)).drop("batch") for name, dim in W.DIMENSIONS.items()
    }
    fact = star.fact.read(spark, W.load_fact(cleaned, dimensions).schema).drop("batch", "bucket")
    return fact, dimensions


# Streams


def run_stream(source: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run every available file through ``step``, then stop."""
    query = (
        source.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str, files_per_batch: int = 1) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def load_stream(
    spark: SparkSession, raw_path: str, star: Star, checkpoint: str, rules: CleaningRules, files_per_batch: int = 1
) -> None:
    """Stream the raw files of a folder into the star; a later call goes on with the files that came since."""
    schema = spark.read.parquet(raw_path).schema
    source = file_stream(spark, raw_path, schema, "*.parquet", files_per_batch)
    run_stream(source, lambda batch, batch_id: load_batch(batch, batch_id, star, rules), checkpoint)


def append_new(batch: DataFrame, batch_id: int, target: Target, order_by: Sequence[str]) -> None:
    """Append the first row per key of a batch whose key is not loaded yet."""
    with Scratch(batch.sparkSession) as keep:
        rows = first_per_key(batch, list(target.key), [F.col(c) for c in order_by])
        target.append(keep(rows, "rows"), batch_id)


def append_stream(source: DataFrame, transform: Callable[[DataFrame], DataFrame], target: Target, checkpoint: str, order_by: Sequence[str]) -> None:
    """Stream rows through ``transform`` and append those with new keys: a plain table, without dimensions."""
    run_stream(source, lambda batch, batch_id: append_new(transform(batch), batch_id, target, order_by), checkpoint)

