"""Readers and writers for files: CSV, quarantine folders, exports, published tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from casebook.session import setting, shuffle_files_go


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """A CSV with a header row; without a schema the column types are inferred."""
    reader = spark.read.option("header", True).option("encoding", encoding).option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The raw event file: ISO-8859-1, quoted text that may hold line breaks."""
    reader = (
        spark.read.option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("multiLine", True)
        .option("escape", '"')
    )
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_or_fallback(spark: SparkSession, path: str, fallback: DataFrame) -> DataFrame:
    """An optional Parquet side input; a missing path yields the built-in table."""
    try:
        return spark.read.parquet(path).select(*fallback.columns)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return fallback


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A database query; user and password come from the caller's options, never from code."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def read_collection(
    spark: SparkSession, folder: str, schemas: Mapping[str, T.StructType], views: bool = False
) -> dict[str, DataFrame]:
    """One typed CSV per table name; optionally registered as temporary views."""
    frames = {name: read_csv(spark, f"{folder}/{name}.csv", schema) for name, schema in schemas.items()}
    if views:
        for name, frame in frames.items():
            frame.createOrReplaceTempView(name)
    return frames


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", quote_all: bool = False) -> None:
    df.write.mode(mode).option("header", True).option("quoteAll", quote_all).option("escape", '"').csv(path)


def export_tables(frames: Mapping[str, DataFrame], folder: str) -> None:
    """Each table as ``<name>.csv`` with a header row and every value quoted."""
    for name, df in frames.items():
        write_csv(df, f"{folder}/{name}.csv", quote_all=True)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def quarantine(rejected: Mapping[str, DataFrame]) -> DataFrame:
    """One frame of rejected rows, each with the reason; columns a rule lacks are NULL."""
    frames = [df.withColumn("reason", F.lit(reason)) for reason, df in rejected.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def quarantine_by_rule(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that fail rules, once per rule, with the reason: one pass over the input."""
    failed = F.array_compact(F.array(*[F.when(broken, F.lit(reason)) for reason, broken in rules.items()]))
    return df.withColumn("reason", F.explode(failed))


def write_quarantine(rejected: Mapping[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    quarantine(rejected).write.mode(mode).partitionBy("reason").parquet(path)


ACCEPTED, SET_ASIDE = "accepted", "set_aside"


def tag_outcomes(df: DataFrame, drops: Mapping[str, Column], suspects: Mapping[str, Column]) -> DataFrame:
    """Add ``outcome`` and ``reason``: a row stands once as accepted unless a ``drops`` rule holds, and once per rule that holds.

    Rows under a ``suspects`` rule are set aside for review and loaded all the same. A rule that yields NULL does not hold.
    """
    holds = {reason: F.coalesce(rule, F.lit(False)) for reason, rule in {**drops, **suspects}.items()}
    dropped = F.lit(False)
    for reason in drops:
        dropped = dropped | holds[reason]

    def tag(outcome: str, reason: str) -> Column:
        return F.struct(F.lit(outcome).alias("outcome"), F.lit(reason).alias("reason"))

    tags = [F.when(~dropped, tag(ACCEPTED, "none")), *[F.when(rule, tag(SET_ASIDE, reason)) for reason, rule in holds.items()]]
    return df.select("*", F.inline(F.array_compact(F.array(*tags))))


#: A task has at most so many files open, each with a row group of so many bytes in memory; small pages are packed early.
OPEN_FILES, ROW_GROUP, PAGE_ROWS = 32, 4 << 20, 5_000


def write_outcomes(
    df: DataFrame, path: str, run: int, drops: Mapping[str, Column], suspects: Mapping[str, Column]
) -> None:
    """Accepted and rejected rows in one pass over ``df``, a folder per run, outcome and reason.

    Every run adds its own partition, and a run that is repeated replaces it. A task keeps one file open per reason, so rows,
    which stand once per reason, are neither shuffled nor sorted; a reason that most rows have is written by all tasks. Of more
    reasons than ``OPEN_FILES`` Spark sorts a task's further rows.
    """
    spark, tagged = df.sparkSession, tag_outcomes(df, drops, suspects)
    most = min(1 + len({**drops, **suspects}), OPEN_FILES)
    packing = {"compression": "zstd", "parquet.block.size": ROW_GROUP, "parquet.page.row.count.limit": PAGE_ROWS}
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(most)), shuffle_files_go(spark):
        tagged.write.mode("overwrite").options(**packing).partitionBy("outcome", "reason").parquet(f"{path}/run={run}")


def read_outcomes(spark: SparkSession, path: str, outcome: str | None = None) -> DataFrame:
    """All runs with the columns run, outcome and reason; one outcome alone reads only its folders."""
    found = spark.read.parquet(path)
    return found if outcome is None else found.where(F.col("outcome") == outcome)


def with_header_row(df: DataFrame) -> DataFrame:
    """The column names as a first row above all values as text."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    header = df.sparkSession.range(1).select(*[F.lit(c).alias(c) for c in df.columns])
    return header.unionAll(texts)


def create_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """An empty Parquet table of the declared schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").format("parquet").saveAsTable(name)

