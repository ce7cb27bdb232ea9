"""Publishing the star: cleaned table, dimensions, fact and the flat extract, written once per run."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from casebook.operators import quality as Q, warehouse as W
from casebook.plans.cleaning import CleaningRules, clean
from casebook.session import Passing, fresh_path, materialize
from casebook.sources import tables
from casebook.sources.versions import VersionedTable

# Lists of the incident view that stands in for the event file.
ATTACK_TYPES = ["1-urgent", "2-high", "3-medium", "5-low", "unknown"]
EXTENT_VALUES = {"minor": 10_000.0, "major": 10_000_000.0, "catastrophic": 1_500_000_000.0}


def view_rules(spark: SparkSession, sf_dir: str) -> CleaningRules:
    return CleaningRules(
        country=tables.PICKED_COUNTRY,
        attack_types=ATTACK_TYPES,
        extent_values=EXTENT_VALUES,
        centroids=tables.country_centroids(spark, sf_dir),
        sample_cap=300,
    )


@dataclass(frozen=True)
class Star:
    cleaned: DataFrame
    dimensions: dict[str, DataFrame]
    fact: DataFrame
    flat: DataFrame
    #: Per table the rows written and the violations of each declared rule, counted by the write itself.
    checks: dict[str, dict[str, int]]


def build(cleaned: DataFrame) -> Star:
    """Dimensions first, then the fact, then the flat extract partitioned by year."""
    spark = cleaned.sparkSession
    rules = Q.warehouse_rules()
    checks: dict[str, dict[str, int]] = {}

    def checked(df: DataFrame, name: str) -> DataFrame:
        watched, seen = Q.watch(df, rules[name])
        stored = materialize(watched, name)
        checks[name] = seen.get
        return stored

    def publish(name: str) -> DataFrame:
        dim = W.DIMENSIONS[name]
        return checked(W.build_dimension(W.reconcile(cleaned, dim.source), dim), name)

    # The dimensions do not depend on each other, so their jobs share the cluster.
    with ThreadPoolExecutor(len(W.DIMENSIONS)) as pool:
        dimensions = dict(zip(W.DIMENSIONS, pool.map(publish, W.DIMENSIONS)))
    fact = checked(W.load_fact(cleaned, dimensions), "fact_incidents")
    flat = W.star_flat(fact, dimensions)
    published = VersionedTable(spark, fresh_path(spark, "flat"))
    published.replace(flat, ("year",))
    return Star(cleaned, dimensions, fact, published.read(), checks)


_cleaned: dict[tuple[str, str], DataFrame] = {}
_stars: dict[tuple[str, str], Star] = {}


def cleaned_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned incident view, written once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _cleaned:
        with Passing(spark) as block:
            cleaned, _ = clean(tables.raw_incidents(spark, sf_dir), view_rules(spark, sf_dir))
            _cleaned[key] = block.keep(cleaned.withColumnRenamed("event_id", "eventid"), "cleaned")
    return _cleaned[key]


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The published star of the incident view."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stars:
        _stars[key] = build(cleaned_view(spark, sf_dir))
    return _stars[key]


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir).flat


