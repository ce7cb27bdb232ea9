"""Filling absent coordinates step by step, with the step that found them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casebook.functions import values
from casebook.operators import fuzzy
from casebook.operators.cleaning import city_centroids
from casebook.operators.ordering import dense_ids
from casebook.session import materialize

PLACE = ["country", "provstate", "city"]


def known_cities(df: DataFrame, internal: DataFrame) -> DataFrame:
    """(ordinal, name, latitude, longitude): the internal list, then cities of the data by name."""
    means = materialize(city_centroids(df).withColumnRenamed("city", "name"), "means")
    learned = means.join(internal.select("name"), "name", "left_anti")
    first = internal.agg(F.coalesce(F.max("ordinal"), F.lit(0))).scalar()
    numbered = dense_ids(learned, "ordinal", ["name"])
    return internal.select("ordinal", "name", "latitude", "longitude").unionByName(
        numbered.join(means, "name").select(
            (F.col("ordinal") + first).alias("ordinal"),
            "name",
            F.col("city_lat").alias("latitude"),
            F.col("city_lon").alias("longitude"),
        )
    )


def impute_coords_cascade(
    df: DataFrame,
    gazetteer: DataFrame,
    internal: DataFrame,
    country_centroids: DataFrame,
    region_centroids: DataFrame,
    k: int = 6,
    digits: int = 4,
) -> DataFrame:
    """Valid coordinates stay; others come from the gazetteer, a known city, the country, the region.

    Only distinct places of rows that need it are matched. ``coord_source``
    names the step; country and region set the low-confidence flag, no hit sets
    the missing flag.
    """
    valid = values.true_only((F.col("latitude") != 0) & (F.col("longitude") != 0))
    places = materialize(df.where(~valid).select(*PLACE).distinct(), "places")
    by_place = fuzzy.match_gazetteer(places, gazetteer, k).select(
        *PLACE, F.struct("match_lat", "match_lon").alias("_gazetteer")
    )
    left = places.join(by_place.select(*PLACE), PLACE, "left_anti")
    by_city = fuzzy.match_city(left, known_cities(df, internal), k).select(
        "city", F.struct("match_lat", "match_lon").alias("_city")
    )
    by_country = country_centroids.toDF("country", "_lat", "_lon").select(
        "country", F.struct(F.col("_lat").alias("match_lat"), F.col("_lon").alias("match_lon")).alias("_country")
    )
    by_region = region_centroids.toDF("region", "_lat", "_lon").select(
        "region", F.struct(F.col("_lat").alias("match_lat"), F.col("_lon").alias("match_lon")).alias("_region")
    )
    joined = (
        df.join(by_place, PLACE, "left")
        .join(by_city, "city", "left")
        .join(by_country, "country", "left")
        .join(by_region, "region", "left")
    )
    steps = {"gazetteer": "_gazetteer", "city": "_city", "country": "_country", "region": "_region"}
    source = F.lit("missing")
    for name, column in reversed(list(steps.items())):
        source = F.when(F.col(column).isNotNull(), name).otherwise(source)
    source = F.when(valid, "valid").otherwise(source)
    point = F.coalesce(*steps.values())
    placed = {
        c: F.round(F.when(valid, F.col(c)).otherwise(point[part]), digits)
        for c, part in (("latitude", "match_lat"), ("longitude", "match_lon"))
    }
    return joined.withColumns(
        {
            **placed,
            "coord_source": source,
            "low_confidence_coords_flag": source.isin("country", "region").cast("int"),
            "missing_coords_flag": (source == "missing").cast("int"),
        }
    ).drop(*steps.values())
