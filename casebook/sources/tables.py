"""The given Parquet tables and the incident view derived from them.

The incident view has one row per order. Its NULLs, sentinels and zero dates are
set by rule on the order and customer keys, so cleaning has something to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casebook.session import merged_if_large

PICKED_COUNTRY = "nation_3"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pruned(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read only the named columns."""
    return table(spark, sf_dir, name).select(*columns)


def _line_facts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("l_orderkey").agg(
        # One-letter codes as numbers: a minimum of text would sort all lines.
        F.chr(F.min(F.ascii("l_returnflag"))).alias("weaptype1_txt"),
        F.chr(F.min(F.ascii("l_linestatus"))).alias("weapsubtype1_txt"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("nkill"),
        F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))).alias("nwound"),
        F.count_if(F.col("l_discount") > 0.05).cast("double").alias("nkillter"),
        F.count_if(F.col("l_tax") > 0.05).cast("double").alias("nwoundte"),
    )


def incidents_from(
    orders: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    region: DataFrame,
    lines: DataFrame,
    documents: DataFrame | None = None,
) -> DataFrame:
    """Raw incidents; with ``documents`` each one whose key equals a document's carries its text."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    joined = (
        orders.join(merged_if_large(customer), c == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(merged_if_large(_line_facts(lines), lines), o == F.col("l_orderkey"), "left")
    )
    summary = []
    if documents is not None:
        joined = joined.join(documents, o == F.col("doc_id"), "left")
        summary = [F.col("text").alias("summary")]
    part_kill = F.when(o % 4 < 3, 0.0).otherwise(F.col("nkill"))
    part_wound = F.when(o % 4 < 3, 0.0).otherwise(F.col("nwound"))

    def coord(cycle: int, shift: int):
        placed = F.when(c % 19 == 0, 0.0).otherwise(((c % cycle) - shift).cast("double"))
        return F.when(c % 23 != 0, placed)

    return joined.select(
        o.alias("eventid"),
        F.year("o_orderdate").alias("iyear"),
        F.when(o % 97 == 0, 0).otherwise(F.month("o_orderdate")).alias("imonth"),
        F.when(o % 89 == 0, 0).otherwise(F.dayofmonth("o_orderdate")).alias("iday"),
        (o % 2).cast("int").alias("extended"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("success"),
        (c % 2).cast("int").alias("vicinity"),
        F.when(o % 3 == 0, 1).otherwise(0).alias("guncertain1"),
        F.when(c % 29 != 0, (c % 5 + 1).cast("int")).alias("specificity"),
        F.col("r_name").alias("region_txt"),
        F.col("n_name").alias("country_txt"),
        F.when(c % 17 != 0, F.col("c_mktsegment")).alias("provstate"),
        F.when(c % 13 == 0, "unknown")
        .otherwise(F.concat(F.lit("city_"), (c % 300).cast("string")))
        .alias("city"),
        coord(181, 90).alias("latitude"),
        coord(361, 180).alias("longitude"),
        F.col("o_orderpriority").alias("attacktype1_txt"),
        "weaptype1_txt",
        "weapsubtype1_txt",
        F.col("c_mktsegment").alias("targtype1_txt"),
        F.col("o_orderstatus").alias("targsubtype1_txt"),
        F.col("n_name").alias("natlty1_txt"),
        F.when(c % 7 == 0, "unknown")
        .otherwise(F.concat(F.lit("group_"), (c % 200).cast("string")))
        .alias("gname"),
        "nkill",
        "nwound",
        "nkillter",
        "nwoundte",
        part_kill.alias("nkillus"),
        part_wound.alias("nwoundus"),
        F.when(o % 4 == 1, 0).when(o % 4 == 2, -9).otherwise(1).alias("property"),
        F.when(o % 5 == 0, "Minor")
        .when(o % 5 == 1, "Major")
        .when(o % 5 == 2, "Catastrophic")
        .otherwise("Unknown")
        .alias("propextent_txt"),
        F.when(o % 7 == 0, None)
        .when(o % 11 == 0, -99.0)
        .otherwise(F.col("o_totalprice"))
        .alias("propvalue"),
        *summary,
    )


def raw_incidents(spark: SparkSession, sf_dir: str, with_summary: bool = False) -> DataFrame:
    read = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "nation", "region", "lineitem")}
    documents = table(spark, sf_dir, "documents").select("doc_id", "text") if with_summary else None
    return incidents_from(
        read["orders"], read["customer"], read["nation"], read["region"], read["lineitem"], documents
    )


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place list derived from the customers: (ordinal, name, latitude, longitude, country, admin1)."""
    c = F.col("c_custkey")
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            c.alias("ordinal"),
            F.concat(F.lit("citi_"), (c % 211).cast("string")).alias("name"),
            ((c % 120) - 60).cast("double").alias("latitude"),
            ((c % 340) - 170).cast("double").alias("longitude"),
            F.lower("n_name").alias("country"),
            F.concat(F.lower("c_mktsegment"), F.lit(" district")).alias("admin1"),
        )
    )


def country_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centroids of the fixture countries whose key is not a multiple of 5: (country, lat, lon)."""
    k = F.col("n_nationkey")
    return (
        table(spark, sf_dir, "nation")
        .where(k % 5 != 0)
        .select(
            F.lower("n_name").alias("country"),
            (k * 6.5 - 70).alias("centroid_lat"),
            (k * 13.25 - 165).alias("centroid_lon"),
        )
    )


def region_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("r_regionkey")
    return (
        table(spark, sf_dir, "region")
        .where(k > 0)
        .select(
            F.lower("r_name").alias("region"),
            (k * 11.5 - 30).alias("region_lat"),
            (k * 31.25 - 80).alias("region_lon"),
        )
    )
