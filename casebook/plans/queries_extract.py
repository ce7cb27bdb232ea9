"""Catalogue: dashboard questions answered from the stored cuboid, and filters written as member-set expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook.operators import cuboid as E, olap as O
from casebook.operators.members import Level, Listed, Members, Product, Range, keep
from casebook.plans import answers as A
from casebook.plans.answers import top
from casebook.plans.queries_olap import COUNT, measures
from casebook.plans.registry import ORACLES, query
from casebook.plans.star import flat
from casebook.session import fresh_path

col = F.col

LEVELS = ["region", "country", "year", "attack_type", "target_type", "weapon_type"]


def extract(spark, sf_dir) -> tuple[E.Cuboid, object]:
    """The cuboid of the flat star, loaded in two batches, the second of them twice as a replay."""
    made = E.Cuboid(
        fresh_path(spark, "cuboid"), LEVELS, ["nkill", "nwound", "latitude", "longitude"], ["unknown_location_flag"]
    )
    df = flat(spark, sf_dir)
    made.add(df.where("eventid % 3 = 0"), 0)
    for _ in range(2):
        made.add(df.where("eventid % 3 <> 0"), 1)
    return made, made.read(spark)


@query("cuboid_top_countries", ORACLES["top_countries"])
def cuboid_top_countries(spark, sf_dir):
    _, cells = extract(spark, sf_dir)
    kept = O.keep_top_counted(cells, "country", 10, "incidents")
    return kept.groupBy("country").agg(E.incidents().alias("incident_count"))


@query("cuboid_region_year_trend", ORACLES["region_year_trend"])
def cuboid_region_year_trend(spark, sf_dir):
    _, cells = extract(spark, sf_dir)
    kept = cells.where(O.year_or_null(col("year"), 1996, 2000))
    for dim, n in {"attack_type": 3, "region": 4}.items():
        best = cells.groupBy(dim).agg(E.incidents().alias("_n")).orderBy(F.desc("_n"), dim).limit(n).select(dim)
        kept = kept.join(F.broadcast(best), dim, "left_semi")
    found = kept.groupBy("region", "year").agg(E.incidents().alias("incident_count"), E.least("unknown_location_flag").alias("_u"))
    return found.where("_u = 0").drop("_u")


@query("cuboid_geo_distribution", ORACLES["geo_distribution"])
def cuboid_geo_distribution(spark, sf_dir):
    _, cells = extract(spark, sf_dir)
    found = O.keep_top_counted(cells, "country", 20, "incidents").groupBy("country").agg(
        F.round(E.mean("latitude"), 4).alias("avg_latitude"), F.round(E.mean("longitude"), 4).alias("avg_longitude"),
        E.incidents().alias("incident_count"), (E.total("nkill") + E.total("nwound")).alias("total_casualties"),
        E.least("unknown_location_flag").alias("_u"),
    )
    return found.where("_u = 0").drop("_u")


@query("cuboid_attack_target_flow", ORACLES["attack_target_flow"])
def cuboid_attack_target_flow(spark, sf_dir):
    made, cells = extract(spark, sf_dir)
    # Both top sets are taken on all cells, so the smaller cuboid of the three levels is enough.
    small = made.merged(cells, ["attack_type", "target_type", "region"])
    kept = small
    for dim in ("attack_type", "target_type"):
        best = small.groupBy(dim).agg(E.incidents().alias("_n")).orderBy(F.desc("_n"), dim).limit(3).select(dim)
        kept = kept.join(F.broadcast(best), dim, "left_semi")
    return kept.select("attack_type", "target_type", "region", col("incidents").alias("incident_count"))


@query("cuboid_region_attack_cube", ORACLES["region_attack_cube"])
def cuboid_region_attack_cube(spark, sf_dir):
    _, cells = extract(spark, sf_dir)
    return O.cube(cells, ["region", "attack_type"], {"incident_count": E.incidents()})


@query(
    "sketched_event_rollup",
    A.over(
        "flat",
        """SELECT region, year, count(DISTINCT eventid) AS distinct_events, true AS sketch_within_bound,
        CAST(2 - grouping(region) - grouping(year) AS INTEGER) AS level_depth FROM flat GROUP BY ROLLUP (region, year)""",
    ),
)
def sketched_event_rollup(spark, sf_dir):
    """Exact distinct events of a drill-down beside the merged sketches, which stay within four standard errors."""
    _, cells = extract(spark, sf_dir)
    levels = ["region", "year"]
    exact = O.drill_down(flat(spark, sf_dir), levels, {"distinct_events": O.distinct_incidents()})
    about = O.drill_down(cells, levels, {"about": E.about_distinct()})
    keys = [*levels, "level_depth"]
    named = about.select(*[col(k).alias(f"_{k}") for k in keys], "about")
    same = F.lit(True)
    for k in keys:
        same = same & exact[k].eqNullSafe(named[f"_{k}"])
    within = F.abs(col("about") - col("distinct_events")) <= 4 * E.ERROR * col("distinct_events")
    return exact.join(named, same).select(*keys, "distinct_events", within.alias("sketch_within_bound"))


# Filters as expressions: the top of a level without listed members, nested tops, products without listed pairs.


def filtered_counts(spark, sf_dir, by: list[str], *sets: Members):
    return O.summarize(keep(flat(spark, sf_dir), *sets), by, measures("incident_count"))


@query("members_top_without_listed", ORACLES["top_attack_excluding"])
def members_top_without_listed(spark, sf_dir):
    chosen = (Level("attack_type") - (Listed.one("attack_type", "unknown") | Listed.one("attack_type", "5-low"))).top(3)
    return filtered_counts(spark, sf_dir, ["attack_type"], chosen)


@query(
    "members_two_tops_and_range",
    A.over(
        "flat",
        f"""SELECT region, attack_type, {COUNT} FROM flat WHERE {top('attack_type', 3)} AND {top('region', 4)}
        AND (year BETWEEN 1996 AND 2000 OR year IS NULL) GROUP BY ALL""",
    ),
)
def members_two_tops_and_range(spark, sf_dir):
    sets = (Level("attack_type").top(3), Level("region").top(4), Range("year", 1996, 2000, with_null=True))
    return filtered_counts(spark, sf_dir, ["region", "attack_type"], *sets)


@query(
    "members_product_without_pairs",
    A.over(
        "flat",
        f"""SELECT region, target_type, {COUNT} FROM flat WHERE region IS NOT NULL AND target_type IS NOT NULL
        AND NOT (region IN ('asia', 'europe') AND target_type = 'building')
        AND NOT (region = 'africa' AND target_type IN ('machinery', 'furniture')) GROUP BY ALL""",
    ),
)
def members_product_without_pairs(spark, sf_dir):
    listed = Product(Listed.one("region", "asia") | Listed.one("region", "europe"), Listed.one("target_type", "building"))
    more = Product(Listed.one("region", "africa"), Listed.one("target_type", "machinery", "furniture"))
    chosen = (Level("region") & Level("target_type")) - (listed | more)
    return filtered_counts(spark, sf_dir, ["region", "target_type"], chosen)


@query(
    "members_top_of_pairs",
    A.over(
        "flat",
        f"""SELECT region, target_type, {COUNT} FROM flat WHERE region <> 'asia' GROUP BY ALL
        ORDER BY count(eventid) DESC, region, target_type LIMIT 5""",
    ),
)
def members_top_of_pairs(spark, sf_dir):
    chosen = ((Level("region") - Listed.one("region", "asia")) & Level("target_type")).top(5)
    return filtered_counts(spark, sf_dir, ["region", "target_type"], chosen)
