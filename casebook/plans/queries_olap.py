"""Catalogue: dashboard questions over the flat star."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook.functions import dates, text
from casebook.operators import olap as O
from casebook.plans import answers as A
from casebook.plans.answers import top
from casebook.plans.registry import query
from casebook.plans.star import flat
from casebook.schemas import HIERARCHIES
from casebook.session import materialize

col = F.col


def measures(*names: str):
    made = {
        "incident_count": lambda: O.incidents(),
        "total_casualties": lambda: O.casualties(),
        "distinct_incidents": lambda: O.distinct_incidents(),
        "killed": lambda: F.sum("nkill"),
        "wounded": lambda: F.sum("nwound"),
        "fatal_rows": lambda: F.count("nkill"),
        "avg_latitude": lambda: F.round(F.avg("latitude"), 4),
        "avg_longitude": lambda: F.round(F.avg("longitude"), 4),
        "event_id_sum": lambda: F.sum(F.col("eventid").cast("decimal(38,0)")),
    }
    return {n: made[n]() for n in names}


COUNT = "count(eventid) AS incident_count"
SUMS = "sum(nkill) + sum(nwound) AS total_casualties"
MIDDLE = "round(avg(latitude), 4) AS avg_latitude, round(avg(longitude), 4) AS avg_longitude"


@query(
    "top_countries",
    A.over("flat", f"SELECT country, {COUNT} FROM flat WHERE {top('country', 10)} GROUP BY country"),
)
def top_countries(spark, sf_dir):
    df = flat(spark, sf_dir)
    return O.summarize(O.keep_top(df, df, "country", 10), ["country"], measures("incident_count"))


@query(
    "pct_total_countries",
    A.over(
        "flat",
        f"""SELECT country, incident_count, round(incident_count / sum(incident_count) OVER (), 6) AS pct_total
        FROM (SELECT country, {COUNT} FROM flat WHERE {top('country', 10)} GROUP BY country)""",
    ),
)
def pct_total_countries(spark, sf_dir):
    df = flat(spark, sf_dir)
    counted = O.summarize(O.keep_top(df, df, "country", 10), ["country"], measures("incident_count"))
    return O.with_share(counted, "incident_count", "pct_total").orderBy(F.desc("incident_count"), "country")


@query(
    "top_attack_excluding",
    A.over(
        "flat",
        f"""SELECT attack_type, {COUNT} FROM flat WHERE {top('attack_type', 3, "'unknown', '5-low'")} GROUP BY attack_type""",
    ),
)
def top_attack_excluding(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.keep_top(df, df, "attack_type", 3, exclude=["unknown", "5-low"])
    return O.summarize(kept, ["attack_type"], measures("incident_count"))


@query(
    "region_attack_intensity",
    A.over(
        "flat",
        f"""SELECT region, attack_type, {COUNT}, {SUMS} FROM flat
        WHERE {top('attack_type', 3, "'unknown'")} AND {top('region', 3)} GROUP BY ALL""",
    ),
)
def region_attack_intensity(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.keep_top(O.keep_top(df, df, "attack_type", 3, exclude=["unknown"]), df, "region", 3)
    return O.summarize(kept, ["region", "attack_type"], measures("incident_count", "total_casualties"))


@query(
    "top_cities_known",
    A.over(
        "flat",
        f"""SELECT city, {COUNT} FROM flat WHERE {top('city', 10)} AND year BETWEEN 1996 AND 2000 GROUP BY city
        HAVING min(unknown_location_flag) = 0""",
    ),
)
def top_cities_known(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.keep_top(df, df, "city", 10).where(col("year").between(1996, 2000))
    return O.summarize(kept, ["city"], measures("incident_count"), known=["unknown_location_flag"]).orderBy(
        F.desc("incident_count"), "city"
    )


@query(
    "region_year_trend",
    A.over(
        "flat",
        f"""SELECT region, year, {COUNT} FROM flat WHERE {top('attack_type', 3)} AND {top('region', 4)}
        AND (year BETWEEN 1996 AND 2000 OR year IS NULL) GROUP BY ALL HAVING min(unknown_location_flag) = 0""",
    ),
)
def region_year_trend(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.keep_top(O.keep_top(df, df, "attack_type", 3), df, "region", 4)
    kept = kept.where(O.year_or_null(col("year"), 1996, 2000))
    return O.summarize(kept, ["region", "year"], measures("incident_count"), known=["unknown_location_flag"])


@query("kpi_header", A.over("flat", """SELECT count(DISTINCT eventid) AS total_attacks,
 count(DISTINCT CASE WHEN success = 1 THEN eventid END) AS successful_attacks,
 count(DISTINCT CASE WHEN success = 0 THEN eventid END) AS unsuccessful_attacks,
 CAST(sum(nkill) AS BIGINT) AS total_killed FROM flat"""))
def kpi_header(spark, sf_dir):
    row = O.kpis(flat(spark, sf_dir))
    return row.where(col("successful_attacks").isNotNull() & col("total_killed").isNotNull())


_NO_PAIRS = "NOT (region = 'asia' AND target_type = 'machinery') AND NOT (region = 'europe' AND target_type = 'building')"


@query(
    "exclude_pairs",
    A.over("flat", f"SELECT region, target_type, {COUNT} FROM flat WHERE {_NO_PAIRS} GROUP BY ALL"),
)
def exclude_pairs(spark, sf_dir):
    df = flat(spark, sf_dir)
    pairs = spark.createDataFrame(
        [("asia", "machinery"), ("europe", "building")], "region string, target_type string"
    )
    kept = O.drop_pair_set(df, pairs, ["region", "target_type"])
    return O.summarize(kept, ["region", "target_type"], measures("incident_count"))


@query(
    "target_distribution",
    A.over(
        "flat",
        f"""SELECT target_type, region, {COUNT} FROM flat WHERE {_NO_PAIRS} AND {top('region', 3)}
        AND region IN ('asia', 'europe', 'africa', 'america') AND {top('target_type', 3)}
        GROUP BY ALL HAVING min(unknown_location_flag) = 0""",
    ),
)
def target_distribution(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.drop_pairs(df, ["region", "target_type"], [("asia", "machinery"), ("europe", "building")])
    kept = kept.where(col("region").isin("asia", "europe", "africa", "america"))
    kept = O.keep_top(O.keep_top(kept, df, "region", 3), df, "target_type", 3)
    return O.summarize(kept, ["target_type", "region"], measures("incident_count"), known=["unknown_location_flag"])


@query(
    "dual_trend",
    A.over(
        "flat",
        f"""SELECT year, region, {COUNT}, count(nkill) AS fatal_rows FROM flat
        WHERE NOT (region = 'asia' AND year IN (1995, 1996)) AND {top('country', 5)} AND year BETWEEN 1995 AND 2000
        GROUP BY ALL HAVING min(unknown_location_flag) = 0""",
    ),
)
def dual_trend(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.drop_pairs(df, ["region", "year"], [("asia", 1995), ("asia", 1996)])
    kept = O.keep_top(kept.where(col("year").between(1995, 2000)), df, "country", 5)
    return O.summarize(
        kept, ["year", "region"], measures("incident_count", "fatal_rows"), known=["unknown_location_flag"]
    )


@query(
    "dual_trend_sum",
    A.over(
        "flat",
        f"SELECT year, {COUNT}, sum(nkill) AS killed FROM flat WHERE {top('country', 5)} AND year BETWEEN 1996 AND 2000 GROUP BY year",
    ),
)
def dual_trend_sum(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.keep_top(df.where(col("year").between(1996, 2000)), df, "country", 5)
    return O.summarize(kept, ["year"], measures("incident_count", "killed"))


GROUP_PICK = ["group_1", "group_2", "group_3", "group_5", "group_8"]
_PICKED = "group_name IN ('group_1', 'group_2', 'group_3', 'group_5', 'group_8')"


@query(
    "geo_distribution",
    A.over(
        "flat",
        f"""SELECT country, {MIDDLE}, {COUNT}, {SUMS} FROM flat WHERE {top('country', 20)} GROUP BY country
        HAVING min(unknown_location_flag) = 0""",
    ),
)
def geo_distribution(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.picked(O.keep_top(df, df, "country", 20), {"group_name": None})
    return O.summarize(
        kept,
        ["country"],
        measures("avg_latitude", "avg_longitude", "incident_count", "total_casualties"),
        known=["unknown_location_flag"],
    )


@query(
    "geo_distribution_city",
    A.over(
        "flat",
        f"""SELECT country, city, {MIDDLE}, {COUNT}, {SUMS} FROM flat WHERE {_PICKED} GROUP BY ALL
        HAVING min(unknown_location_flag) = 0""",
    ),
)
def geo_distribution_city(spark, sf_dir):
    kept = O.picked(flat(spark, sf_dir), {"group_name": GROUP_PICK})
    return O.summarize(
        kept,
        ["country", "city"],
        measures("avg_latitude", "avg_longitude", "incident_count", "total_casualties"),
        known=["unknown_location_flag"],
    )


@query(
    "heatmap_pct_casualties",
    A.over(
        "flat",
        f"""SELECT *, round(total_casualties / sum(total_casualties) OVER (), 6) AS pct_casualties
        FROM (SELECT region, attack_type, {COUNT}, {SUMS} FROM flat
          WHERE NOT (region = 'africa' AND attack_type = '2-high') AND {top('attack_type', 3)}
          AND year BETWEEN 1996 AND 2000 GROUP BY ALL HAVING min(unknown_location_flag) = 0)""",
    ),
)
def heatmap_pct_casualties(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.drop_pairs(df, ["region", "attack_type"], [("africa", "2-high")])
    kept = O.keep_top(kept.where(col("year").between(1996, 2000)), df, "attack_type", 3)
    grid = O.summarize(
        kept,
        ["region", "attack_type"],
        measures("incident_count", "total_casualties"),
        known=["unknown_location_flag"],
    )
    return O.with_share(grid, "total_casualties", "pct_casualties")


@query(
    "incidents_vs_casualties",
    A.over(
        "flat",
        f"""SELECT year, {SUMS}, {COUNT} FROM flat WHERE {top('region', 4)}
        AND (year BETWEEN 1996 AND 2000 OR year IS NULL) GROUP BY year""",
    ),
)
def incidents_vs_casualties(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.keep_top(df.where(O.year_or_null(col("year"), 1996, 2000)), df, "region", 4)
    return O.summarize(kept, ["year"], measures("total_casualties", "incident_count"))


@query(
    "group_impact_region",
    A.over(
        "flat",
        f"""SELECT group_name, region, {SUMS}, {COUNT} FROM flat
        WHERE NOT (group_name = 'group_1' AND region = 'asia') AND {top('group_name', 10)} AND {top('region', 3)}
        GROUP BY ALL HAVING min(unknown_location_flag) = 0 AND min(unknown_group_flag) = 0""",
    ),
)
def group_impact_region(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.drop_pairs(df, ["group_name", "region"], [("group_1", "asia")])
    kept = O.keep_top(O.keep_top(kept, df, "group_name", 10), df, "region", 3)
    out = O.summarize(
        kept,
        ["group_name", "region"],
        measures("total_casualties", "incident_count"),
        known=["unknown_location_flag", "unknown_group_flag"],
    )
    return out.orderBy("total_casualties", "group_name", "region")


@query(
    "top_groups_impact",
    A.over(
        "flat",
        f"""SELECT group_name, {SUMS}, {COUNT} FROM flat WHERE {top('group_name', 10)} GROUP BY group_name
        HAVING min(unknown_group_flag) = 0""",
    ),
)
def top_groups_impact(spark, sf_dir):
    df = flat(spark, sf_dir)
    out = O.summarize(
        O.keep_top(df, df, "group_name", 10),
        ["group_name"],
        measures("total_casualties", "incident_count"),
        known=["unknown_group_flag"],
    )
    return out.orderBy(F.desc("total_casualties"), "group_name")


SET_COUNTRIES = ["nation_1", "nation_4", "nation_7", "nation_9"]


@query(
    "set_in_out",
    A.over(
        "flat",
        f"""SELECT country, in_set, CASE WHEN in_set = 1 THEN '+' ELSE '-' END || country AS country_label,
        CASE WHEN in_set = 1 THEN city ELSE '' END AS city_label, {COUNT}
        FROM (SELECT *, CASE WHEN country IN ('nation_1', 'nation_4', 'nation_7', 'nation_9') THEN 1 ELSE 0 END AS in_set
          FROM flat WHERE {top('city', 20)} AND {top('country', 10)})
        GROUP BY ALL HAVING min(unknown_location_flag) = 0""",
    ),
)
def set_in_out(spark, sf_dir):
    df = flat(spark, sf_dir)
    members = spark.createDataFrame([(c,) for c in SET_COUNTRIES], "country string")
    kept = O.keep_top(O.keep_top(df, df, "city", 20), df, "country", 10)
    inside = col("in_set") == 1
    labelled = O.membership(kept, members, "country", "in_set").withColumns(
        {
            "country_label": F.concat(F.when(inside, "+").otherwise("-"), col("country")),
            "city_label": F.when(inside, col("city")).otherwise(""),
        }
    )
    return O.summarize(
        labelled,
        ["country", "in_set", "country_label", "city_label"],
        measures("incident_count"),
        known=["unknown_location_flag"],
    )


@query(
    "kills_by_year",
    A.over(
        "flat",
        f"""SELECT CAST(extract(year FROM d) AS INTEGER) AS date_year, {COUNT}, count(DISTINCT eventid) AS distinct_incidents,
        sum(nkill) AS killed FROM (SELECT *, make_date(year, month, day) AS d FROM flat)
        WHERE {top('attack_type', 3)} AND {top('region', 4)} AND (year BETWEEN 1996 AND 2000 OR year IS NULL) GROUP BY 1""",
    ),
)
def kills_by_year(spark, sf_dir):
    df = flat(spark, sf_dir)
    date_year = F.year(dates.date_of(col("year"), col("month"), col("day")))
    kept = O.keep_top(O.keep_top(df, df, "attack_type", 3), df, "region", 4)
    kept = kept.withColumn("date_year", date_year).where(O.year_or_null(col("date_year"), 1996, 2000))
    return O.summarize(kept, ["date_year"], measures("incident_count", "distinct_incidents", "killed"))


@query(
    "attacks_by_group",
    A.over(
        "flat",
        f"""SELECT group_name, {COUNT}, count(DISTINCT eventid) AS distinct_incidents FROM flat
        WHERE country IN ('nation_1', 'nation_2', 'nation_3') AND {top('group_name', 10)} GROUP BY group_name
        HAVING min(unknown_group_flag) = 0""",
    ),
)
def attacks_by_group(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.picked(df, {"country": ["nation_1", "nation_2", "nation_3"]})
    return O.summarize(
        O.keep_top(kept, df, "group_name", 10),
        ["group_name"],
        measures("incident_count", "distinct_incidents"),
        known=["unknown_group_flag"],
    )


@query(
    "weapon_share",
    A.over(
        "flat",
        f"""SELECT *, round(distinct_incidents / sum(distinct_incidents) OVER (), 6) AS pct_total FROM (
        SELECT weapon_type, count(DISTINCT eventid) AS distinct_incidents FROM flat
        WHERE weapon_type IN ('a', 'n', 'r') AND {top('country', 20)} GROUP BY weapon_type)""",
    ),
)
def weapon_share(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.picked(df, {"weapon_type": ["a", "n", "r"], "country": [], "group_name": None})
    counted = O.summarize(O.keep_top(kept, df, "country", 20), ["weapon_type"], measures("distinct_incidents"))
    return O.with_share(counted, "distinct_incidents", "pct_total")


@query(
    "wounded_vs_killed",
    A.over(
        "flat",
        "SELECT year, sum(nwound) AS wounded, sum(nkill) AS killed FROM flat WHERE year BETWEEN 1996 AND 2000 GROUP BY year",
    ),
)
def wounded_vs_killed(spark, sf_dir):
    kept = flat(spark, sf_dir).where(col("year").between(1996, 2000))
    return O.summarize(kept, ["year"], measures("wounded", "killed"))


@query(
    "trend_year_range",
    A.over(
        "flat",
        f"""SELECT CAST(extract(year FROM make_date(year, month, day)) AS INTEGER) AS date_year, {COUNT} FROM flat
        WHERE year BETWEEN 1996 AND 1999 GROUP BY 1""",
    ),
)
def trend_year_range(spark, sf_dir):
    date_year = F.year(dates.date_of(col("year"), col("month"), col("day")))
    kept = flat(spark, sf_dir).where(col("year").between(1996, 1999)).withColumn("date_year", date_year)
    return O.summarize(kept, ["date_year"], measures("incident_count"))


_KPI_ORDER = ["total_killed", "successful_attacks", "unsuccessful_attacks", "total_attacks"]
_KPI_NAMES = {
    "total_killed": "CAST(sum(nkill) AS BIGINT)",
    "successful_attacks": "count(DISTINCT CASE WHEN success = 1 THEN eventid END)",
    "unsuccessful_attacks": "count(DISTINCT CASE WHEN success = 0 THEN eventid END)",
    "total_attacks": "count(DISTINCT eventid)",
}


@query(
    "kpi_unpivot",
    A.over(
        "flat",
        "\nUNION ALL ".join(
            f"SELECT '{n}' AS measure_name, {e} AS measure_value, {_KPI_ORDER.index(n) + 1} AS position FROM picked"
            for n, e in _KPI_NAMES.items()
        ),
        f"picked AS (SELECT * FROM flat WHERE {top('country', 20)} AND country IN ('nation_2', 'nation_4'))",
    ),
)
def kpi_unpivot(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.picked(O.keep_top(df, df, "country", 20), {"country": ["nation_2", "nation_4"], "group_name": []})
    return O.kpi_unpivot(kept, _KPI_ORDER).orderBy("position")


@query(
    "attack_target_flow",
    A.over(
        "flat",
        f"""SELECT attack_type, target_type, region, {COUNT} FROM flat
        WHERE {top('attack_type', 3)} AND {top('target_type', 3)} GROUP BY ALL""",
    ),
)
def attack_target_flow(spark, sf_dir):
    df = flat(spark, sf_dir)
    kept = O.keep_top(O.keep_top(df, df, "attack_type", 3), df, "target_type", 3)
    return O.summarize(kept, ["attack_type", "target_type", "region"], measures("incident_count"))


@query(
    "single_country_map",
    A.over(
        "flat",
        f"""SELECT country, {MIDDLE}, {COUNT}, CAST(sum(eventid) AS DECIMAL(38, 0)) AS event_id_sum FROM flat
        WHERE country = 'nation_7' GROUP BY country""",
    ),
)
def single_country_map(spark, sf_dir):
    kept = flat(spark, sf_dir).where(col("country").isin("nation_7"))
    return O.summarize(
        kept, ["country"], measures("avg_latitude", "avg_longitude", "incident_count", "event_id_sum")
    )


@query(
    "action_filter",
    A.over(
        "flat",
        f"""SELECT weapon_type, {COUNT} FROM flat WHERE country IN ('nation_5', 'nation_6') AND {_PICKED} GROUP BY weapon_type""",
    ),
)
def action_filter(spark, sf_dir):
    selection = {"country": ["nation_5", "nation_6"], "group_name": GROUP_PICK, "region": []}
    return O.summarize(O.picked(flat(spark, sf_dir), selection), ["weapon_type"], measures("incident_count"))


_LABELS = {"middle east": "Middle East & North Africa", "asia": "Asia (all)"}


@query(
    "alias_labels",
    A.over(
        "flat",
        f"""SELECT CASE region WHEN 'middle east' THEN 'Middle East & North Africa' WHEN 'asia' THEN 'Asia (all)'
        ELSE region END AS region_label, {COUNT} FROM flat GROUP BY 1""",
    ),
)
def alias_labels(spark, sf_dir):
    counted = O.summarize(flat(spark, sf_dir), ["region"], measures("incident_count"))
    return counted.select(text.relabel(col("region"), _LABELS).alias("region_label"), "incident_count")


@query(
    "most_used_member",
    A.over(
        "flat",
        f"""SELECT * FROM (SELECT weapon_type, {COUNT} FROM flat GROUP BY weapon_type)
        QUALIFY incident_count = max(incident_count) OVER ()""",
    ),
)
def most_used_member(spark, sf_dir):
    return O.most_used(flat(spark, sf_dir), "weapon_type")


@query(
    "metric_value",
    A.over(
        "flat",
        """SELECT 'Successful Attacks' AS metric, CAST(count(DISTINCT CASE WHEN success = 1 THEN eventid END) AS VARCHAR)
        AS metric_value FROM flat
        UNION ALL SELECT 'Most Used Weapon', CASE WHEN min(weapon_type) = max(weapon_type) THEN min(weapon_type) ELSE '*' END
        FROM (SELECT weapon_type, count(*) AS n FROM flat GROUP BY 1 QUALIFY n = max(n) OVER ())""",
    ),
)
def metric_value(spark, sf_dir):
    df = flat(spark, sf_dir)
    number, name = (
        O.metric_value(df, m).select(F.lit(m).alias("metric"), "metric_value")
        for m in ("Successful Attacks", O.TEXT_METRIC)
    )
    return number.unionAll(name)


@query(
    "dynamic_time",
    A.over(
        "flat",
        f"""SELECT grain, period, {COUNT} FROM (
          SELECT 'Year' AS grain, date_trunc('year', make_date(year, month, day))::TIMESTAMP AS period, eventid FROM flat
          UNION ALL SELECT 'Month', date_trunc('month', make_date(year, month, day))::TIMESTAMP, eventid FROM flat
          UNION ALL SELECT 'Date', make_date(year, month, day)::TIMESTAMP, eventid FROM flat) GROUP BY ALL""",
    ),
)
def dynamic_time(spark, sf_dir):
    """All three grains from one count per day."""
    date = dates.date_of(col("year"), col("month"), col("day"))
    daily = flat(spark, sf_dir).groupBy(date.alias("date")).agg(O.incidents().alias("n"))
    out = None
    for grain in dates.GRAINS:
        part = daily.groupBy(dates.truncated(col("date"), grain).alias("period")).agg(
            F.sum("n").alias("incident_count")
        ).select(F.lit(grain).alias("grain"), "period", "incident_count")
        out = part if out is None else out.unionAll(part)
    return out


def _add_drill(name: str) -> None:
    levels = HIERARCHIES[name]
    depth = f"{len(levels)} - ({' + '.join(f'grouping({c})' for c in levels)})"

    @query(
        f"drill_{name}_rollup",
        A.over(
            "flat",
            f"""SELECT {", ".join(levels)}, {COUNT}, sum(nkill) AS killed, CAST({depth} AS INTEGER) AS level_depth
            FROM flat GROUP BY ROLLUP ({", ".join(levels)})""",
        ),
    )
    def build(spark, sf_dir):
        return O.drill_down(flat(spark, sf_dir), levels, measures("incident_count", "killed"))


for _name in HIERARCHIES:
    _add_drill(_name)


@query(
    "region_attack_cube",
    A.over(
        "flat",
        f"""SELECT region, attack_type, {COUNT}, CAST(grouping(region) AS INTEGER) AS region_total,
        CAST(grouping(attack_type) AS INTEGER) AS attack_type_total FROM flat GROUP BY CUBE (region, attack_type)""",
    ),
)
def region_attack_cube(spark, sf_dir):
    return O.cube(flat(spark, sf_dir), ["region", "attack_type"], measures("incident_count"))


@query(
    "index_angle",
    A.over(
        "flat",
        """SELECT attack_type, round(row_number() OVER (ORDER BY attack_type) * 360 / (n + 1), 4) AS angle
        FROM (SELECT attack_type FROM flat GROUP BY 1), (SELECT count(DISTINCT attack_type) AS n FROM flat)""",
    ),
)
def index_angle(spark, sf_dir):
    """The members stand around a circle in name order."""
    return O.polar_angles(flat(spark, sf_dir), "attack_type")


@query(
    "member_set_algebra",
    A.over(
        "flat",
        """SELECT region, attack_type FROM (SELECT DISTINCT region FROM flat WHERE region <> 'asia'),
        (SELECT DISTINCT attack_type FROM flat WHERE attack_type IN ('1-urgent', '2-high'))
        EXCEPT SELECT 'africa', '2-high'
        UNION SELECT 'asia', 'unknown'""",
    ),
)
def member_set_algebra(spark, sf_dir):
    """Members × members minus and plus listed pairs; the product is one array per region."""
    df = flat(spark, sf_dir)
    regions = df.select("region").distinct().subtract(spark.createDataFrame([("asia",)], "region string"))
    wanted = F.array(F.lit("1-urgent"), F.lit("2-high"))
    present = df.where(F.array_contains(wanted, col("attack_type"))).agg(F.collect_set("attack_type")).scalar()
    product = regions.select("region", F.explode(present).alias("attack_type"))
    minus = spark.createDataFrame([("africa", "2-high")], product.schema)
    plus = spark.createDataFrame([("asia", "unknown")], product.schema)
    return product.exceptAll(minus).union(plus).distinct()


@query(
    "cascading_filters",
    A.over(
        "flat",
        """SELECT city, count(eventid) AS incident_count FROM flat WHERE region IN (SELECT region FROM r)
        AND country IN (SELECT country FROM c) AND city IN (SELECT city FROM flat WHERE region IN (SELECT region FROM r)
          AND country IN (SELECT country FROM c) GROUP BY city ORDER BY count(eventid) DESC, city LIMIT 10) GROUP BY city""",
        "r AS (SELECT region FROM flat GROUP BY region ORDER BY count(eventid) DESC, region LIMIT 2)",
        """c AS (SELECT country FROM flat WHERE region IN (SELECT region FROM r) GROUP BY country
        ORDER BY count(eventid) DESC, country LIMIT 5)""",
    ),
)
def cascading_filters(spark, sf_dir):
    """Each level's top set is taken within the level above."""
    dims = {"region": 2, "country": 5, "city": 10}
    counts = materialize(O.summarize(flat(spark, sf_dir), list(dims), measures("incident_count")), "counts")
    for dim, n in dims.items():
        counts = O.keep_top_counted(counts, dim, n, "incident_count")
    return counts.groupBy("city").agg(F.sum("incident_count").alias("incident_count"))
