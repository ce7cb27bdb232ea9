"""Catalogue: normalised tables, dimensions, fact load, lookups, constraints."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from casebook.operators import quality as Q, warehouse as W
from casebook.plans import answers as A
from casebook.plans.registry import query
from casebook.plans.cleaning import clean, sample_cut
from casebook.plans.star import cleaned_view, star, view_rules
from casebook.session import fresh_path
from casebook.sources import tables
from casebook.sources.files import with_header_row
from casebook.streaming import incremental

col = F.col

RECONCILED = {
    "incidents": "SELECT eventid, year, month, day, extended, success FROM cleaned WHERE year BETWEEN 1970 AND 2017"
    " AND month BETWEEN 1 AND 12 AND day BETWEEN 1 AND 31 AND extended IN (0, 1) AND success IN (0, 1)",
    "locations": "SELECT eventid, region, country, provstate, city, latitude, longitude, specificity, vicinity,"
    " unknown_location FROM cleaned WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"
    " AND (specificity BETWEEN 1 AND 5 OR specificity IS NULL) AND (vicinity IN (0, 1) OR vicinity IS NULL)"
    " AND unknown_location IN (0, 1)",
    "attacks": "SELECT eventid, attacktype1, weaptype1, weapsubtype1 FROM cleaned WHERE attacktype1 IS NOT NULL"
    " AND weaptype1 IS NOT NULL AND weapsubtype1 IS NOT NULL",
    "targets": "SELECT eventid, targtype1, targsubtype1, nationality1 FROM cleaned WHERE targtype1 IS NOT NULL"
    " AND targsubtype1 IS NOT NULL AND nationality1 IS NOT NULL",
    "casualties": "SELECT eventid, nkill, nwound, nkillter, nwoundter, nkillus, nwoundus FROM cleaned",
    "terroristgroups": "SELECT eventid, group_name, uncertainty1, unknown_group FROM cleaned"
    " WHERE group_name IS NOT NULL AND uncertainty1 IS NOT NULL",
    "properties": "SELECT eventid, CAST(CAST(propvalue AS DECIMAL(15, 2)) AS DOUBLE) AS propvalue, extent, property, propvalue_category"
    " FROM cleaned WHERE propvalue IS NOT NULL",
}
SHORT = {"terroristgroups": "groups"}


def _add_reconciled(name: str) -> None:
    @query(f"reconcile_{SHORT.get(name, name)}", A.over("cleaned", RECONCILED[name]))
    def build(spark, sf_dir):
        part = W.reconcile(cleaned_view(spark, sf_dir), name)
        money = [c for c, kind in part.dtypes if kind.startswith("decimal")]
        return part.withColumns({c: col(c).cast("double") for c in money})


for _name in RECONCILED:
    _add_reconciled(_name)


DIM_QUERIES = {
    "dim_time": "dim_time", "dim_location": "dim_location", "dim_attacktype": "dim_attacktype",
    "dim_targettype": "dim_targettype", "dim_group": "dim_terroristgroup", "dim_property": "dim_propertydamage",
}


def _add_dimension(name: str, table: str) -> None:
    @query(name, A.over("dims", f"SELECT * FROM {table}"))
    def build(spark, sf_dir):
        dim = W.DIMENSIONS[table]
        return W.build_dimension(W.reconcile(cleaned_view(spark, sf_dir), dim.source), dim)


for _name, _table in DIM_QUERIES.items():
    _add_dimension(_name, _table)


@query("fact_load_star", A.over("fact", "SELECT * FROM fact"))
def fact_load_star(spark, sf_dir):
    return W.load_fact(cleaned_view(spark, sf_dir), star(spark, sf_dir).dimensions)


@query("star_flat", A.over("flat", "SELECT * FROM flat"))
def star_flat(spark, sf_dir):
    published = star(spark, sf_dir)
    return W.star_flat(published.fact, published.dimensions)


@query(
    "lookup_min_id",
    A.over(
        "dims",
        """SELECT eventid, location_id FROM cleaned LEFT JOIN (SELECT region, country, provstate, city,
        min(location_id) AS location_id FROM dim_location GROUP BY ALL) USING (region, country, provstate, city)""",
    ),
)
def lookup_min_id(spark, sf_dir):
    events = cleaned_view(spark, sf_dir).select("eventid", *W.NAMED_PLACE)
    found = W.lookup_min_id(events, star(spark, sf_dir).dimensions["dim_location"], "location_id", W.NAMED_PLACE)
    return found.select("eventid", "location_id")


# Events whose coordinates, city or country were edited after the dimension was loaded.
_EDITED = """
edited AS (SELECT eventid, region, CASE WHEN eventid % 11 = 0 THEN 'new country' ELSE country END AS country, provstate,
  CASE WHEN eventid % 13 = 0 THEN 'new ' || city ELSE city END AS city,
  CASE WHEN eventid % 5 = 0 THEN latitude + 0.25 ELSE latitude END AS latitude, longitude,
  specificity, vicinity, unknown_location AS unknown_location_flag FROM cleaned)"""
_KEY = "concat(region, '|', country, '|', provstate, '|', city, '|', printf('%.3f', latitude), '|', printf('%.3f', longitude))"


def edited_events(spark, sf_dir):
    e = col("eventid")
    return cleaned_view(spark, sf_dir).select(
        "eventid",
        "region",
        F.when(e % 11 == 0, "new country").otherwise(col("country")).alias("country"),
        "provstate",
        F.when(e % 13 == 0, F.concat(F.lit("new "), col("city"))).otherwise(col("city")).alias("city"),
        F.when(e % 5 == 0, col("latitude") + 0.25).otherwise(col("latitude")).alias("latitude"),
        "longitude",
        "specificity",
        "vicinity",
        col("unknown_location").alias("unknown_location_flag"),
    )


_STEPS = f"""
keyed AS (SELECT *, {_KEY} AS location_key FROM edited),
dim_keyed AS (SELECT *, {_KEY} AS location_key FROM dim_location),
by_full AS (SELECT region, country, provstate, city, latitude, longitude, min(location_id) AS full_id FROM dim_keyed GROUP BY ALL),
by_name AS (SELECT region, country, provstate, city, min(location_id) AS name_id FROM dim_keyed GROUP BY ALL),
by_key AS (SELECT location_key, min(location_id) AS key_id FROM dim_keyed GROUP BY ALL),
stepped AS (SELECT * FROM keyed LEFT JOIN by_full USING (region, country, provstate, city, latitude, longitude)
  LEFT JOIN by_name USING (region, country, provstate, city) LEFT JOIN by_key USING (location_key)),
late AS (SELECT *, row_number() OVER (ORDER BY region, country, provstate, city, latitude, longitude)
    + (SELECT max(location_id) FROM dim_location) AS new_id
  FROM (SELECT DISTINCT region, country, provstate, city, latitude, longitude FROM stepped
        WHERE coalesce(full_id, name_id, key_id) IS NULL))"""


@query(
    "resolve_location_fallback",
    A.over(
        "dims",
        """SELECT eventid, coalesce(full_id, name_id, key_id, new_id) AS location_id,
        CASE WHEN full_id IS NOT NULL THEN 'full' WHEN name_id IS NOT NULL THEN 'named'
             WHEN key_id IS NOT NULL THEN 'key' ELSE 'new' END AS resolved_by
        FROM stepped LEFT JOIN late USING (region, country, provstate, city, latitude, longitude)""",
        _EDITED,
        _STEPS.strip("\n"),
    ),
)
def resolve_location_fallback(spark, sf_dir):
    resolved, _ = W.resolve_location(edited_events(spark, sf_dir), star(spark, sf_dir).dimensions["dim_location"])
    return resolved.select("eventid", "location_id", "resolved_by")


@query(
    "dim_late_arriving",
    A.over(
        "dims",
        """SELECT row_number() OVER (ORDER BY region, country, provstate, city, latitude, longitude)
          + (SELECT max(location_id) FROM dim_location) AS location_id, region, country, provstate, city, latitude, longitude,
          first.specificity AS specificity, first.vicinity AS vicinity, first.unknown_location_flag AS unknown_location_flag
        FROM (SELECT DISTINCT region, country, provstate, city, latitude, longitude FROM edited
          EXCEPT SELECT region, country, provstate, city, latitude, longitude FROM dim_location)
        JOIN (SELECT region, country, provstate, city, latitude, longitude,
            min({'specificity': specificity, 'vicinity': vicinity, 'unknown_location_flag': unknown_location_flag}) AS first
          FROM edited GROUP BY ALL) USING (region, country, provstate, city, latitude, longitude)""",
        _EDITED,
    ),
)
def dim_late_arriving(spark, sf_dir):
    dim = star(spark, sf_dir).dimensions["dim_location"]
    return W.late_members(edited_events(spark, sf_dir), dim, "location_id", W.FULL_PLACE, W.PLACE_DETAILS)


@query(
    "dedupe_self_join",
    """SELECT * FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 <> 0 THEN p_name END AS p_name, p_brand, p_type FROM part) a
    WHERE NOT EXISTS (SELECT 1 FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 <> 0 THEN p_name END AS p_name, p_brand,
      p_type FROM part) b WHERE a.p_partkey > b.p_partkey AND a.p_name = b.p_name AND a.p_brand = b.p_brand
      AND a.p_type = b.p_type)""",
)
def dedupe_self_join(spark, sf_dir):
    part = tables.table(spark, sf_dir, "part").select(
        "p_partkey", F.when(col("p_partkey") % 10 != 0, col("p_name")).alias("p_name"), "p_brand", "p_type"
    )
    return W.dedupe_members(part, "p_partkey", ["p_name", "p_brand", "p_type"])


@query(
    "simulate_fact",
    A.over(
        "cleaned",
        """SELECT count(*) AS fact_rows, CAST(0 AS BIGINT) AS missing_ids, (SELECT count(*) FROM (SELECT DISTINCT region,
        country, provstate, city, latitude, longitude FROM cleaned)) AS members, CAST(1 AS BIGINT) AS min_id,
        (SELECT count(*) FROM (SELECT DISTINCT region, country, provstate, city, latitude, longitude FROM cleaned)) AS max_id
        FROM cleaned""",
    ),
)
def simulate_fact(spark, sf_dir):
    return W.simulate_fact(cleaned_view(spark, sf_dir), W.FULL_PLACE)


@query(
    "check_constraints",
    A.over(
        "fact",
        """SELECT 'nkill' AS rule, count(*) FILTER (NOT nkill >= 0) AS violations FROM fact
        UNION ALL SELECT 'success', count(*) FILTER (NOT success IN (0, 1)) FROM fact
        UNION ALL SELECT 'high_impact', count(*) FILTER (NOT high_impact IN (0, 1)) FROM fact
        UNION ALL SELECT 'total_casualties', count(*) FILTER (NOT total_casualties >= 0) FROM fact
        UNION ALL SELECT 'propvalue_present', count(*) FILTER (propvalue IS NULL) FROM fact
        UNION ALL SELECT 'propvalue_small', count(*) FILTER (NOT propvalue < 1000000) FROM fact""",
    ),
)
def check_constraints(spark, sf_dir):
    return Q.check_constraints(
        star(spark, sf_dir).fact,
        {
            "nkill": col("nkill") >= 0,
            "success": col("success").isin(0, 1),
            "high_impact": col("high_impact").isin(0, 1),
            "total_casualties": col("total_casualties") >= 0,
            "propvalue_present": Q.not_null("propvalue"),
            "propvalue_small": col("propvalue") < 1_000_000,
        },
    )


_CHILDREN = [name for name in RECONCILED if name != "incidents"]
# Incidents of one year are left out of the parents of the second group, so that there is something to find.
_FK = "\n".join(f", r_{name} AS ({sql})" for name, sql in RECONCILED.items())


def _lost(name: str, child: str, column: str, parent: str) -> str:
    return (
        f"SELECT '{name}' AS reference, count(*) AS violations FROM {child} WHERE {column} IS NOT NULL"
        f" AND {column} NOT IN (SELECT {column} FROM {parent})"
    )


@query(
    "fk_violations",
    A.over(
        "fact",
        " UNION ALL ".join(
            [_lost(f"fact_to_{t}", "fact", W.DIMENSIONS[t].id_column, t) for t in W.DIMENSIONS]
            + [_lost(f"{c}_to_incidents", f"r_{c}", "eventid", "r_incidents") for c in _CHILDREN]
            + [_lost(f"{c}_to_early_incidents", f"r_{c}", "eventid", "r_early") for c in _CHILDREN]
            + [
                _lost("fact_to_late_time", "fact", "time_id", "(SELECT time_id FROM dim_time WHERE year > 1997)"),
                "SELECT 'order_to_rich_customer', count(*) FROM orders WHERE o_custkey NOT IN"
                " (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
            ]
        ),
        _FK.lstrip(", ") + ", r_early AS (SELECT * FROM r_incidents WHERE year < 1998)",
    ),
)
def fk_violations(spark, sf_dir):
    """All declared references: six of the fact, six of the normalised tables; and eight to parents that are cut short."""
    published = star(spark, sf_dir)
    late = published.dimensions["dim_time"].where(col("year") > 1997)
    rich = tables.table(spark, sf_dir, "customer").where(col("c_acctbal") > 0)
    of_fact = {f"fact_to_{t}": (d.id_column, published.dimensions[t], d.id_column) for t, d in W.DIMENSIONS.items()}
    out = Q.fk_violations(published.fact, {**of_fact, "fact_to_late_time": ("time_id", late, "time_id")})
    incidents = W.reconcile(published.cleaned, "incidents").select("eventid", "year")
    parents = {"incidents": incidents, "early_incidents": incidents.where("year < 1998")}
    for child in _CHILDREN:
        references = {f"{child}_to_{name}": ("eventid", parent, "eventid") for name, parent in parents.items()}
        out = out.unionAll(Q.fk_violations(W.reconcile(published.cleaned, child), references))
    orders = tables.table(spark, sf_dir, "orders")
    return out.unionAll(Q.fk_violations(orders, {"order_to_rich_customer": ("o_custkey", rich, "c_custkey")}))


@query(
    "duplicate_dim_rows",
    """SELECT p_name, p_brand, p_type, count(*) AS row_count FROM part GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_dim_rows(spark, sf_dir):
    return Q.duplicate_keys(tables.table(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type"])


@query(
    "duplicate_tuple_count",
    A.over(
        "cleaned",
        """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT region, country, provstate, city, latitude, longitude
        FROM cleaned)) AS duplicates FROM cleaned""",
    ),
)
def duplicate_tuple_count(spark, sf_dir):
    return Q.duplicate_tuple_count(cleaned_view(spark, sf_dir), W.FULL_PLACE)


@query(
    "table_counts",
    A.over(
        "fact",
        "\nUNION ALL ".join(
            f"SELECT '{t}' AS step, count(*) AS row_count FROM {t}"
            for t in [*DIM_QUERIES.values(), "cleaned", "fact"]
        ),
    ),
)
def table_counts(spark, sf_dir):
    published = star(spark, sf_dir)
    return Q.step_counts({**published.dimensions, "cleaned": published.cleaned, "fact": published.fact})


@query(
    "missing_ids",
    A.over(
        "dims",
        """SELECT count(*) FILTER (time_id IS NULL) AS time_id_missing, count(*) FILTER (location_id IS NULL)
        AS location_id_missing, count(*) FILTER (property_id IS NULL) AS property_id_missing FROM cleaned
        LEFT JOIN dim_time USING (year, month, day, extended)
        LEFT JOIN dim_location ON cleaned.region = dim_location.region AND cleaned.country = dim_location.country
          AND cleaned.provstate = dim_location.provstate AND cleaned.city = dim_location.city
          AND cleaned.latitude = dim_location.latitude AND cleaned.longitude = dim_location.longitude
          AND cleaned.specificity = dim_location.specificity AND cleaned.vicinity = dim_location.vicinity
          AND cleaned.unknown_location = dim_location.unknown_location_flag
        LEFT JOIN dim_propertydamage ON cleaned.extent = dim_propertydamage.extent
          AND cleaned.property = dim_propertydamage.property
          AND cleaned.propvalue_category = dim_propertydamage.propvalue_category""",
    ),
)
def missing_ids(spark, sf_dir):
    """Ids a plain lookup leaves empty, before defaults are filled in."""
    published = star(spark, sf_dir)
    keyed = cleaned_view(spark, sf_dir)
    for name in ("dim_time", "dim_location", "dim_propertydamage"):
        dim = W.DIMENSIONS[name]
        member = published.dimensions[name].withColumnsRenamed({k: v for k, v in dim.keys.items()})
        keyed = W.lookup_min_id(keyed, member, dim.id_column, list(dim.keys.values()))
    return Q.missing_counts(keyed, ["time_id", "location_id", "property_id"])


@query(
    "export_union_header",
    A.over(
        "dims",
        """SELECT 'attack_type_id' AS attack_type_id, 'attack_type' AS attack_type, 'weapon_type' AS weapon_type,
        'weapon_subtype' AS weapon_subtype UNION ALL SELECT CAST(attack_type_id AS VARCHAR), attack_type, weapon_type,
        weapon_subtype FROM dim_attacktype""",
    ),
)
def export_union_header(spark, sf_dir):
    return with_header_row(star(spark, sf_dir).dimensions["dim_attacktype"])


@query("incremental_load", A.over("flat", "SELECT * FROM flat"))
def incremental_load(spark, sf_dir):
    """Raw files in two batches through cleaning, growing dimensions and the fact; shown with its dimensions' columns."""
    raw = tables.raw_incidents(spark, sf_dir)
    path = fresh_path(spark, "raw")
    raw.repartition(8, "eventid").write.parquet(path)
    raw = spark.read.parquet(path)
    rules = view_rules(spark, sf_dir)
    rules = replace(rules, sample_cut=sample_cut(raw, rules))
    grown = incremental.Star(fresh_path(spark, "grown"), buckets=16)
    incremental.load_stream(spark, path, grown, fresh_path(spark, "progress"), rules, files_per_batch=4)
    return W.star_flat(*incremental.loaded(spark, grown, raw, rules))


@query(
    "repeated_event_kpis",
    A.over(
        "flat",
        """SELECT count(*) AS fact_rows, count(DISTINCT eventid) AS total_attacks,
        count(DISTINCT CASE WHEN success = 1 THEN eventid END) AS successful_attacks,
        CAST(sum(nkill) AS BIGINT) AS total_killed FROM flat""",
    ),
)
def repeated_event_kpis(spark, sf_dir):
    """A third of the events arrives twice and a seventh again without its key; the load keeps each once."""
    event = col("eventid")
    # One pass over the incidents: each brings the keys it arrives with.
    none = F.array().cast("array<long>")
    again = F.when(event % 3 == 0, F.array(event)).otherwise(none)
    keyless = F.when(event % 7 == 0, F.array(F.lit(None).cast("long"))).otherwise(none)
    arrivals = F.concat(F.array(event), again, keyless)
    raw = tables.raw_incidents(spark, sf_dir)
    repeated = raw.withColumn("_arrivals", arrivals).withColumn("eventid", F.explode("_arrivals")).drop("_arrivals")
    cleaned, _ = clean(repeated, view_rules(spark, sf_dir))
    fact = W.load_fact(cleaned.withColumnRenamed("event_id", "eventid"), star(spark, sf_dir).dimensions)
    return fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_distinct("eventid").alias("total_attacks"),
        F.count_distinct(F.when(col("success") == 1, col("eventid"))).alias("successful_attacks"),
        F.sum("nkill").cast("long").alias("total_killed"),
    )
