"""Catalogue: constraints counted by the loads, rows that break rules, exports of all tables, replaced tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook import schemas
from casebook.operators import quality as Q, warehouse as W
from casebook.plans import answers as A
from casebook.plans.cleaning import clean
from casebook.plans.queries_warehouse import RECONCILED, SHORT
from casebook.plans.registry import query
from casebook.plans.star import cleaned_view, star, view_rules
from casebook.session import fresh_path, store
from casebook.sources import files, tables
from casebook.sources.versions import VersionedTable

col = F.col

_STAR = {**{t: t for t in W.DIMENSIONS}, "fact_incidents": "fact"}
_MEASURES = [*W.MEASURES, "total_casualties"]
_FLAGS = ["success", "propvalue_imputed", "us_casualty_imputed", "high_impact", "consistency_flag"]


def _required(*columns: str) -> dict[str, str]:
    return {f"{c}_required": f"{c} IS NOT NULL" for c in columns}


def _zero_one(*columns: str) -> dict[str, str]:
    return {f"{c}_domain": f"{c} IN (0, 1)" for c in columns}


# The declared constraints once more, as SQL.
_RULES = {
    "dim_time": {
        **_required("year", "month", "day", "extended"), "year_range": "year BETWEEN 1970 AND 2017",
        "month_range": "month BETWEEN 1 AND 12", "day_range": "day BETWEEN 1 AND 31", **_zero_one("extended"),
    },
    "dim_location": {
        **_required("region", "country", "unknown_location_flag"), "latitude_range": "latitude BETWEEN -90 AND 90",
        "longitude_range": "longitude BETWEEN -180 AND 180", "specificity_range": "specificity BETWEEN 1 AND 5",
        **_zero_one("vicinity", "unknown_location_flag"),
    },
    "dim_attacktype": _required("attack_type"),
    "dim_targettype": _required("target_type"),
    "dim_terroristgroup": {**_required("group_name", "unknown_group_flag"), **_zero_one("uncertainty", "unknown_group_flag")},
    "dim_propertydamage": {**_required("property"), "property_range": "property BETWEEN -1 AND 1"},
    "fact_incidents": {**_required(*_MEASURES, *_FLAGS), **{f"{m}_range": f"{m} >= 0" for m in _MEASURES}, **_zero_one(*_FLAGS)},
}


def _report(prefix: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, count(*) FILTER (NOT ({condition})) AS violations,"
        f" count(*) AS checked_rows FROM {prefix}{_STAR[table]}"
        for table, rules in _RULES.items()
        for rule, condition in rules.items()
    )


@query("load_checks", A.over("fact", _report()))
def load_checks(spark, sf_dir):
    """Every declared rule of the seven tables, as counted while the star was written."""
    return Q.observed_report(spark, star(spark, sf_dir).checks)


# (id, column, every n-th row, value) of the damage done before the checked load.
_DAMAGE = {
    "dim_time": ("time_id", {"year": (5, "2020"), "month": (7, "13"), "day": (11, "NULL"), "extended": (13, "2")}),
    "dim_location": ("location_id", {
        "region": (5, "NULL"), "latitude": (7, "-91"), "longitude": (11, "180.5"), "specificity": (13, "0"),
        "vicinity": (3, "NULL"), "unknown_location_flag": (17, "7"),
    }),
    "dim_attacktype": ("attack_type_id", {"attack_type": (3, "NULL")}),
    "dim_targettype": ("target_type_id", {"target_type": (4, "NULL")}),
    "dim_terroristgroup": ("group_id", {"group_name": (3, "NULL"), "uncertainty": (5, "-1"), "unknown_group_flag": (7, "NULL")}),
    "dim_propertydamage": ("property_id", {"property": (2, "-2")}),
    "fact_incidents": ("eventid", {
        "nkill": (10, "-1"), "nwound": (11, "NULL"), "nkillter": (13, "-0.5"), "success": (17, "2"), "high_impact": (19, "NULL"),
        "total_casualties": (23, "-3"), "consistency_flag": (29, "9"),
    }),
}


def _damaged(table: str) -> dict[str, str]:
    key, columns = _DAMAGE[table]
    return {c: f"CASE WHEN {key} % {n} = 0 THEN {value} ELSE {c} END" for c, (n, value) in columns.items()}


def damaged_star(spark, sf_dir):
    published = star(spark, sf_dir)
    frames = {**published.dimensions, "fact_incidents": published.fact}
    return {t: df.withColumns({c: F.expr(e) for c, e in _damaged(t).items()}) for t, df in frames.items()}


@query(
    "load_checks_damaged",
    A.over(
        "fact",
        _report("bad_"),
        ",\n".join(
            f"bad_{name} AS (SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in _damaged(table).items())}) FROM {name})"
            for table, name in _STAR.items()
        ),
    ),
)
def load_checks_damaged(spark, sf_dir):
    """The same rules over tables with planted damage, counted by the writes."""
    rules, seen = Q.warehouse_rules(), {}
    for name, df in damaged_star(spark, sf_dir).items():
        watched, observation = Q.watch(df, rules[name])
        store(watched, f"damaged-{name}")
        seen[name] = observation.get
    return Q.observed_report(spark, seen)


# Rows outside the domains of the normalised tables and the fact.

_SPOIL = {
    "year": (10, "2018"), "month": (11, "0"), "day": (13, "32"), "extended": (17, "2"), "success": (19, "-1"),
    "attacktype1": (7, "NULL"), "weapsubtype1": (9, "NULL"), "targsubtype1": (8, "NULL"), "nationality1": (15, "NULL"),
    "group_name": (12, "NULL"), "uncertainty1": (14, "NULL"), "nkill": (16, "-4"), "nwound": (18, "NULL"), "high_impact": (21, "5"),
}
_SPOILED = {c: f"CASE WHEN eventid % {n} = 0 THEN {value} ELSE {c} END" for c, (n, value) in _SPOIL.items()}
_SPOILED_VIEW = f"""
spoiled AS (SELECT * REPLACE ({", ".join(f"{e} AS {c}" for c, e in _SPOILED.items())}) FROM cleaned)"""


def spoiled_view(spark, sf_dir):
    return cleaned_view(spark, sf_dir).withColumns({c: F.expr(e) for c, e in _SPOILED.items()})


def _add_spoiled(name: str) -> None:
    sql = RECONCILED[name].replace("FROM cleaned", "FROM spoiled")
    if name == "casualties":
        sql = sql.replace("nkill, nwound,", "coalesce(nkill, 0) AS nkill, coalesce(nwound, 0) AS nwound,")

    @query(f"reconcile_spoiled_{SHORT.get(name, name)}", A.over("cleaned", sql, _SPOILED_VIEW))
    def build(spark, sf_dir):
        part = W.reconcile(spoiled_view(spark, sf_dir), name)
        return part.withColumn("propvalue", col("propvalue").cast("double")) if "propvalue" in part.columns else part


for _name in ("incidents", "attacks", "targets", "casualties", "terroristgroups"):
    _add_spoiled(_name)


@query(
    "fact_domain_rejects",
    A.over(
        "cleaned",
        """SELECT eventid FROM spoiled WHERE coalesce(nkill, 0) >= 0 AND coalesce(nwound, 0) >= 0 AND nkillter >= 0
        AND nwoundter >= 0 AND nkillus >= 0 AND nwoundus >= 0 AND success IN (0, 1) AND propvalue_imputed IN (0, 1)
        AND us_casualty_imputed IN (0, 1) AND high_impact IN (0, 1)""",
        _SPOILED_VIEW,
    ),
)
def fact_domain_rejects(spark, sf_dir):
    """The events that the load keeps when measures and flags are outside their domains."""
    return W.load_fact(spoiled_view(spark, sf_dir), star(spark, sf_dir).dimensions).select("eventid")


@query(
    "reconcile_incidents_summary",
    A.over(
        "cleaned",
        f"""SELECT cleaned.eventid, year, month, day, cleaned.extended, cleaned.success,
        coalesce({A.normalized("summary")}, '') AS summary FROM cleaned JOIN raw USING (eventid)
        WHERE year BETWEEN 1970 AND 2017 AND month BETWEEN 1 AND 12 AND day BETWEEN 1 AND 31""",
    ),
)
def reconcile_incidents_summary(spark, sf_dir):
    """Incidents with their summary, from raw rows through cleaning."""
    cleaned, _ = clean(tables.raw_incidents(spark, sf_dir, with_summary=True), view_rules(spark, sf_dir))
    return W.reconcile(cleaned.withColumnRenamed("event_id", "eventid"), "incidents")


# Exports and replaced tables.


@query(
    "export_all_tables",
    A.over(
        "fact",
        " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, '{','.join(schema.names)}' AS header, count(*) AS row_count,"
            f" CAST(sum({schema.names[0]}) AS HUGEINT)::VARCHAR AS key_sum FROM {_STAR[table]}"
            for table, schema in {**schemas.DIMENSIONS, "fact_incidents": schemas.FACT}.items()
        ),
    ),
)
def export_all_tables(spark, sf_dir):
    """All seven tables written as quoted CSV with a header, and what typed readers find there."""
    published = star(spark, sf_dir)
    declared = {**schemas.DIMENSIONS, "fact_incidents": schemas.FACT}
    frames = {**published.dimensions, "fact_incidents": published.fact}
    folder = fresh_path(spark, "export")
    files.export_tables({name: df.select(*declared[name].names) for name, df in frames.items()}, folder)
    out = None
    for name, df in files.read_collection(spark, folder, declared).items():
        first = spark.read.option("header", True).csv(f"{folder}/{name}.csv").columns
        row = df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(col(df.columns[0]).cast("decimal(38,0)")).cast("string").alias("key_sum"))
        row = row.select(F.lit(name).alias("table_name"), F.lit(",".join(first)).alias("header"), "row_count", "key_sum")
        out = row if out is None else out.unionAll(row)
    return out


@query(
    "replaced_table",
    """SELECT c_custkey, upper(c_mktsegment) AS c_mktsegment FROM customer WHERE c_custkey % 3 <> 0""",
)
def replaced_table(spark, sf_dir):
    """A table that is loaded, then replaced by what is read from it; the second version is what readers get."""
    customers = VersionedTable(spark, fresh_path(spark, "customers"))
    customers.replace(tables.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"))
    kept = customers.read().where(col("c_custkey") % 3 != 0)
    customers.replace(kept.withColumn("c_mktsegment", F.upper("c_mktsegment")))
    return customers.read()
