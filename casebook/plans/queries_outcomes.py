"""Catalogue: accepted and set-aside rows of one pass, by outcome and reason, over several runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook.functions import values
from casebook.operators import cleaning as C, warehouse as W
from casebook.plans import answers as A
from casebook.plans.queries_cleaning import _FITS, _IQR, ALLOWED, CAPPED, READY, ready
from casebook.plans.queries_text import _CENTROIDS, _KM, SIZES
from casebook.plans.queries_warehouse import _EDITED, _STEPS, edited_events
from casebook.plans.registry import query
from casebook.plans.star import star
from casebook.session import Passing, fresh_path, materialize
from casebook.sources import files, tables

col = F.col

UNKNOWN_GROUPS = [["provstate", "city"], ["city", "group_name"]]
SUBTYPES = {"a": ["f", "unknown"], "n": ["o", "unknown"], "r": ["f"]}
_SUBTYPE_FITS = """CASE weapon_type WHEN 'a' THEN weapon_subtype IN ('f', 'unknown') WHEN 'n' THEN weapon_subtype IN ('o', 'unknown')
 WHEN 'r' THEN weapon_subtype = 'f' ELSE weapon_subtype = 'unknown' END"""


def fits(allowed: dict, main: str, other: str):
    found = col(other) == "unknown"
    for value, members in allowed.items():
        found = F.when(col(main) == value, col(other).isin(members)).otherwise(found)
    return found


@query(
    "flag_subtype_mismatch",
    A.over(
        "prepared",
        f"""SELECT eventid, CASE WHEN {_SUBTYPE_FITS} THEN weapon_subtype ELSE 'unknown' END AS weapon_subtype,
        CASE WHEN {_SUBTYPE_FITS} THEN 0 ELSE 1 END AS weapon_subtype_replaced FROM ready""",
        READY,
    ),
)
def flag_subtype_mismatch(spark, sf_dir):
    """Weapon subtypes that their weapon type does not list become unknown."""
    df = ready(spark, sf_dir).select("eventid", "weapon_type", "weapon_subtype")
    fixed = C.enforce_pairs(df, "weapon_type", "weapon_subtype", SUBTYPES, "mismatch_flag")
    return fixed.drop("weapon_type", "mismatch_flag")


@query(
    "none_group_flag",
    A.over(
        "prepared",
        """SELECT eventid, coalesce(g, 'unknown') AS group_name, CASE WHEN coalesce(g, 'unknown') = 'unknown' THEN 1 ELSE 0 END
        AS none_group_flag FROM (SELECT eventid, CASE WHEN eventid % 12 <> 0 THEN group_name END AS g FROM ready)""",
        READY,
    ),
)
def none_group_flag(spark, sf_dir):
    named = ready(spark, sf_dir).select("eventid", F.when(col("eventid") % 12 != 0, col("group_name")).alias("group_name"))
    return C.fill_missing_group(named)


def _any(*conditions: str) -> str:
    return "coalesce(" + " OR ".join(conditions) + ", false)"


_REASONS = {
    "zero_date": _any("year = 0", "month = 0", "day = 0"),
    "all_unknown": _any("(provstate = 'unknown' AND city = 'unknown')", "(city = 'unknown' AND g = 'unknown')"),
    "damage_without_value": _any("(property = 1 AND propvalue IS NULL)"),
    "subcount_discrepancy": "coalesce(nationality = 'nation_3' OR country = 'nation_3', false)"
    " AND (coalesce(nkillus = 0, false) OR coalesce(nwoundus = 0, false)) AND (coalesce(nkill > 0, false) OR coalesce(nwound > 0, false))",
    "missing_coordinates": "latitude IS NULL OR longitude IS NULL",
    "inconsistent_casualties": _any(
        "nkillter > nkill", "nwoundter > nwound", "nkillus > nkill", "nwoundus > nwound", "(success = 0 AND nkill > 0)",
        "(success = 0 AND nwound > 0)",
    ),
    "attack_weapon_mismatch": f"NOT ({_FITS})",
    "subtype_mismatch": f"NOT ({_SUBTYPE_FITS})",
    "missing_group": "g IS NULL",
    "geo_inconsistent": "far",
    **{f"outlier_{c}": f"coalesce({c} < {c}_low OR {c} > {c}_high, false)" for c in CAPPED},
}
_DROPS = ("zero_date", "all_unknown")


def judged(spark, sf_dir):
    """Prepared incidents with the flags that the outcome rules ask for, stored once; the table they come from goes."""
    with Passing(spark) as block:
        df = C.iqr_outliers(materialize(ready(spark, sf_dir), "ready"), CAPPED)
        placed = C.geo_consistency(df, tables.country_centroids(spark, sf_dir), SIZES, 7000)
        return block.keep(placed.withColumn("group_name", F.when(col("eventid") % 12 != 0, col("group_name"))), "judged")


@query(
    "tagged_outcomes",
    A.over(
        "prepared",
        "SELECT run, outcome, reason, count(*) AS row_count, CAST(sum(eventid) AS DECIMAL(38, 0)) AS key_sum FROM ("
        + " UNION ALL ".join(
            [f"SELECT eventid, 'accepted' AS outcome, 'none' AS reason FROM judged WHERE NOT ({' OR '.join(f'({_REASONS[d]})' for d in _DROPS)})"]
            + [f"SELECT eventid, 'set_aside', '{reason}' FROM judged WHERE {rule}" for reason, rule in _REASONS.items()]
        )
        + "), range(1, 3) t(run) GROUP BY ALL",
        READY,
        _IQR,
        _CENTROIDS,
        _KM,
        """distances AS (SELECT eventid AS id, coalesce(km > CASE country WHEN 'nation_1' THEN 9000 WHEN 'nation_2' THEN 5000
          WHEN 'nation_3' THEN 3000 ELSE 7000 END, false) AS far FROM measured),
        judged AS MATERIALIZED (SELECT ready.*, CASE WHEN eventid % 12 <> 0 THEN group_name END AS g, weapon_type AS w, far, limits.*
          FROM ready JOIN distances ON eventid = id, limits)""",
    ),
)
def tagged_outcomes(spark, sf_dir):
    """All rules of both cleaning lineages in one writing pass per run; two runs, the second one repeated."""
    zero = lambda c: col(c) == 0
    here = values.true_only((col("nationality") == tables.PICKED_COUNTRY) | (col("country") == tables.PICKED_COUNTRY))
    none = values.true_only(zero("nkillus")) | values.true_only(zero("nwoundus"))
    some = values.true_only(col("nkill") > 0) | values.true_only(col("nwound") > 0)
    # Coordinates that are too far away are emptied by then, so the rule on missing ones looks at the flag, too.
    lost = (col("latitude").isNull() | col("longitude").isNull()) & (col("geo_inconsistent_flag") == 0)
    drops = {"zero_date": zero("year") | zero("month") | zero("day"), "all_unknown": C.all_unknown(UNKNOWN_GROUPS)}
    suspects = {
        "damage_without_value": (col("property") == 1) & col("propvalue").isNull(),
        "subcount_discrepancy": here & none & some,
        "missing_coordinates": lost,
        "inconsistent_casualties": C.inconsistent_casualties(),
        "attack_weapon_mismatch": ~fits(ALLOWED, "attack_type", "weapon_type"),
        "subtype_mismatch": ~fits(SUBTYPES, "weapon_type", "weapon_subtype"),
        "missing_group": col("group_name").isNull(),
        "geo_inconsistent": col("geo_inconsistent_flag") == 1,
        **{f"outlier_{c}": col(f"{c}_outlier") == 1 for c in CAPPED},
    }
    path = fresh_path(spark, "outcomes")
    # The runs read stored rows, which go before the answer is read from what they wrote.
    with Passing(spark):
        df = judged(spark, sf_dir)
        for run in (1, 2, 2):
            files.write_outcomes(df, path, run, drops, suspects)
    found = files.read_outcomes(spark, path).groupBy(col("run").cast("long").alias("run"), "outcome", "reason")
    return found.agg(F.count(F.lit(1)).alias("row_count"), F.sum(col("eventid").cast("decimal(38,0)")).cast("decimal(38,0)").alias("key_sum"))


@query(
    "dim_location_grown",
    A.over(
        "dims",
        """SELECT * FROM dim_location UNION ALL BY NAME
        SELECT new_id AS location_id, region, country, provstate, city, latitude, longitude, first.specificity AS specificity,
          first.vicinity AS vicinity, first.unknown_location_flag AS unknown_location_flag
        FROM late JOIN (SELECT region, country, provstate, city, latitude, longitude,
            min({'specificity': specificity, 'vicinity': vicinity, 'unknown_location_flag': unknown_location_flag}) AS first
          FROM stepped WHERE coalesce(full_id, name_id, key_id) IS NULL GROUP BY ALL)
          USING (region, country, provstate, city, latitude, longitude)""",
        _EDITED,
        _STEPS.strip("\n"),
    ),
)
def dim_location_grown(spark, sf_dir):
    """The dimension with the members that no step of the fallback found; a second load finds them all."""
    dim = star(spark, sf_dir).dimensions["dim_location"]
    _, new = W.resolve_location(edited_events(spark, sf_dir), dim)
    return materialize(dim.unionByName(new.select(*dim.columns)), "grown")
