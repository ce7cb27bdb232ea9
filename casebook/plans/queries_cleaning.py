"""Catalogue: scans, renames, validation, repair, imputation, flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casebook.functions import dates, fixed_values as V, text, values
from casebook.operators import cleaning as C, quality as Q
from casebook.operators.ordering import first_rows
from casebook.plans import answers as A
from casebook.plans.cleaning import (
    LOADER_RENAMES, damage_without_value, in_country, prepared, subcount_discrepancy,
)
from casebook.plans.registry import query
from casebook.plans.star import ATTACK_TYPES, EXTENT_VALUES
from casebook.sources import tables
from casebook.sources.files import quarantine_by_rule

col = F.col


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.raw_incidents(spark, sf_dir)


def ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared incidents under the loader's names."""
    return C.rename(prepared(raw(spark, sf_dir)), LOADER_RENAMES)


def renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw incidents under the loader's names, values untouched."""
    unified = C.unify_column(raw(spark, sf_dir), ["nwoundte", "nwoundter"], "nwoundter", 0.0)
    return C.rename(unified, LOADER_RENAMES)


def loader_view(name: str, source: str) -> str:
    """WITH member: the incident columns of ``source`` under the names of the loading lineage."""
    return f"""
{name} AS (SELECT eventid, iyear AS year, imonth AS month, iday AS day, region_txt AS region,
  country_txt AS country, provstate, city, latitude, longitude, specificity, vicinity, extended, success,
  attacktype1_txt AS attack_type, weaptype1_txt AS weapon_type, weapsubtype1_txt AS weapon_subtype,
  targtype1_txt AS target_type, targsubtype1_txt AS target_subtype, natlty1_txt AS nationality,
  gname AS group_name, guncertain1 AS uncertainty, nkill, nwound, nkillter, nwoundte AS nwoundter,
  nkillus, nwoundus, property, propextent_txt AS extent, propvalue FROM {source})"""


READY = loader_view("ready", "prepared")
RENAMED = loader_view("renamed", "raw")


@query("scan_pruned", "SELECT c_custkey, c_mktsegment FROM customer")
def scan_pruned(spark, sf_dir):
    return tables.pruned(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")


@query(
    "rename_project",
    A.over(
        "raw",
        "SELECT eventid, year, month, day, country, attack_type, target_type, group_name, uncertainty, extent"
        " FROM renamed",
        RENAMED,
    ),
)
def rename_project(spark, sf_dir):
    wanted = [
        "eventid", "year", "month", "day", "country", "attack_type", "target_type", "group_name",
        "uncertainty", "extent", "column_that_is_not_there",
    ]
    return C.select_existing(renamed(spark, sf_dir), wanted)


@query(
    "cast_with_guard",
    A.over(
        "raw",
        """SELECT eventid, CAST(coalesce(nkill, 0) AS INTEGER) AS nkill,
        CAST(coalesce(specificity, 0) AS INTEGER) AS specificity,
        CASE WHEN nwound IS NULL OR nwound = 0 THEN 0 ELSE CAST(trunc(nkill / nwound) AS INTEGER) END AS ratio
        FROM (SELECT eventid, specificity, nwound, coalesce(nkill, 0) AS nkill FROM raw)""",
    ),
)
def cast_with_guard(spark, sf_dir):
    df = raw(spark, sf_dir)
    infinite = F.when(col("nwound") == 0, float("inf")).otherwise(
        F.coalesce(col("nkill"), F.lit(0.0)) / F.nullif(col("nwound"), F.lit(0.0))
    )
    return df.select(
        "eventid",
        values.whole_number(col("nkill")).alias("nkill"),
        values.whole_number(col("specificity")).alias("specificity"),
        values.whole_number(infinite).alias("ratio"),
    )


_DROPPED = A.over("raw", "SELECT eventid, year, month, day FROM renamed WHERE {}", RENAMED)


@query("drop_zero_dates", _DROPPED.format("year <> 0 AND month <> 0 AND day <> 0"))
def drop_zero_dates(spark, sf_dir):
    kept, _ = C.drop_zero_dates(renamed(spark, sf_dir).select("eventid", "year", "month", "day"))
    return kept


@query(
    "quarantine_rows",
    A.over(
        "raw",
        """SELECT eventid, year, month, day, country, city, reason FROM (
          SELECT *, 'zero_date' AS reason FROM renamed WHERE year = 0 OR month = 0 OR day = 0
          UNION ALL SELECT *, 'missing_coordinates' FROM renamed WHERE latitude IS NULL OR longitude IS NULL
          UNION ALL SELECT *, 'damage_without_value' FROM renamed WHERE property = 1 AND propvalue IS NULL
          UNION ALL SELECT *, 'inconsistent_casualties' FROM renamed
            WHERE nkillter > nkill OR nwoundter > nwound OR nkillus > nkill OR nwoundus > nwound
               OR (success = 0 AND nkill > 0) OR (success = 0 AND nwound > 0)
          UNION ALL SELECT *, 'unknown_group' FROM renamed WHERE group_name = 'unknown'
          UNION ALL SELECT *, 'unknown_city' FROM renamed WHERE city = 'unknown')""",
        RENAMED,
    ),
)
def quarantine_rows(spark, sf_dir):
    zero = lambda c: col(c) == 0
    rules = {
        "zero_date": values.true_only(zero("year") | zero("month") | zero("day")),
        "missing_coordinates": col("latitude").isNull() | col("longitude").isNull(),
        "damage_without_value": damage_without_value(),
        "inconsistent_casualties": C.inconsistent_casualties(),
        "unknown_group": values.true_only(col("group_name") == "unknown"),
        "unknown_city": values.true_only(col("city") == "unknown"),
    }
    found = quarantine_by_rule(renamed(spark, sf_dir), rules)
    return found.select("eventid", "year", "month", "day", "country", "city", "reason")


@query(
    "date_zero_breakdown",
    A.over(
        "raw",
        """SELECT count(*) FILTER (year = 0) AS year_zero, count(*) FILTER (month = 0) AS month_zero,
        count(*) FILTER (day = 0) AS day_zero,
        count(*) FILTER (year = 0 AND month <> 0 AND day <> 0) AS year_only,
        count(*) FILTER (year <> 0 AND month = 0 AND day <> 0) AS month_only,
        count(*) FILTER (year <> 0 AND month <> 0 AND day = 0) AS day_only,
        count(*) FILTER (year = 0 AND month = 0 AND day <> 0) AS year_month_only,
        count(*) FILTER (year = 0 AND month <> 0 AND day = 0) AS year_day_only,
        count(*) FILTER (year <> 0 AND month = 0 AND day = 0) AS month_day_only,
        count(*) FILTER (year = 0 AND month = 0 AND day = 0) AS all_zero FROM renamed""",
        RENAMED,
    ),
)
def date_zero_breakdown(spark, sf_dir):
    return Q.zero_date_breakdown(renamed(spark, sf_dir))


_SHIFTED = """SELECT o_orderkey AS eventid, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year,
 CAST(o_orderkey % 15 AS INTEGER) AS month, CAST(o_orderkey % 33 AS INTEGER) AS day FROM orders"""


def shifted_dates(spark, sf_dir):
    """Dates that are often none: month 0..14, day 0..32."""
    o = col("o_orderkey")
    return tables.table(spark, sf_dir, "orders").select(
        o.alias("eventid"),
        F.year("o_orderdate").alias("year"),
        (o % 15).cast("int").alias("month"),
        (o % 33).cast("int").alias("day"),
    )


@query(
    "valid_calendar_date",
    f"""SELECT *, CASE WHEN try_cast(printf('%d-%02d-%02d', year, month, day) AS DATE) IS NULL THEN 0 ELSE 1 END
    AS valid_date FROM ({_SHIFTED})""",
)
def valid_calendar_date(spark, sf_dir):
    return Q.calendar_flags(shifted_dates(spark, sf_dir))


@query(
    "date_features",
    f"""SELECT eventid, CAST(floor((month - 1) / 3) + 1 AS INTEGER) AS quarter,
    coalesce(dayname(try_cast(printf('%d-%02d-%02d', year, month, day) AS DATE)), 'unknown') AS weekday
    FROM ({_SHIFTED})""",
)
def date_features(spark, sf_dir):
    df = shifted_dates(spark, sf_dir)
    date = dates.date_of(col("year"), col("month"), col("day"))
    return df.select(
        "eventid", dates.quarter_of(col("month")).alias("quarter"), dates.weekday_of(date).alias("weekday")
    )


@query(
    "impute_dates",
    A.over(
        "raw",
        """SELECT eventid, year, m AS month, d AS day,
        CASE WHEN m = 1 AND d = 1 AND (SELECT bool_or(month = 0 OR day = 0) FROM renamed) THEN 1 ELSE 0 END
          AS ambiguous_date_flag,
        CASE WHEN month = 0 OR day = 0 THEN 1 ELSE 0 END AS date_imputed_flag
        FROM (SELECT *, CASE WHEN month = 0 THEN 1 ELSE month END AS m,
                     CASE WHEN day = 0 THEN 1 ELSE day END AS d FROM renamed)""",
        RENAMED,
    ),
)
def impute_dates(spark, sf_dir):
    return C.impute_dates(renamed(spark, sf_dir).select("eventid", "year", "month", "day"))


@query(
    "dq_assertions",
    A.over(
        "raw",
        """SELECT 'invalid_date' AS rule, count(*) FILTER (year < 1970 OR month < 1 OR day < 1) AS violations FROM renamed
        UNION ALL SELECT 'duplicate_key', (SELECT count(*) FROM (SELECT eventid FROM renamed GROUP BY 1 HAVING count(*) > 1))
        UNION ALL SELECT 'year_out_of_range', count(*) FILTER (year NOT BETWEEN 1970 AND 2017) FROM renamed""",
        RENAMED,
    ),
)
def dq_assertions(spark, sf_dir):
    df = Q.require_columns(renamed(spark, sf_dir), ["eventid", "year", "month", "day", "country"])
    one_pass = Q.check_constraints(
        df,
        {
            "invalid_date": (col("year") >= 1970) & (col("month") >= 1) & (col("day") >= 1),
            "year_out_of_range": Q.in_range("year", V.FIRST_YEAR, V.LAST_YEAR),
        },
    )
    repeated = Q.duplicate_keys(df, ["eventid"]).agg(F.count(F.lit(1)).alias("violations"))
    return one_pass.unionByName(repeated.select(F.lit("duplicate_key").alias("rule"), "violations"))


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_keys(spark, sf_dir):
    return Q.duplicate_keys(tables.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


@query(
    "dedupe_keep_first",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(LINE_ORDER)}) = 1""",
)
def dedupe_keep_first(spark, sf_dir):
    lines = tables.table(spark, sf_dir, "lineitem")
    kept = C.dedupe_keep_first(lines, ["l_orderkey", "l_linenumber"], [col(c) for c in LINE_ORDER])
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query(
    "valid_category",
    A.over(
        "prepared",
        """SELECT eventid, CASE WHEN attack_type IN ('1-urgent', '2-high', '3-medium', '5-low', 'unknown')
        THEN attack_type ELSE 'unknown' END AS attack_type FROM ready""",
        READY,
    ),
)
def valid_category(spark, sf_dir):
    return ready(spark, sf_dir).select(
        "eventid", values.known_or_unknown(col("attack_type"), ATTACK_TYPES).alias("attack_type")
    )


_BLURRED = """
blurred AS (SELECT eventid, city, provstate,
  CASE WHEN eventid % 5 = 0 THEN 'unknown' ELSE country END AS country,
  CASE WHEN eventid % 6 = 0 THEN 'unknown' ELSE target_type END AS target_type,
  CASE WHEN eventid % 4 = 0 THEN 'unknown' ELSE target_subtype END AS target_subtype,
  CASE WHEN eventid % 3 = 0 THEN 'unknown' ELSE nationality END AS nationality FROM ready)"""
_NOT_PLACED = "(city = 'unknown' AND country = 'unknown' AND provstate = 'unknown')"
_NO_TARGET = "(target_type = 'unknown' AND target_subtype = 'unknown' AND nationality = 'unknown')"


@query(
    "drop_all_unknown",
    A.over(
        "prepared",
        f"""SELECT *, CASE WHEN {_NOT_PLACED} OR {_NO_TARGET} THEN 'rejected' ELSE 'kept' END AS outcome
        FROM blurred""",
        READY,
        _BLURRED,
    ),
)
def drop_all_unknown(spark, sf_dir):
    df = ready(spark, sf_dir)
    blur = {"country": 5, "target_type": 6, "target_subtype": 4, "nationality": 3}
    blurred = df.withColumns(
        {c: F.when(col("eventid") % n == 0, "unknown").otherwise(col(c)) for c, n in blur.items()}
    ).select("eventid", "city", "provstate", *blur)
    kept, rejected = C.drop_all_unknown(
        blurred, [["city", "country", "provstate"], ["target_type", "target_subtype", "nationality"]]
    )
    return kept.withColumn("outcome", F.lit("kept")).unionByName(rejected.withColumn("outcome", F.lit("rejected")))


@query(
    "regex_flag",
    """SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)the|und|valu') THEN 1 ELSE 0 END AS damage_flag,
    CASE WHEN regexp_matches(text, '(?i)worthless|licensed') THEN 1 ELSE 0 END AS claimed_flag FROM documents""",
)
def regex_flag(spark, sf_dir):
    return tables.table(spark, sf_dir, "documents").select(
        "doc_id",
        values.flag(text.matches(col("text"), "the|und|valu")).alias("damage_flag"),
        values.flag(text.matches(col("text"), "worthless|licensed")).alias("claimed_flag"),
    )


@query(
    "like_filter",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority ILIKE '%not spec%'",
)
def like_filter(spark, sf_dir):
    orders = tables.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return orders.where(text.like_ignoring_case(col("o_orderpriority"), "%NOT spec%"))


@query(
    "discrepancy_audit",
    A.over(
        "prepared",
        """SELECT count(*) FILTER (property = 1 AND propvalue IS NULL) AS damage_without_value,
        count(*) FILTER (propextent_txt IN ('minor', 'major', 'catastrophic') AND propvalue IS NULL)
          AS extent_without_value,
        count(*) FILTER (natlty1_txt = 'nation_3' OR country_txt = 'nation_3') AS in_country,
        count(*) FILTER ((natlty1_txt = 'nation_3' OR country_txt = 'nation_3')
          AND (nkillus = 0 OR nwoundus = 0) AND (nkill > 0 OR nwound > 0)) AS subcount_discrepancy
        FROM prepared""",
    ),
)
def discrepancy_audit(spark, sf_dir):
    extents = col("propextent_txt").isin(list(EXTENT_VALUES))
    return prepared(raw(spark, sf_dir)).agg(
        F.count_if(damage_without_value()).alias("damage_without_value"),
        F.count_if(extents & col("propvalue").isNull()).alias("extent_without_value"),
        F.count_if(in_country(tables.PICKED_COUNTRY)).alias("in_country"),
        F.count_if(subcount_discrepancy(tables.PICKED_COUNTRY)).alias("subcount_discrepancy"),
    )


@query(
    "non_numeric_values",
    """SELECT o_orderkey, value_text FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN 'n/a'
    WHEN o_orderkey % 103 = 0 THEN '12 units' ELSE CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR) END AS value_text
    FROM orders) WHERE try_cast(value_text AS DOUBLE) IS NULL AND value_text IS NOT NULL""",
)
def non_numeric_values(spark, sf_dir):
    o = col("o_orderkey")
    value = (
        F.when(o % 101 == 0, "n/a")
        .when(o % 103 == 0, "12 units")
        .otherwise(col("o_totalprice").cast("long").cast("string"))
    )
    df = tables.table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value_text"))
    return df.where(values.is_not_numeric(col("value_text")))


@query(
    "fill_missing",
    A.over(
        "raw",
        """SELECT eventid, coalesce(provstate, 'unknown') AS provstate, coalesce(weapon_type, 'unknown') AS weapon_type,
        coalesce(nkill, 0) AS nkill, coalesce(nwound, 0) AS nwound, coalesce(specificity, 0) AS specificity
        FROM renamed""",
        RENAMED,
    ),
)
def fill_missing(spark, sf_dir):
    df = C.fill_missing(
        renamed(spark, sf_dir), unknown=["provstate", "weapon_type"], zero=["nkill", "nwound", "specificity"]
    )
    return df.select("eventid", "provstate", "weapon_type", "nkill", "nwound", "specificity")


@query(
    "sentinel_recode",
    A.over(
        "raw",
        """SELECT eventid, nullif(propvalue, -99) AS propvalue,
        CASE WHEN property = -9 THEN -1 ELSE property END AS property FROM raw""",
    ),
)
def sentinel_recode(spark, sf_dir):
    return C.recode_sentinels(raw(spark, sf_dir)).select("eventid", "propvalue", "property")


@query(
    "impute_partial_counts",
    A.over(
        "prepared",
        """SELECT eventid, CASE WHEN k THEN greatest(1, trunc(nkill * 0.5)) ELSE nkillus END AS nkillus,
        CASE WHEN w THEN greatest(1, trunc(nwound * 0.5)) ELSE nwoundus END AS nwoundus,
        CASE WHEN k OR w THEN 1 ELSE 0 END AS us_casualty_imputed
        FROM (SELECT *, c AND coalesce(nkillus, 0) = 0 AND coalesce(nkill, 0) > 0 AS k,
          c AND coalesce(nwoundus, 0) = 0 AND coalesce(nwound, 0) > 0 AS w
          FROM (SELECT *, natlty1_txt = 'nation_3' OR country_txt = 'nation_3' AS c FROM prepared))""",
    ),
)
def impute_partial_counts(spark, sf_dir):
    df = C.impute_partial_counts(
        prepared(raw(spark, sf_dir)),
        in_country(tables.PICKED_COUNTRY),
        {"nkillus": "nkill", "nwoundus": "nwound"},
        "us_casualty_imputed",
    )
    return df.select("eventid", "nkillus", "nwoundus", "us_casualty_imputed")


_BUCKET = """CASE WHEN {n} AND extent = 'minor' THEN 10000.0::DOUBLE WHEN {n} AND extent = 'major'
 THEN 10000000.0::DOUBLE WHEN {n} AND extent = 'catastrophic' THEN 1500000000.0::DOUBLE ELSE propvalue END""".format(
    n="(property = 1 AND (propvalue IS NULL OR propvalue <= 0))"
)


@query(
    "impute_by_bucket",
    A.over(
        "prepared",
        f"""SELECT eventid, {_BUCKET} AS propvalue,
        CASE WHEN property = 1 AND (propvalue IS NULL OR propvalue <= 0) AND extent <> 'unknown' THEN 1 ELSE 0 END
        AS propvalue_imputed FROM ready""",
        READY,
    ),
)
def impute_by_bucket(spark, sf_dir):
    df = C.impute_by_bucket(ready(spark, sf_dir), EXTENT_VALUES, "propvalue_imputed")
    return df.select("eventid", "propvalue", "propvalue_imputed")


@query(
    "impute_capped_sample",
    A.over(
        "prepared",
        """SELECT eventid, CASE WHEN r <= 250 THEN 10000.0::DOUBLE ELSE propvalue END AS propvalue,
        CASE WHEN r <= 250 THEN 1 ELSE 0 END AS propvalue_imputed
        FROM ready LEFT JOIN (SELECT eventid, row_number() OVER (ORDER BY md5('42:' || eventid), eventid) AS r FROM ready
          WHERE property = 1 AND (propvalue IS NULL OR propvalue <= 0) AND extent = 'unknown') USING (eventid)""",
        READY,
    ),
)
def impute_capped_sample(spark, sf_dir):
    df = C.impute_capped_sample(
        ready(spark, sf_dir), "eventid", "propvalue_imputed", 250, V.UNKNOWN_EXTENT_VALUE
    )
    return df.select("eventid", "propvalue", "propvalue_imputed")


@query(
    "repair_values",
    A.over(
        "raw",
        """SELECT eventid, CASE WHEN extent = 'Unknown' THEN -1 ELSE p END AS property,
        CASE WHEN p = -1 AND propvalue > 0 THEN 0 WHEN propvalue < 0 THEN 0 ELSE propvalue END AS propvalue
        FROM (SELECT *, CASE WHEN property = -9 THEN -1 ELSE property END AS p FROM renamed)""",
        RENAMED,
    ),
)
def repair_values(spark, sf_dir):
    df = renamed(spark, sf_dir).withColumns(
        {"property": values.recode(col("property"), -9, -1), "extent": F.lower("extent")}
    )
    return C.repair_values(df).select("eventid", "property", "propvalue")


_SIZED = """CASE WHEN extent = 'unknown' AND propvalue >= 1000000 THEN 'catastrophic'
 WHEN extent = 'unknown' AND propvalue >= 100000 THEN 'major'
 WHEN extent = 'unknown' AND propvalue > 0 THEN 'minor' ELSE extent END"""


@query("impute_extent", A.over("prepared", f"SELECT eventid, {_SIZED} AS extent FROM ready", READY))
def impute_extent(spark, sf_dir):
    df = ready(spark, sf_dir)
    return df.select("eventid", values.extent_from_value(col("extent"), col("propvalue")).alias("extent"))


@query(
    "flag_extent_mismatch",
    A.over(
        "prepared",
        f"""SELECT eventid, e AS extent, CASE WHEN (e = 'minor' AND propvalue >= 100000)
        OR (e = 'major' AND propvalue >= 1000000) OR (e = 'catastrophic' AND propvalue < 1000000) THEN 1 ELSE 0 END
        AS mismatch_flag FROM (SELECT *, {_SIZED} AS e FROM ready)""",
        READY,
    ),
)
def flag_extent_mismatch(spark, sf_dir):
    df = ready(spark, sf_dir).withColumn("extent", values.extent_from_value(col("extent"), col("propvalue")))
    return df.select(
        "eventid", "extent", values.extent_mismatch(col("extent"), col("propvalue")).alias("mismatch_flag")
    )


@query(
    "clamp_casualties",
    A.over(
        "raw",
        """SELECT eventid, CASE WHEN nkillter > nkill THEN nkill ELSE nkillter END AS nkillter,
        CASE WHEN nwoundter > nwound THEN nwound ELSE nwoundter END AS nwoundter,
        CASE WHEN nkillus > nkill THEN nkill ELSE nkillus END AS nkillus,
        CASE WHEN nwoundus > nwound THEN nwound ELSE nwoundus END AS nwoundus,
        CASE WHEN nkillter > nkill OR nwoundter > nwound OR nkillus > nkill OR nwoundus > nwound
          OR (success = 0 AND nkill > 0) OR (success = 0 AND nwound > 0) THEN 1 ELSE 0 END AS inconsistent
        FROM renamed""",
        RENAMED,
    ),
)
def clamp_casualties(spark, sf_dir):
    df = renamed(spark, sf_dir).withColumn("inconsistent", values.flag(C.inconsistent_casualties()))
    return C.clamp_casualties(df).select(
        "eventid", "nkillter", "nwoundter", "nkillus", "nwoundus", "inconsistent"
    )


@query(
    "clip_ranges",
    A.over(
        "raw",
        """SELECT eventid, CASE WHEN latitude < -60 THEN -60 WHEN latitude > 60 THEN 60 ELSE latitude END AS latitude,
        CASE WHEN specificity < 2 THEN 2 WHEN specificity > 4 THEN 4 ELSE specificity END AS specificity,
        CASE WHEN property < -1 THEN -1 WHEN property > 1 THEN 1 ELSE property END AS property,
        CASE WHEN propvalue < 0 THEN 0 ELSE propvalue END AS propvalue FROM renamed""",
        RENAMED,
    ),
)
def clip_ranges(spark, sf_dir):
    ranges = {
        "latitude": (-60.0, 60.0), "specificity": (2, 4), "property": V.CLIP_RANGES["property"],
        "propvalue": (0.0, None),
    }
    return C.clip_columns(renamed(spark, sf_dir).select("eventid", *ranges), ranges)


@query(
    "cap_fixed",
    A.over(
        "raw",
        """SELECT count(*) FILTER (nkill < 0 OR nkill > 100) AS nkill_capped,
        count(*) FILTER (propvalue < 0) AS propvalue_capped,
        sum(CASE WHEN nkill < 0 THEN 0 WHEN nkill > 100 THEN 100 ELSE nkill END) AS nkill_sum,
        CAST(sum(CASE WHEN propvalue < 0 THEN 0 ELSE CAST(propvalue AS DECIMAL(15, 2)) END) AS DOUBLE) AS propvalue_sum FROM renamed""",
        RENAMED,
    ),
)
def cap_fixed(spark, sf_dir):
    df = renamed(spark, sf_dir).select("nkill", "propvalue")
    capped, counts = C.cap_fixed(df, {"nkill": (0.0, 100.0), "propvalue": (0.0, None)})
    exact = F.sum(col("propvalue").cast("decimal(15,2)")).cast("double")
    sums = capped.agg(F.sum("nkill").alias("nkill_sum"), exact.alias("propvalue_sum"))
    counted = counts.select(F.struct(*counts.columns)).scalar()
    return sums.select(*[counted[c].alias(c) for c in counts.columns], "nkill_sum", "propvalue_sum")


#: The columns whose outliers the cleaning lineages treat.
CAPPED = ["nkill", "nwound", "propvalue", "nkillus", "nwoundus"]
_IQR = (
    "\nbounds AS (SELECT "
    + ", ".join(f"quantile_cont({c}, 0.25) AS {c}_a, quantile_cont({c}, 0.75) AS {c}_b" for c in CAPPED)
    + " FROM prepared),\nlimits AS (SELECT "
    + ", ".join(f"{c}_a - 1.5 * ({c}_b - {c}_a) AS {c}_low, {c}_b + 1.5 * ({c}_b - {c}_a) AS {c}_high" for c in CAPPED)
    + " FROM bounds)"
)


def _outside(c: str) -> str:
    return f"coalesce({c} < {c}_low OR {c} > {c}_high, false)"


def counts(spark, sf_dir):
    return C.recode_sentinels(raw(spark, sf_dir)).select("eventid", *CAPPED)


@query(
    "cap_iqr",
    A.over(
        "prepared",
        "SELECT eventid, "
        + ", ".join(f"round(CASE WHEN {c} < {c}_low THEN {c}_low WHEN {c} > {c}_high THEN {c}_high ELSE {c} END, 4) AS {c}" for c in CAPPED)
        + " FROM prepared, limits",
        _IQR,
    ),
)
def cap_iqr(spark, sf_dir):
    return C.cap_iqr(counts(spark, sf_dir), CAPPED).withColumns({c: F.round(c, 4) for c in CAPPED})


@query(
    "detect_iqr_inlier_bounds",
    A.over(
        "prepared",
        "SELECT eventid, "
        + ", ".join(
            f"CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE {c} END AS {c},"
            f" CASE WHEN {_outside(c)} THEN 1 ELSE 0 END AS {c}_outlier"
            for c in CAPPED
        )
        + " FROM prepared, limits, (SELECT "
        + ", ".join(f"min({c}) FILTER (NOT {_outside(c)}) AS {c}_lo, max({c}) FILTER (NOT {_outside(c)}) AS {c}_hi" for c in CAPPED)
        + " FROM prepared, limits)",
        _IQR,
    ),
)
def detect_iqr_inlier_bounds(spark, sf_dir):
    return C.clip_to_inliers(C.iqr_outliers(counts(spark, sf_dir), CAPPED), CAPPED)


@query(
    "iqr_outlier_rows",
    A.over(
        "prepared",
        " UNION ALL ".join(
            f"SELECT eventid, '{c}' AS measure, CAST({c} AS DOUBLE) AS value FROM prepared, limits WHERE {_outside(c)}" for c in CAPPED
        ),
        _IQR,
    ),
)
def iqr_outlier_rows(spark, sf_dir):
    """The values that are clipped, set aside as they were."""
    return C.outlier_rows(C.iqr_outliers(counts(spark, sf_dir), CAPPED), "eventid", CAPPED)


@query(
    "lump_rare",
    """SELECT c_custkey, CASE WHEN n < 7 THEN 'other' ELSE balance_band END AS balance_band FROM (SELECT *, count(*) OVER
    (PARTITION BY balance_band) AS n FROM (SELECT c_custkey, 'band_' || CAST(floor(c_acctbal / 50) AS BIGINT) AS balance_band
    FROM customer))""",
)
def lump_rare(spark, sf_dir):
    band = F.concat(F.lit("band_"), F.floor(col("c_acctbal") / 50).cast("string"))
    df = tables.table(spark, sf_dir, "customer").select("c_custkey", band.alias("balance_band"))
    return C.lump_rare(df, "balance_band", least=7)


@query(
    "repair_hierarchy",
    A.over(
        "prepared",
        """SELECT eventid, country, CASE WHEN country <> 'unknown' AND canonical IS NOT NULL THEN canonical ELSE region END
        AS region FROM ready LEFT JOIN (SELECT lower(n_name) AS c, 'realm_' || n_regionkey AS canonical FROM nation
        WHERE n_nationkey % 3 <> 0) ON c = country""",
        READY,
    ),
)
def repair_hierarchy(spark, sf_dir):
    nation = tables.table(spark, sf_dir, "nation").where(col("n_nationkey") % 3 != 0)
    parents = nation.select(
        F.lower("n_name").alias("country"), F.concat(F.lit("realm_"), col("n_regionkey").cast("string")).alias("region")
    )
    df = ready(spark, sf_dir).select("eventid", "country", "region")
    return C.repair_hierarchy(df, parents, "country", "region")


ALLOWED = {"1-urgent": ["a", "unknown"], "2-high": ["n", "r", "unknown"], "3-medium": ["r", "unknown"], "5-low": ["a", "n"]}
_FIRST = "CASE attack_type WHEN '1-urgent' THEN 'a' WHEN '2-high' THEN 'n' WHEN '3-medium' THEN 'r' WHEN '5-low' THEN 'a' ELSE 'unknown' END"
_FITS = """CASE attack_type WHEN '1-urgent' THEN w IN ('a', 'unknown') WHEN '2-high' THEN w IN ('n', 'r', 'unknown')
 WHEN '3-medium' THEN w IN ('r', 'unknown') WHEN '5-low' THEN w IN ('a', 'n') ELSE w = 'unknown' END"""


@query(
    "impute_from_map",
    A.over(
        "prepared",
        f"SELECT eventid, attack_type, CASE WHEN weapon_type = 'unknown' THEN {_FIRST} ELSE weapon_type END AS weapon_type FROM ready",
        READY,
    ),
)
def impute_from_map(spark, sf_dir):
    df = ready(spark, sf_dir).select("eventid", "attack_type", "weapon_type")
    return C.default_from_map(df, "attack_type", "weapon_type", ALLOWED)


@query(
    "flag_pair_mismatch",
    A.over(
        "prepared",
        f"""SELECT eventid, CASE WHEN {_FITS} THEN w ELSE 'unknown' END AS weapon_type,
        CASE WHEN {_FITS} THEN 0 ELSE 1 END AS weapon_type_replaced,
        CASE WHEN attack_type = '5-low' AND NOT {_FITS} THEN 1 ELSE 0 END AS mismatch_flag
        FROM (SELECT *, weapon_type AS w FROM ready)""",
        READY,
    ),
)
def flag_pair_mismatch(spark, sf_dir):
    df = ready(spark, sf_dir).select("eventid", "attack_type", "weapon_type")
    return C.enforce_pairs(df, "attack_type", "weapon_type", ALLOWED, "mismatch_flag").drop("attack_type")


_CATEGORY = """CASE WHEN propvalue IS NULL OR propvalue <= 0 THEN 'None' WHEN propvalue <= 1000 THEN 'Low'
 WHEN propvalue <= 1000000 THEN 'Medium' WHEN propvalue <= 1000000000 THEN 'High' ELSE 'Catastrophic' END"""


@query(
    "bucket_value",
    A.over(
        "prepared",
        f"SELECT eventid, {_CATEGORY} AS propvalue_category FROM (SELECT eventid, {_BUCKET} AS propvalue FROM ready)",
        READY,
    ),
)
def bucket_value(spark, sf_dir):
    df = C.impute_by_bucket(ready(spark, sf_dir), EXTENT_VALUES, "propvalue_imputed")
    return df.select("eventid", values.value_category(col("propvalue")).alias("propvalue_category"))


@query(
    "histogram_bins",
    A.over(
        "prepared",
        f"""SELECT CASE WHEN v >= 0 AND v <= 1000 THEN '[0, 1000]' WHEN v > 1000 AND v <= 1000000 THEN '(1000, 1000000]'
        WHEN v > 1000000 AND v <= 1000000000 THEN '(1000000, 1000000000]' ELSE '(1000000000, inf]' END AS value_bin,
        count(*) AS row_count FROM (SELECT {_BUCKET} AS v FROM ready) WHERE v >= 0 GROUP BY 1""",
        READY,
    ),
)
def histogram_bins(spark, sf_dir):
    df = C.impute_by_bucket(ready(spark, sf_dir), EXTENT_VALUES, "propvalue_imputed")
    binned = df.select(values.bin_label(col("propvalue")).alias("value_bin")).where(col("value_bin").isNotNull())
    return binned.groupBy("value_bin").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "flag_high_impact",
    A.over(
        "prepared",
        f"""SELECT eventid, CASE WHEN coalesce(v >= 1000000, false) OR coalesce(nkill >= 100, false) THEN 1 ELSE 0 END
        AS high_impact FROM (SELECT *, {_BUCKET} AS v FROM ready)""",
        READY,
    ),
)
def flag_high_impact(spark, sf_dir):
    df = C.impute_by_bucket(ready(spark, sf_dir), EXTENT_VALUES, "propvalue_imputed")
    return df.select("eventid", values.high_impact(col("propvalue"), col("nkill")).alias("high_impact"))


@query(
    "flag_unknowns",
    A.over(
        "prepared",
        """SELECT eventid, CASE WHEN city = 'unknown' OR coalesce(latitude = 0 AND longitude = 0, false) THEN 1 ELSE 0 END
        AS unknown_location, CASE WHEN city = 'unknown' OR (latitude IS NULL AND longitude IS NULL) THEN 1 ELSE 0 END
        AS missing_location, CASE WHEN group_name = 'unknown' THEN 1 ELSE 0 END AS unknown_group,
        CASE WHEN group_name <> 'unknown' AND uncertainty = 1 THEN 1 ELSE 0 END AS uncertain_group FROM ready""",
        READY,
    ),
)
def flag_unknowns(spark, sf_dir):
    place = (col("city"), col("latitude"), col("longitude"))
    known = col("group_name") != "unknown"
    return ready(spark, sf_dir).select(
        "eventid",
        values.unknown_location_zero(*place).alias("unknown_location"),
        values.unknown_location_null(*place).alias("missing_location"),
        values.flag(~known).alias("unknown_group"),
        values.flag(known & (col("uncertainty") == 1)).alias("uncertain_group"),
    )


@query(
    "flag_consistency",
    A.over(
        "prepared",
        "SELECT eventid, CASE WHEN success = 0 AND nkill > 100 THEN 1 ELSE 0 END AS consistency_flag FROM ready",
        READY,
    ),
)
def flag_consistency(spark, sf_dir):
    df = ready(spark, sf_dir)
    return df.select("eventid", values.inconsistent_success(col("success"), col("nkill")).alias("consistency_flag"))


@query(
    "round_coords",
    A.over(
        "raw",
        """SELECT eventid, round(coalesce(CASE WHEN latitude < -90 THEN -90 WHEN latitude > 90 THEN 90 ELSE latitude END, 0), 4)
        AS latitude, round(coalesce(CASE WHEN longitude < -180 THEN -180 WHEN longitude > 180 THEN 180 ELSE longitude END, 0), 4)
        AS longitude FROM (SELECT eventid, latitude * 1.1234567 AS latitude, longitude * 1.07654321 AS longitude FROM raw)""",
    ),
)
def round_coords(spark, sf_dir):
    df = raw(spark, sf_dir).select(
        "eventid", (col("latitude") * 1.1234567).alias("latitude"), (col("longitude") * 1.07654321).alias("longitude")
    )
    return C.format_coords(df)


@query(
    "location_key",
    A.over(
        "prepared",
        """SELECT eventid, region || '|' || country || '|' || provstate || '|' || city || '|'
        || printf('%.3f', coalesce(latitude, 0.0)) || '|' || printf('%.3f', coalesce(longitude, 0.0)) AS location_key
        FROM ready""",
        READY,
    ),
)
def location_key(spark, sf_dir):
    df = C.format_coords(ready(spark, sf_dir), digits=3)
    parts = [col(c) for c in ("region", "country", "provstate", "city", "latitude", "longitude")]
    return df.select("eventid", text.location_key(*parts).alias("location_key"))


@query(
    "value_counts",
    A.over("prepared", "SELECT extent, count(*) AS row_count FROM ready GROUP BY extent", READY),
)
def value_counts(spark, sf_dir):
    return Q.value_counts(ready(spark, sf_dir), "extent")


_PROFILED = ["propvalue", "nkillus", "nwoundus", "property", "nkill", "nwound", "nkillter"]


@query(
    "profile_numeric",
    A.over(
        "prepared",
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS measure, count(*) FILTER ({c} > 0) AS positive, count(*) FILTER ({c} = 0) AS zero,
            count(*) FILTER ({c} < 0) AS negative, count(*) FILTER ({c} IS NULL) AS missing,
            round(avg({c}), 4) AS mean_value, CAST(max({c}) AS DOUBLE) AS max_value FROM ready"""
            for c in _PROFILED
        ),
        READY,
    ),
)
def profile_numeric(spark, sf_dir):
    df = C.rename(C.recode_sentinels(raw(spark, sf_dir)), LOADER_RENAMES)
    return Q.profile_numeric(df, _PROFILED).withColumn("mean_value", F.round("mean_value", 4))


@query(
    "distinct_dates",
    A.over(
        "raw",
        """SELECT (SELECT count(*) FROM (SELECT DISTINCT year, month, day FROM renamed)) AS dates,
        (SELECT count(*) FROM (SELECT DISTINCT year, month, day, extended FROM renamed)) AS dates_extended""",
        RENAMED,
    ),
)
def distinct_dates(spark, sf_dir):
    """Distinct tuples are counted from one shared distinct, not from two expanded copies of the rows."""
    wide = renamed(spark, sf_dir).groupBy("year", "month", "day", "extended").agg(F.count(F.lit(1)).alias("n"))
    narrow = wide.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("variants"))
    return narrow.agg(F.count(F.lit(1)).alias("dates"), F.sum("variants").alias("dates_extended"))


@query(
    "crosstab",
    A.over(
        "prepared",
        """SELECT property, count(*) FILTER (extent = 'minor') AS minor, count(*) FILTER (extent = 'major') AS major,
        count(*) FILTER (extent = 'catastrophic') AS catastrophic, count(*) FILTER (extent NOT IN ('minor', 'major', 'catastrophic') OR extent IS NULL) AS other
        FROM ready GROUP BY property""",
        READY,
    ),
)
def crosstab(spark, sf_dir):
    return Q.crosstab(ready(spark, sf_dir), "property", "extent", [*EXTENT_VALUES], rest="other")


@query(
    "head_batch",
    r"""SELECT doc_id, regexp_replace(replace(text, chr(10), ' '), '^\s+|\s+$', '', 'g') AS summary FROM documents
    WHERE text IS NOT NULL ORDER BY doc_id LIMIT 50""",
)
def head_batch(spark, sf_dir):
    first = first_rows(tables.table(spark, sf_dir, "documents").where(col("text").isNotNull()), [col("doc_id")], 50)
    return first.select("doc_id", text.one_line(col("text")).alias("summary"))
