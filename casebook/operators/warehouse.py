"""Normalised tables, dimensions with surrogate keys, and the fact load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from casebook.functions import values
from casebook.functions.text import location_key
from casebook.operators.ordering import dense_ids, first_per_key
from casebook.operators.quality import in_range, in_set
from casebook.session import materialize, merged_if_large

RECONCILED_COLUMNS = {
    "incidents": ["eventid", "year", "month", "day", "extended", "success"],
    "locations": [
        "eventid", "region", "country", "provstate", "city", "latitude", "longitude", "specificity",
        "vicinity", "unknown_location",
    ],
    "attacks": ["eventid", "attacktype1", "weaptype1", "weapsubtype1"],
    "targets": ["eventid", "targtype1", "targsubtype1", "nationality1"],
    "casualties": ["eventid", "nkill", "nwound", "nkillter", "nwoundter", "nkillus", "nwoundus"],
    "terroristgroups": ["eventid", "group_name", "uncertainty1", "unknown_group"],
    "properties": ["eventid", "propvalue", "extent", "property", "propvalue_category"],
}


def reconcile(cleaned: DataFrame, name: str) -> DataFrame:
    """One normalised table of the cleaned frame: distinct rows, those outside its domain left out."""
    columns = RECONCILED_COLUMNS[name]
    if name == "incidents" and "summary" in cleaned.columns:
        columns = [*columns, "summary"]
    part = cleaned.select(*columns).distinct()
    if name == "incidents":
        return part.where(
            in_range("year", 1970, 2017)
            & in_range("month", 1, 12)
            & in_range("day", 1, 31)
            & in_set("extended", [0, 1])
            & in_set("success", [0, 1])
        )
    if name == "locations":
        return part.where(
            in_range("latitude", -90, 90)
            & in_range("longitude", -180, 180)
            & in_range("specificity", 1, 5, null_ok=True)
            & in_set("vicinity", [0, 1], null_ok=True)
            & in_set("unknown_location", [0, 1])
        )
    if name == "casualties":
        return part.fillna(0)
    if name == "properties":
        part = part.withColumn("propvalue", F.col("propvalue").cast("decimal(15,2)"))
    return part.dropna(subset=columns[1:])


@dataclass(frozen=True)
class Dimension:
    """How one dimension is built and looked up."""

    table: str
    id_column: str
    source: str
    keys: Mapping[str, str]  # dimension column -> normalised table's column
    default: Mapping[str, object]

    @property
    def natural_key(self) -> list[str]:
        return list(self.keys)


DIMENSIONS = {
    d.table: d
    for d in (
        Dimension(
            "dim_time", "time_id", "incidents",
            {"year": "year", "month": "month", "day": "day", "extended": "extended"},
            {"year": 1970, "month": 1, "day": 1, "extended": 0},
        ),
        Dimension(
            "dim_location", "location_id", "locations",
            {
                "region": "region", "country": "country", "provstate": "provstate", "city": "city",
                "latitude": "latitude", "longitude": "longitude", "specificity": "specificity",
                "vicinity": "vicinity", "unknown_location_flag": "unknown_location",
            },
            {
                "region": "unknown", "country": "unknown", "provstate": "unknown", "city": "unknown",
                "latitude": 0.0, "longitude": 0.0, "specificity": 1, "vicinity": 0,
                "unknown_location_flag": 1,
            },
        ),
        Dimension(
            "dim_attacktype", "attack_type_id", "attacks",
            {"attack_type": "attacktype1", "weapon_type": "weaptype1", "weapon_subtype": "weapsubtype1"},
            {"attack_type": "unknown", "weapon_type": "unknown", "weapon_subtype": "unknown"},
        ),
        Dimension(
            "dim_targettype", "target_type_id", "targets",
            {"target_type": "targtype1", "target_subtype": "targsubtype1", "nationality": "nationality1"},
            {"target_type": "unknown", "target_subtype": "unknown", "nationality": "unknown"},
        ),
        Dimension(
            "dim_terroristgroup", "group_id", "terroristgroups",
            {"group_name": "group_name", "uncertainty": "uncertainty1", "unknown_group_flag": "unknown_group"},
            {"group_name": "unknown", "uncertainty": 0, "unknown_group_flag": 1},
        ),
        Dimension(
            "dim_propertydamage", "property_id", "properties",
            {"extent": "extent", "property": "property", "propvalue_category": "propvalue_category"},
            {"extent": "unknown", "property": 0, "propvalue_category": "unknown"},
        ),
    )
}

DEFAULT_ID = 1


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Equality on all pairs in which NULL equals NULL.

    A hash of all parts goes first, where their types agree: a merge join then sorts by one number.
    """
    condition = F.lit(True)
    mine, theirs = [m for m, _ in pairs], [t for _, t in pairs]
    if [left.schema[m].dataType for m in mine] == [right.schema[t].dataType for t in theirs]:
        condition = F.xxhash64(*[left[m] for m in mine]) == F.xxhash64(*[right[t] for t in theirs])
    for m, t in pairs:
        condition = condition & left[m].eqNullSafe(right[t])
    return condition


def build_dimension(source: DataFrame, dim: Dimension) -> DataFrame:
    """The default member as id 1, then every other distinct member from 2 in natural key order."""
    types = dict(source.dtypes)
    members = source.select(*[F.col(c).alias(k) for k, c in dim.keys.items()]).distinct()
    is_default = F.lit(True)
    for column, value in dim.default.items():
        is_default = is_default & F.col(column).eqNullSafe(F.lit(value))
    numbered = dense_ids(members.where(~is_default), dim.id_column, dim.natural_key, first=DEFAULT_ID + 1)
    default = source.sparkSession.range(1).select(
        F.lit(DEFAULT_ID).cast("long").alias(dim.id_column),
        *[F.lit(v).cast(types[dim.keys[k]]).alias(k) for k, v in dim.default.items()],
    )
    return default.unionByName(numbered)


def lookup_ids(df: DataFrame, dim_frame: DataFrame, dim: Dimension) -> DataFrame:
    """Add the dimension's id by natural key; unmatched rows take the default member.

    A dimension of few rows may be broadcast, one of many is merged, and adaptive
    execution splits its hot keys. Of members with equal keys the smallest id counts.
    """
    named = [F.col(k).alias(f"_{dim.table}_{k}") for k in dim.natural_key]
    keys = merged_if_large(dim_frame.groupBy(*named).agg(F.min(dim.id_column).alias(dim.id_column)), dim_frame)
    pairs = [(column, f"_{dim.table}_{k}") for k, column in dim.keys.items()]
    joined = df.join(keys, null_safe(df, keys, pairs), "left").drop(*[theirs for _, theirs in pairs])
    return joined.withColumn(dim.id_column, F.coalesce(dim.id_column, F.lit(DEFAULT_ID)))


MEASURES = ["nkill", "nwound", "nkillter", "nwoundter", "nkillus", "nwoundus"]
FACT_FLAGS = ["success", "propvalue_imputed", "us_casualty_imputed", "high_impact"]


def load_fact(cleaned: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Look up all six ids, check domains, keep one row per event: the first in order of its columns.

    Rows are ranked only if some event stands twice in ``cleaned``, as no look-up repeats a row.
    """
    repeated = cleaned.where(F.col("eventid").isNotNull()).groupBy("eventid").count().where("count > 1")
    keyed = cleaned
    for name, dim in DIMENSIONS.items():
        keyed = lookup_ids(keyed, dimensions[name], dim)
    fact = keyed.select(
        "eventid",
        *[d.id_column for d in DIMENSIONS.values()],
        *[F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(m) for m in MEASURES],
        "propvalue",
        *FACT_FLAGS,
        F.lit(0).alias("consistency_flag"),
    )
    domain = F.lit(True)
    for m in MEASURES:
        domain = domain & (F.col(m) >= 0)
    for c in FACT_FLAGS:
        domain = domain & in_set(c, [0, 1])
    valid = fact.where(domain & F.col("eventid").isNotNull())
    one = valid if repeated.isEmpty() else first_per_key(valid, ["eventid"], [F.col(c) for c in valid.columns[1:]])
    return one.withColumn("total_casualties", F.col("nkill") + F.col("nwound"))


def star_flat(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """The fact with every dimension's columns; an unmatched id leaves NULLs."""
    flat = fact
    for name, dim in DIMENSIONS.items():
        flat = flat.join(merged_if_large(dimensions[name]), dim.id_column, "left")
    return flat.drop(*[d.id_column for d in DIMENSIONS.values()])


def lookup_min_id(
    df: DataFrame, dim_frame: DataFrame, id_column: str, on: Sequence[str]
) -> DataFrame:
    """Lookup on part of a key: the smallest id per key, so no row fans out."""
    smallest = dim_frame.groupBy(*on).agg(F.min(id_column).alias(id_column))
    renamed = merged_if_large(smallest.select(id_column, *[F.col(c).alias(f"_{c}") for c in on]), dim_frame)
    pairs = [(c, f"_{c}") for c in on]
    return df.join(renamed, null_safe(df, renamed, pairs), "left").drop(*[theirs for _, theirs in pairs])


FULL_PLACE = ["region", "country", "provstate", "city", "latitude", "longitude"]
NAMED_PLACE = ["region", "country", "provstate", "city"]
PLACE_DETAILS = ["specificity", "vicinity", "unknown_location_flag"]


def with_location_key(df: DataFrame) -> DataFrame:
    return df.withColumn("location_key", location_key(*[F.col(c) for c in FULL_PLACE]))


def late_members(
    df: DataFrame, dim_frame: DataFrame, id_column: str, natural_key: Sequence[str], more: Sequence[str] = ()
) -> DataFrame:
    """Distinct members of ``df`` the dimension lacks, numbered after its largest id.

    ``more`` are further columns of the dimension; of several values of a member the first in order stays.
    """
    if more:
        # Distinct rows first: a minimum of structs sorts what it reads. Members and details read the stored result.
        first = df.select(*natural_key, *more).distinct().groupBy(*natural_key).agg(F.min(F.struct(*more)).alias("_first"))
        first = materialize(first, "first_details")
        details = first.select(*[F.col(c).alias(f"_of_{c}") for c in natural_key], "_first.*")
        found = late_members(first, dim_frame, id_column, natural_key)
        same = null_safe(found, details, [(c, f"_of_{c}") for c in natural_key])
        return found.join(merged_if_large(details, first), same).select(id_column, *natural_key, *more)
    members = df.select(*natural_key).distinct()
    known = merged_if_large(dim_frame.select(*[F.col(c).alias(f"_{c}") for c in natural_key]).distinct(), dim_frame)
    pairs = [(c, f"_{c}") for c in natural_key]
    missing = members.join(known, null_safe(members, known, pairs), "left_anti")
    largest = dim_frame.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    numbered = dense_ids(missing, "_n", natural_key)
    return numbered.select((F.col("_n") + largest).alias(id_column), *natural_key)


def resolve_location(events: DataFrame, dim_location: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Find a location id step by step: full place, named place, location key, then new members.

    Returns (events with location_id and the step that found it, the new members).
    Every step joins ids already reduced to one per key, so no event is repeated.
    New members come from the distinct places of the events, not from all events.
    """
    dim = with_location_key(dim_location)
    steps = {"full": FULL_PLACE, "named": NAMED_PLACE, "key": ["location_key"]}

    def stepped(df: DataFrame) -> DataFrame:
        out = with_location_key(df)
        for step, on in steps.items():
            out = lookup_min_id(out, dim.select("location_id", *on), "location_id", on)
            out = out.withColumnRenamed("location_id", f"_{step}_id")
        return out

    found = F.coalesce(*[F.col(f"_{s}_id") for s in steps])
    details = [c for c in PLACE_DETAILS if c in events.columns]
    missed = stepped(events.select(*FULL_PLACE, *details).distinct()).where(found.isNull())
    new = materialize(late_members(missed, dim_location, "location_id", FULL_PLACE, details), "new_places")
    out = stepped(events)
    out = lookup_min_id(out, new.select("location_id", *FULL_PLACE), "location_id", FULL_PLACE)
    step_name = F.lit("new")
    for step in reversed(list(steps)):
        step_name = F.when(F.col(f"_{step}_id").isNotNull(), step).otherwise(step_name)
    resolved = out.withColumns(
        {"location_id": F.coalesce(found, F.col("location_id")), "resolved_by": step_name}
    ).drop(*[f"_{s}_id" for s in steps])
    return resolved, new


def dedupe_members(df: DataFrame, id_column: str, natural_key: Sequence[str]) -> DataFrame:
    """Of members with equal keys keep the smallest id; members with a NULL key part all stay."""
    whole = F.lit(True)
    for c in natural_key:
        whole = whole & F.col(c).isNotNull()
    return first_per_key(df.where(whole), natural_key, [F.col(id_column)]).unionByName(df.where(~whole))


def simulate_fact(df: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    """Number the distinct places, look them up again and report what a load would show."""
    dim = dense_ids(df, "member_id", natural_key)
    looked = lookup_min_id(df.select(*natural_key), dim, "member_id", natural_key)
    return looked.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_if(F.col("member_id").isNull()).alias("missing_ids"),
        F.count_distinct("member_id").alias("members"),
        F.min("member_id").alias("min_id"),
        F.max("member_id").alias("max_id"),
    )
