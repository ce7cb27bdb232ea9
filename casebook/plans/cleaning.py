"""The batch cleaning plan: raw incidents to the cleaned table and its rejected rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from casebook.functions import fixed_values as V, values
from casebook.operators import cleaning as C
from casebook.session import materialize

TEXT_COLUMNS = [
    "region_txt", "country_txt", "provstate", "city", "propextent_txt", "attacktype1_txt", "weaptype1_txt",
    "weapsubtype1_txt", "targtype1_txt", "targsubtype1_txt", "natlty1_txt", "gname", "summary", "propcomment",
]
BLANK_TEXT = ["summary", "propcomment"]

KEPT_COLUMNS = [
    "eventid", "iyear", "imonth", "iday", "extended", "success", "nkill", "nwound", "nkillter", "nwoundter",
    "propvalue", "propextent_txt", "property", "region_txt", "country_txt", "provstate", "city", "latitude",
    "longitude", "specificity", "vicinity", "attacktype1_txt", "weaptype1_txt", "weapsubtype1_txt",
    "targtype1_txt", "targsubtype1_txt", "natlty1_txt", "gname", "guncertain1", "nkillus", "nwoundus",
    "summary", "us_casualty_imputed",
]

RENAMES = {
    "eventid": "event_id", "iyear": "year", "imonth": "month", "iday": "day", "propextent_txt": "extent",
    "region_txt": "region", "country_txt": "country", "attacktype1_txt": "attacktype1",
    "weaptype1_txt": "weaptype1", "weapsubtype1_txt": "weapsubtype1", "targtype1_txt": "targtype1",
    "targsubtype1_txt": "targsubtype1", "natlty1_txt": "nationality1", "gname": "group_name",
    "guncertain1": "uncertainty1",
}

# The names the second cleaning lineage uses for the same columns.
LOADER_RENAMES = {
    **RENAMES, "eventid": "eventid", "attacktype1_txt": "attack_type", "weaptype1_txt": "weapon_type",
    "weapsubtype1_txt": "weapon_subtype", "targtype1_txt": "target_type", "targsubtype1_txt": "target_subtype",
    "natlty1_txt": "nationality", "guncertain1": "uncertainty", "gsubname": "subgroup_name",
}

INTEGERS = [
    "year", "month", "day", "extended", "success", "nkill", "nwound", "nkillter", "nwoundter", "property",
    "specificity", "vicinity", "uncertainty1", "propvalue_imputed", "us_casualty_imputed", "high_impact",
]


@dataclass(frozen=True)
class CleaningRules:
    """What a data set brings: its lists, its rule tables and its sampling order."""

    country: str = "united states"
    attack_types: Sequence[str] = field(default_factory=lambda: V.ATTACK_TYPES)
    extent_values: Mapping[str, float] = field(default_factory=lambda: V.EXTENT_VALUES)
    centroids: DataFrame | None = None  # (country, centroid_lat, centroid_lon)
    sample_cap: int = V.UNKNOWN_EXTENT_CAP
    sample_seed: int | None = 42  # None samples the smallest keys
    sample_cut: tuple[str, int] | None = None  # (hash, key) of the sample's last row, for loads in parts


def damage_without_value() -> Column:
    return values.true_only((F.col("property") == 1) & F.col("propvalue").isNull())


def in_country(country: str) -> Column:
    return values.true_only((F.col("natlty1_txt") == country) | (F.col("country_txt") == country))


def subcount_discrepancy(country: str) -> Column:
    """Sub-count 0 although the incident has casualties."""
    casualties = values.true_only(F.col("nkill") > 0) | values.true_only(F.col("nwound") > 0)
    none = values.true_only(F.col("nkillus") == 0) | values.true_only(F.col("nwoundus") == 0)
    return in_country(country) & none & casualties


def prepared(raw: DataFrame) -> DataFrame:
    """Text normalised, sentinels recoded, columns unified, text filled."""
    df = C.normalize_columns(raw, TEXT_COLUMNS)
    df = C.recode_sentinels(df)
    df = C.unify_column(df, ["nwoundte", "nwoundter"], "nwoundter", 0.0)
    return C.fill_missing(
        df, unknown=[c for c in TEXT_COLUMNS if c not in BLANK_TEXT], blank=BLANK_TEXT
    )


def one_per_event(raw: DataFrame, rules: CleaningRules) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Prepared rows with a key and a date, one per event, before values are imputed; and the rejected ones."""
    df = prepared(raw)
    suspects = {
        "damage_without_value": df.where(damage_without_value()),
        "subcount_discrepancy": df.where(subcount_discrepancy(rules.country)),
    }
    df = C.impute_partial_counts(
        df, in_country(rules.country), {"nkillus": "nkill", "nwoundus": "nwound"}, "us_casualty_imputed"
    )
    df = C.rename(C.select_existing(df, KEPT_COLUMNS), RENAMES)
    missing_keys = df.where(F.col("event_id").isNull())
    dates_first = sorted(df.columns, key=lambda c: c not in ("year", "month", "day"))
    total_order = [F.col(c).asc_nulls_last() for c in dates_first if c != "event_id"]
    df = C.dedupe_keep_first(df.where(F.col("event_id").isNotNull()), ["event_id"], total_order)
    df, zero_dates = C.drop_zero_dates(df)
    return df, {**suspects, "missing_key": missing_keys, "zero_date": zero_dates}


def clean(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(cleaned rows, rejected or suspect rows by reason).

    Without the sample's cut a pass looks for it first, so what this and the last pass read is stored.
    """
    df, rejected = one_per_event(raw, rules)
    if rules.sample_cut is None:
        df = materialize(df, "one_per_event")
    df = impute_property_values(df, rules)
    df = df.withColumn("propvalue_category", values.value_category(F.col("propvalue")))
    df = C.fill_missing(df, zero=["nkill", "nwound", "nkillter", "nwoundter", "nkillus", "nwoundus", "property"])
    df = C.align_property(df)
    df = df.withColumn("high_impact", values.high_impact(F.col("propvalue"), F.col("nkill")))
    df = df.withColumns({c: values.whole_number(F.col(c)) for c in INTEGERS})

    df = C.format_coords(df)
    if rules.centroids is not None:
        df = C.impute_centroid(df, rules.centroids)
    df = df.withColumn("attacktype1", values.known_or_unknown(F.col("attacktype1"), rules.attack_types))
    df = C.clip_columns(
        df,
        {
            **dict.fromkeys(["nkill", "nwound", "propvalue"], (0, None)),
            **dict.fromkeys(["nkillus", "nwoundus"], (0, V.SUBCOUNT_CAP)),
        },
    )
    df = df.withColumns(
        {
            "unknown_location": values.unknown_location_zero(
                F.col("city"), F.col("latitude"), F.col("longitude")
            ),
            "unknown_group": values.flag(F.col("group_name") == "unknown"),
        }
    )
    return df, rejected


def impute_property_values(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Value by extent, then a capped share of the rows whose extent is unknown.

    Both read the same condition on the input value, and their extents are
    disjoint, so the second step cannot see the first one's result.
    """
    df = C.impute_by_bucket(df, rules.extent_values, "propvalue_imputed")
    cut = None
    if rules.sample_cut is not None:
        cut = F.struct(F.lit(rules.sample_cut[0]).alias("o"), F.lit(rules.sample_cut[1]).cast("long").alias("k"))
    return C.impute_capped_sample(
        df, "event_id", "propvalue_imputed", rules.sample_cap, V.UNKNOWN_EXTENT_VALUE, rules.sample_seed, cut
    )


def sample_cut(raw: DataFrame, rules: CleaningRules) -> tuple[str, int] | None:
    """The last row of the capped sample over all of ``raw``: what a load of it in parts needs as ``sample_cut``."""
    # Few events have a row that may be sampled; only their rows are prepared in full and ranked.
    parts = C.select_existing(raw, ["eventid", "property", "propvalue", "propextent_txt"])
    some = C.impute_by_bucket(C.rename(prepared(parts), RENAMES), rules.extent_values, "propvalue_imputed")
    events = some.where(C.in_sample()).select(F.col("event_id").alias("_event")).distinct().hint("merge")
    needy = raw.join(events, raw["eventid"] == events["_event"], "left_semi")
    df = C.impute_by_bucket(one_per_event(needy, rules)[0], rules.extent_values, "propvalue_imputed")
    cut = C.sample_cut(df, "event_id", rules.sample_cap, rules.sample_seed).first()["cut"]
    return None if cut is None else (cut["o"], cut["k"])
