"""Cleaning and repair operators: frames in, frames out, no side effects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casebook.functions import dates, fixed_values as V, geo, text, values
from casebook.operators.ordering import as_one_row, exact_quantiles, first_per_key

UNKNOWN = "unknown"


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that are there, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def unify_column(df: DataFrame, names: Sequence[str], target: str, default) -> DataFrame:
    """Rename the first column whose name matches, case ignored; add a constant when none does."""
    lowered = {c.lower(): c for c in reversed(df.columns)}
    for name in names:
        if name.lower() in lowered:
            return df.withColumnRenamed(lowered[name.lower()], target)
    return df.withColumn(target, F.lit(default))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def normalize_columns(
    df: DataFrame,
    columns: Sequence[str],
    aliases: Mapping[str, str] = V.TEXT_ALIASES,
    cut_at_comma: bool = False,
) -> DataFrame:
    """Squeeze each column and look its aliases up.

    The columns pass through one array, so a single expression serves all of
    them: the generated code stays small enough to be compiled, and the lookup
    reads the squeezed value instead of computing it again.
    """
    there = [c for c in columns if c in df.columns]
    if not there:
        return df
    squeeze = text.squeeze_comma if cut_at_comma else text.squeeze
    squeezed = F.transform(F.array(*there), squeeze)
    looked_up = df.withColumn("_texts", F.transform(squeezed, lambda value: text.relabel(value, aliases)))
    return looked_up.withColumns({c: F.col("_texts")[i] for i, c in enumerate(there)}).drop("_texts")


def lower_all_text(df: DataFrame) -> DataFrame:
    strings = [c for c, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: F.lower(c) for c in strings})


def fill_missing(
    df: DataFrame, unknown: Sequence[str] = (), blank: Sequence[str] = (), zero: Sequence[str] = ()
) -> DataFrame:
    fills = {**dict.fromkeys(unknown, UNKNOWN), **dict.fromkeys(blank, ""), **dict.fromkeys(zero, 0)}
    return df.fillna({c: v for c, v in fills.items() if c in df.columns})


def recode_sentinels(df: DataFrame) -> DataFrame:
    """Value -99 becomes NULL, property -9 becomes -1."""
    return df.withColumns(
        {
            "propvalue": values.sentinel_to_null(F.col("propvalue"), -99),
            "property": values.recode(F.col("property"), -9, -1),
        }
    )


def impute_partial_counts(
    df: DataFrame, condition: Column, pairs: Mapping[str, str], flag: str
) -> DataFrame:
    """Absent sub-counts of matching rows become half of the total; all pairs share one flag.

    Conditions read the input columns, so one imputation cannot trigger another.
    """
    new, any_hit = {}, F.lit(False)
    for part, total in pairs.items():
        estimate, absent = values.imputed_part(F.col(part), F.col(total))
        hit = values.true_only(condition & absent)
        new[part] = F.when(hit, estimate).otherwise(F.col(part))
        any_hit = any_hit | hit
    return df.withColumns({**new, flag: any_hit.cast("int")})


def needs_value() -> Column:
    """Damage reported, but no positive value."""
    return values.true_only(
        (F.col("property") == 1) & (F.col("propvalue").isNull() | (F.col("propvalue") <= 0))
    )


def impute_by_bucket(df: DataFrame, table: Mapping[str, float], flag: str) -> DataFrame:
    estimate = values.bucket_value(F.col("extent"), table)
    hit = needs_value() & estimate.isNotNull()
    return df.withColumns(
        {"propvalue": F.when(hit, estimate).otherwise(F.col("propvalue")), flag: hit.cast("int")}
    )


def sample_place(key: str, seed: int | None) -> Column:
    """Where a row stands in the sample's order: by a seeded hash of its key, or by key without a seed."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))) if seed is not None else F.col(key)
    return F.struct(order.alias("o"), F.col(key).alias("k"))


def in_sample() -> Column:
    return needs_value() & (F.col("extent") == UNKNOWN)


def sample_cut(df: DataFrame, key: str, cap: int, seed: int | None = 42) -> DataFrame:
    """One row with the last place ``cut`` of the capped sample; NULL without needy rows."""
    places = df.where(in_sample()).select(sample_place(key, seed).alias("place"))
    return places.orderBy("place").limit(cap).agg(F.max("place").alias("cut"))


def impute_capped_sample(
    df: DataFrame, key: str, flag: str, cap: int, value: float, seed: int | None = 42, cut: Column | None = None
) -> DataFrame:
    """At most ``cap`` needy rows of unknown extent get a value: the first by a seeded hash, or by key
    when no seed is given.

    The cut is one scalar found by a top-``cap`` pass over two columns; no join
    follows. A load in parts brings the ``cut`` of the whole, which no part knows.
    """
    cut = sample_cut(df, key, cap, seed).scalar() if cut is None else cut
    hit = values.true_only(in_sample() & (sample_place(key, seed) <= cut))
    kept = F.col(flag) if flag in df.columns else F.lit(0)
    return df.withColumns(
        {
            "propvalue": F.when(hit, value).otherwise(F.col("propvalue")),
            flag: F.when(hit, 1).otherwise(kept),
        }
    )


def drop_zero_dates(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows kept, rows rejected)."""
    zero = dates.has_zero_part(F.col("year"), F.col("month"), F.col("day"))
    return df.where(~zero), df.where(zero)


def impute_dates(df: DataFrame) -> DataFrame:
    """Month 0 and day 0 become 1.

    ``ambiguous_date_flag`` marks every first of January once any row was
    ambiguous; ``date_imputed_flag`` marks only the rows that were changed.
    """
    changed = values.true_only((F.col("month") == 0) | (F.col("day") == 0))
    any_changed = df.agg(F.coalesce(F.bool_or(changed), F.lit(False))).scalar()
    month = F.when(F.col("month") == 0, 1).otherwise(F.col("month"))
    day = F.when(F.col("day") == 0, 1).otherwise(F.col("day"))
    return df.withColumns(
        {
            "month": month,
            "day": day,
            "ambiguous_date_flag": values.flag(any_changed & (month == 1) & (day == 1)),
            "date_imputed_flag": changed.cast("int"),
        }
    )


def dedupe_keep_first(df: DataFrame, key: Sequence[str], tiebreak: Sequence[Column]) -> DataFrame:
    return first_per_key(df, key, tiebreak)


def align_property(df: DataFrame) -> DataFrame:
    aligned = F.when(F.col("extent") == UNKNOWN, -1).otherwise(F.col("property"))
    return df.withColumn("property", aligned)


def repair_values(df: DataFrame) -> DataFrame:
    """Negative value to 0; no reported damage means value 0; unknown extent means property -1."""
    positive = F.when(F.col("propvalue") < 0, 0.0).otherwise(F.col("propvalue"))
    repaired = F.when((F.col("property") == -1) & (positive > 0), 0.0).otherwise(positive)
    return align_property(df.withColumn("propvalue", repaired))


CASUALTY_PAIRS = {"nkillter": "nkill", "nwoundter": "nwound", "nkillus": "nkill", "nwoundus": "nwound"}


def inconsistent_casualties(pairs: Mapping[str, str] = CASUALTY_PAIRS) -> Column:
    """A part exceeds its total, or a failed incident has casualties."""
    bad = F.lit(False)
    for part, total in pairs.items():
        bad = bad | values.true_only(F.col(part) > F.col(total))
    for total in dict.fromkeys(pairs.values()):
        bad = bad | values.true_only((F.col("success") == 0) & (F.col(total) > 0))
    return bad


def clamp_casualties(df: DataFrame, pairs: Mapping[str, str] = CASUALTY_PAIRS) -> DataFrame:
    return df.withColumns({part: values.clip(F.col(part), high=F.col(total)) for part, total in pairs.items()})


def clip_columns(df: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    return df.withColumns({c: values.clip(F.col(c), *bounds) for c, bounds in ranges.items()})


def cap_fixed(df: DataFrame, ranges: Mapping[str, tuple]) -> tuple[DataFrame, DataFrame]:
    """(capped frame, one row of how many values each column had outside)."""
    outside = []
    for c, (low, high) in ranges.items():
        beyond = F.lit(False)
        if low is not None:
            beyond = beyond | values.true_only(F.col(c) < low)
        if high is not None:
            beyond = beyond | values.true_only(F.col(c) > high)
        outside.append(F.count_if(beyond).alias(f"{c}_capped"))
    return clip_columns(df, ranges), df.agg(*outside)


def iqr_bounds(df: DataFrame, columns: Sequence[str], width: float = 1.5) -> DataFrame:
    """(measure, low, high) per column: the quartiles widened by 1.5 interquartile ranges."""
    spread = F.col("q3") - F.col("q1")
    return exact_quantiles(df, columns, {"q1": 0.25, "q3": 0.75}).select(
        "measure", (F.col("q1") - width * spread).alias("low"), (F.col("q3") + width * spread).alias("high")
    )


def cap_iqr(df: DataFrame, columns: Sequence[str], width: float = 1.5) -> DataFrame:
    bounds = as_one_row(iqr_bounds(df, columns, width), columns, ["low", "high"])
    return df.withColumns(
        {c: values.clip(F.col(c), bounds[f"{c}_low"], bounds[f"{c}_high"]) for c in columns}
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str], width: float = 1.5) -> DataFrame:
    """The input with a flag ``<column>_outlier`` for each column."""
    bounds = as_one_row(iqr_bounds(df, columns, width), columns, ["low", "high"])
    outlier = {c: (F.col(c) < bounds[f"{c}_low"]) | (F.col(c) > bounds[f"{c}_high"]) for c in columns}
    return df.withColumns({f"{c}_outlier": values.flag(values.true_only(o)) for c, o in outlier.items()})


def outlier_rows(flagged: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, measure, value): one row per outlying value of a flagged frame, as it was found."""
    cells = [
        F.when(F.col(f"{c}_outlier") == 1, F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")))
        for c in columns
    ]
    return flagged.select(key, F.inline(F.array_compact(F.array(*cells))))


def clip_to_inliers(flagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Outlying values of a flagged frame become the smallest or largest value that is none."""
    inside = {c: F.when(F.col(f"{c}_outlier") == 0, F.col(c)) for c in columns}
    ends = flagged.agg(
        *[F.min(v).alias(f"{c}_low") for c, v in inside.items()], *[F.max(v).alias(f"{c}_high") for c, v in inside.items()]
    )
    inner = ends.select(F.struct(*ends.columns)).scalar()
    return flagged.withColumns({c: values.clip(F.col(c), inner[f"{c}_low"], inner[f"{c}_high"]) for c in columns})


def detect_iqr(df: DataFrame, columns: Sequence[str], width: float = 1.5) -> tuple[DataFrame, DataFrame]:
    """(clipped to the smallest and largest inlier plus outlier flags, outlier rows)."""
    flagged = iqr_outliers(df, columns, width)
    any_outlier = F.greatest(*[F.col(f"{c}_outlier") for c in columns], F.lit(0)) == 1
    return clip_to_inliers(flagged, columns), flagged.where(any_outlier).select(*df.columns)


def format_coords(df: DataFrame, digits: int = 4, null_as_zero: bool = True) -> DataFrame:
    """Clip to the globe and round."""
    clipped = {"latitude": (-90.0, 90.0), "longitude": (-180.0, 180.0)}
    return df.withColumns(
        {
            c: values.round_coord(values.clip(F.col(c), low, high), digits, null_as_zero)
            for c, (low, high) in clipped.items()
        }
    )


def coords_absent(latitude: Column, longitude: Column) -> Column:
    return latitude.isNull() | longitude.isNull() | ((latitude == 0) & (longitude == 0))


def impute_centroid(df: DataFrame, centroids: DataFrame, digits: int = 4) -> DataFrame:
    """Absent coordinates become the country's centroid, else (0, 0).

    ``centroids`` holds (country, centroid_lat, centroid_lon), one row per country.
    """
    absent = coords_absent(F.col("latitude"), F.col("longitude"))
    return (
        df.join(centroids, "country", "left")
        .withColumns(
            {
                c: F.when(absent, F.coalesce(F.round(centroid, digits), F.lit(0.0))).otherwise(
                    F.round(F.col(c), digits)
                )
                for c, centroid in (("latitude", F.col("centroid_lat")), ("longitude", F.col("centroid_lon")))
            }
        )
        .select(*df.columns)
    )


def impute_centroid_levels(df: DataFrame, levels: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Absent coordinates from the first level that knows the place, else (0, 0).

    Each level is (column, table of (column, lat, lon)), e.g. city, country, region.
    """
    out, found = df, F.lit(None)
    for i, (column, rule) in enumerate(levels):
        _, lat, lon = rule.columns
        point = F.struct(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
        out = out.join(rule.select(column, point.alias(f"_point{i}")), column, "left")
        found = F.coalesce(found, F.col(f"_point{i}")) if i else F.col(f"_point{i}")
    absent = coords_absent(F.col("latitude"), F.col("longitude"))
    placed = {
        c: F.when(absent, F.coalesce(found[part], F.lit(0.0))).otherwise(F.col(c))
        for c, part in (("latitude", "lat"), ("longitude", "lon"))
    }
    return out.withColumns(placed).select(*df.columns)


def geo_consistency(
    df: DataFrame,
    centroids: DataFrame,
    sizes: Mapping[str, float] = V.COUNTRY_SIZES_KM,
    default_km: float = V.DEFAULT_COUNTRY_SIZE_KM,
) -> DataFrame:
    """Null coordinates farther from the country's centroid than the country's size; flag them."""
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    somewhere = placed & ((F.col("latitude") != 0) | (F.col("longitude") != 0))
    distance = F.when(
        somewhere,
        geo.ellipsoid_km(F.col("latitude"), F.col("longitude"), F.col("centroid_lat"), F.col("centroid_lon")),
    )
    limit = F.coalesce(text.lookup(F.col("country"), sizes).cast("double"), F.lit(float(default_km)))
    far = values.true_only(F.col("distance_km") > limit)
    return (
        df.join(centroids, "country", "left")
        .withColumn("distance_km", distance)
        .withColumns(
            {
                "latitude": F.when(~far, F.col("latitude")),
                "longitude": F.when(~far, F.col("longitude")),
                "geo_inconsistent_flag": far.cast("int"),
            }
        )
        .select(*df.columns, "distance_km", "geo_inconsistent_flag")
    )


def city_centroids(df: DataFrame) -> DataFrame:
    """Mean position of every known city over its rows with both coordinates away from 0."""
    valid = (F.col("latitude") != 0) & (F.col("longitude") != 0) & (F.col("city") != UNKNOWN)
    return df.where(valid).groupBy("city").agg(
        F.avg("latitude").alias("city_lat"), F.avg("longitude").alias("city_lon")
    )


def repair_hierarchy(df: DataFrame, parents: DataFrame, child: str, parent: str) -> DataFrame:
    """Overwrite the parent with the canonical one; rows of an unknown child stay as they are."""
    canonical = parents.select(F.col(child), F.col(parent).alias("_canonical"))
    repaired = F.when(F.col(child) != UNKNOWN, F.coalesce("_canonical", parent)).otherwise(F.col(parent))
    return df.join(canonical, child, "left").withColumn(parent, repaired).select(*df.columns)


def default_from_map(df: DataFrame, key: str, value: str, table: Mapping[str, Sequence[str]]) -> DataFrame:
    """An unknown value becomes the first one its key allows."""
    first = F.element_at(values.allowed_values(F.col(key), table), 1)
    return df.withColumn(value, F.when(F.col(value) == UNKNOWN, first).otherwise(F.col(value)))


def enforce_pairs(
    df: DataFrame, key: str, value: str, table: Mapping[str, Sequence[str]], flag: str | None = None
) -> DataFrame:
    """A value its key does not allow becomes 'unknown'.

    The flag is taken after the repair, so it marks rows whose key does not
    allow even 'unknown'; ``<value>_replaced`` marks the rows that changed.
    """
    allowed = values.allowed_values(F.col(key), table)
    fits = F.array_contains(allowed, F.col(value))
    repaired = F.when(fits, F.col(value)).otherwise(F.lit(UNKNOWN))
    out = {value: repaired, f"{value}_replaced": (~fits).cast("int")}
    if flag:
        out[flag] = (~F.array_contains(allowed, repaired)).cast("int")
    return df.withColumns(out)


def group_from_text(
    df: DataFrame,
    phrases: Mapping[str, str] = V.GROUP_ALIASES,
    after_first: Mapping[str, str] | None = V.GROUP_NAMES_IN_TEXT,
) -> DataFrame:
    """An unknown group becomes the first group its summary names."""
    found = F.coalesce(text.first_phrase(F.col("summary"), phrases, after_first), F.col("group_name"))
    return df.withColumn("group_name", F.when(F.col("group_name") == UNKNOWN, found).otherwise(F.col("group_name")))


def lump_rare(df: DataFrame, column: str, least: int = 5, label: str = "other") -> DataFrame:
    """Values seen fewer than ``least`` times become one label.

    Counts are aggregated before the shuffle and joined back; only the frequent
    or rare list travels, never the rows of one value to one task.
    """
    rare = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < least).select(
        column, F.lit(True).alias("_rare")
    )
    return (
        df.join(rare, column, "left")
        .withColumn(column, F.when(F.col("_rare"), label).otherwise(F.col(column)))
        .select(*df.columns)
    )


def all_unknown(triples: Sequence[Sequence[str]]) -> Column:
    """True where every column of some group is unknown."""
    empty = F.lit(False)
    for columns in triples:
        blank = F.lit(True)
        for c in columns:
            blank = blank & values.true_only(F.col(c) == UNKNOWN)
        empty = empty | blank
    return empty


def drop_all_unknown(df: DataFrame, triples: Sequence[Sequence[str]]) -> tuple[DataFrame, DataFrame]:
    """(rows kept, distinct rows rejected because a whole attribute group is unknown)."""
    empty = all_unknown(triples)
    return df.where(~empty), df.where(empty).distinct()


def fill_missing_group(df: DataFrame, column: str = "group_name", flag: str = "none_group_flag") -> DataFrame:
    """A missing group becomes 'unknown'; once any was missing, the flag marks every unknown group, else no row."""
    any_missing = df.agg(F.coalesce(F.bool_or(F.col(column).isNull()), F.lit(False))).scalar()
    filled = F.coalesce(F.col(column), F.lit(UNKNOWN))
    return df.withColumns({column: filled, flag: values.flag(any_missing & (filled == UNKNOWN))})
