"""Numeric expressions: sentinels, casts, buckets, clips and flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from casebook.functions import fixed_values as V
from casebook.functions.text import lookup


def true_only(condition: Column) -> Column:
    """A condition in which NULL counts as false."""
    return F.coalesce(condition, F.lit(False))


def flag(condition: Column) -> Column:
    return true_only(condition).cast("int")


def nan_to_null(value: Column) -> Column:
    """NaN as NULL: Spark orders NaN above every number."""
    return F.when(~F.isnan(value), value)


def sentinel_to_null(value: Column, sentinel) -> Column:
    return F.when(value != sentinel, value)


def recode(value: Column, old, new) -> Column:
    return F.when(value == old, F.lit(new)).otherwise(value)


def whole_number(value: Column, dtype: str = "int") -> Column:
    """Cast to an integer type with NULL, NaN, infinities and numbers outside the type's range as 0."""
    number = value.cast("double")
    if dtype == "int":
        # A comparison costs less than a try_cast; NaN is above all numbers.
        return F.when((number > -(2.0**31) - 1) & (number < 2.0**31), number.cast("int")).otherwise(F.lit(0))
    bad = number.isNull() | F.isnan(number) | (F.abs(number) == float("inf"))
    return F.coalesce(F.when(~bad, number).try_cast(dtype), F.lit(0).cast(dtype))


def is_not_numeric(text: Column) -> Column:
    return text.isNotNull() & text.try_cast("double").isNull()


def clip(value: Column, low=None, high=None) -> Column:
    """Bring into range; NULL stays NULL (least and greatest would skip it)."""
    out = value
    if low is not None:
        out = F.when(value < low, low if isinstance(low, Column) else F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(value > high, high if isinstance(high, Column) else F.lit(high)).otherwise(out)
    return out


def round_coord(value: Column, digits: int, null_as_zero: bool) -> Column:
    if null_as_zero:
        value = F.coalesce(value, F.lit(0.0))
    return F.round(value, digits)


def value_category(
    value: Column,
    bounds: Sequence[tuple[float, str]] = V.VALUE_CATEGORIES,
    above: str = V.VALUE_CATEGORY_ABOVE,
) -> Column:
    """The label of the first bound the value does not exceed; NULL takes the first label."""
    out = F.lit(above)
    for bound, label in reversed(bounds):
        out = F.when(value <= bound, F.lit(label)).otherwise(out)
    return F.when(value.isNull(), F.lit(bounds[0][1])).otherwise(out)


def bin_label(value: Column, edges: Sequence[float] = V.VALUE_BIN_EDGES) -> Column:
    """Right-closed bins with the lowest edge included; the last bin is open; NULL outside."""
    out = F.when(value > edges[-1], F.lit(f"({edges[-1]:.0f}, inf]"))
    for i in range(len(edges) - 2, -1, -1):
        low = value >= edges[i] if i == 0 else value > edges[i]
        opening = "[" if i == 0 else "("
        label = F.lit(f"{opening}{edges[i]:.0f}, {edges[i + 1]:.0f}]")
        out = F.when(low & (value <= edges[i + 1]), label).otherwise(out)
    return out


def high_impact(propvalue: Column, nkill: Column) -> Column:
    return flag(
        true_only(propvalue >= V.HIGH_IMPACT_VALUE) | true_only(nkill >= V.HIGH_IMPACT_KILLED)
    )


def unknown_location_zero(city: Column, latitude: Column, longitude: Column) -> Column:
    """City unknown or coordinates at (0, 0)."""
    return flag(true_only(city == "unknown") | true_only((latitude == 0) & (longitude == 0)))


def unknown_location_null(city: Column, latitude: Column, longitude: Column) -> Column:
    """City unknown or both coordinates missing."""
    return flag(true_only(city == "unknown") | (latitude.isNull() & longitude.isNull()))


def inconsistent_success(success: Column, nkill: Column) -> Column:
    return flag((success == 0) & (nkill > 100))


def imputed_part(part: Column, total: Column, share: float = 0.5) -> tuple[Column, Column]:
    """(new part, condition): an absent sub-count of a positive total becomes a share of it."""
    condition = (F.coalesce(part, F.lit(0.0)) == 0) & (F.coalesce(total, F.lit(0.0)) > 0)
    return F.greatest(F.lit(1), F.floor(total * share)).cast("double"), condition


def bucket_value(extent: Column, table: Mapping[str, float] = V.EXTENT_VALUES) -> Column:
    return lookup(extent, table)


def extent_from_value(extent: Column, value: Column) -> Column:
    """An unknown extent of damage taken from the value's size."""
    sized = (
        F.when(value >= 1_000_000, "catastrophic").when(value >= 100_000, "major").when(value > 0, "minor")
    )
    return F.when(extent == "unknown", F.coalesce(sized, extent)).otherwise(extent)


def extent_mismatch(extent: Column, value: Column) -> Column:
    return flag(
        true_only((extent == "minor") & (value >= 100_000))
        | true_only((extent == "major") & (value >= 1_000_000))
        | true_only((extent == "catastrophic") & (value < 1_000_000))
    )


def known_or_unknown(value: Column, accepted: Sequence[str]) -> Column:
    return F.when(value.isin(list(accepted)), value).otherwise(F.lit("unknown"))


def allowed_values(key: Column, table: Mapping[str, Sequence[str]]) -> Column:
    """The values a key allows; a key outside the table allows only 'unknown'."""
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.array(*[F.lit(i) for i in v]))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.array(F.lit("unknown")))
