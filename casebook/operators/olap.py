"""Dashboard questions over the flat star: member sets, filters, measures, shares, drill-downs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casebook.operators.ordering import dense_ids

EVENT = "eventid"


def incidents() -> Column:
    return F.count(EVENT)


def distinct_incidents(condition: Column | None = None) -> Column:
    """COUNT DISTINCT of events, all or those of a condition."""
    return F.count_distinct(F.col(EVENT) if condition is None else F.when(condition, F.col(EVENT)))


def casualties() -> Column:
    """SUM(nkill) + SUM(nwound), NULL when either sum is."""
    return F.sum("nkill") + F.sum("nwound")


def top_members(df: DataFrame, dim: str, n: int, exclude: Sequence[str] = ()) -> DataFrame:
    """The n members with most incidents, ties by name; excluded members never count."""
    pool = df.where(F.col(dim).isNotNull())
    if exclude:
        pool = pool.where(~F.col(dim).isin(list(exclude)))
    return (
        pool.groupBy(dim).agg(incidents().alias("_n")).orderBy(F.desc("_n"), dim).limit(n).select(dim)
    )


def keep_top(df: DataFrame, base: DataFrame, dim: str, n: int, exclude: Sequence[str] = ()) -> DataFrame:
    """Rows of the base's top n members. The set has n rows at most, so it is broadcast."""
    return df.join(F.broadcast(top_members(base, dim, n, exclude)), dim, "left_semi")


def keep_top_counted(counts: DataFrame, dim: str, n: int, measure: str) -> DataFrame:
    """Counted rows of the n members with the largest sums, ties by name; the set is broadcast."""
    sums = counts.where(F.col(dim).isNotNull()).groupBy(dim).agg(F.sum(measure).alias("_n"))
    return counts.join(F.broadcast(sums.orderBy(F.desc("_n"), dim).limit(n).select(dim)), dim, "left_semi")


def drop_pairs(df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple]) -> DataFrame:
    """Leave out listed value combinations."""
    listed = F.lit(False)
    for pair in pairs:
        match = F.lit(True)
        for column, value in zip(columns, pair):
            match = match & (F.col(column) == value)
        listed = listed | match
    return df.where(~F.coalesce(listed, F.lit(False)))


def drop_pair_set(df: DataFrame, pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Leave out the value combinations of another frame."""
    return df.join(pairs.select(*columns).distinct(), list(columns), "left_anti")


def year_or_null(column: Column, low: int, high: int) -> Column:
    return column.between(low, high) | column.isNull()


def picked(df: DataFrame, selection: Mapping[str, Sequence | None]) -> DataFrame:
    """Apply selections made elsewhere; an empty selection means all."""
    for column, members in selection.items():
        if members:
            df = df.where(F.col(column).isin(list(members)))
    return df


def summarize(
    df: DataFrame,
    by: Sequence[str],
    measures: Mapping[str, Column],
    known: Sequence[str] = (),
) -> DataFrame:
    """Group and aggregate; every ``known`` flag must have minimum 0 in the group."""
    flags = {f"_min_{f}": F.min(f) for f in known}
    out = df.groupBy(*by).agg(*[c.alias(n) for n, c in {**measures, **flags}.items()])
    for name in flags:
        out = out.where(F.col(name) == 0)
    return out.drop(*flags)


def with_share(df: DataFrame, measure: str, out: str, digits: int = 6) -> DataFrame:
    """The measure's share of its total over all groups shown; the total is a scalar subquery."""
    total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(out, F.round(F.col(measure) / F.when(total != 0, total), digits))


def most_used(df: DataFrame, dim: str) -> DataFrame:
    """Members whose count equals the largest count; ties all stay."""
    counts = df.groupBy(dim).agg(incidents().alias("incident_count"))
    largest = counts.agg(F.max("incident_count")).scalar()
    return counts.where(F.col("incident_count") == largest)


def single_value(column: str) -> Column:
    """The one value of the group, '*' when there are several."""
    low, high = F.min(column), F.max(column)
    return F.when(low == high, low.cast("string")).otherwise(F.lit("*"))


METRICS = {
    "Total Attacks": lambda: distinct_incidents(),
    "Successful Attacks": lambda: distinct_incidents(F.col("success") == 1),
    "Unsuccessful Attacks": lambda: distinct_incidents(F.col("success") == 0),
    "Total Killed": lambda: F.sum("nkill").cast("long"),
}
TEXT_METRIC = "Most Used Weapon"


def kpis(df: DataFrame) -> DataFrame:
    """The four headline numbers in one row."""
    return df.agg(*[make().alias(name.lower().replace(" ", "_")) for name, make in METRICS.items()])


def metric(name: str) -> Column:
    if name not in METRICS:
        raise ValueError(f"metric must be one of {list(METRICS)}")
    return METRICS[name]()


def metric_value(df: DataFrame, name: str) -> DataFrame:
    """The picked metric as text."""
    if name == TEXT_METRIC:
        winners = most_used(df, "weapon_type")
        return winners.agg(single_value("weapon_type").alias("metric_value"))
    return df.agg(metric(name).cast("string").alias("metric_value"))


def kpi_unpivot(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Measure names and values as rows in a given order."""
    row = kpis(df)
    long = row.unpivot([], row.columns, "measure_name", "measure_value")
    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("measure_name"))
    return long.withColumn("position", F.when(place > 0, place.cast("int")))


def drill_down(df: DataFrame, levels: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Subtotals of a hierarchy; ``level_depth`` tells how many levels a row is grouped by."""
    grouped = df.rollup(*levels).agg(
        *[c.alias(n) for n, c in measures.items()], F.grouping_id().alias("_gid")
    )
    depth = F.lit(len(levels)) - F.bit_count("_gid")
    return grouped.withColumn("level_depth", depth.cast("int")).drop("_gid")


def cube(df: DataFrame, dims: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    return df.cube(*dims).agg(
        *[c.alias(n) for n, c in measures.items()],
        *[F.grouping(d).cast("int").alias(f"{d}_total") for d in dims],
    )


def membership(df: DataFrame, members: DataFrame, dim: str, out: str) -> DataFrame:
    """1 when the row's member is in the set, else 0."""
    marked = members.select(dim).distinct().withColumn(out, F.lit(1))
    return df.join(marked, dim, "left").withColumn(out, F.coalesce(out, F.lit(0)))


def polar_angles(df: DataFrame, dim: str, digits: int = 4) -> DataFrame:
    """Position of each member on a circle, in name order: index * 360 / (members + 1)."""
    placed = dense_ids(df, "_index", [dim])
    members = placed.agg(F.count(F.lit(1))).scalar()
    return placed.select(dim, F.round(F.col("_index") * 360 / (members + 1), digits).alias("angle"))
