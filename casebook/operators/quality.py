"""Data-quality checks and profiles. Each check is a frame, not a side effect."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from casebook.functions import dates, values


def require_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("input is empty")
    return df


def require_none(violations: DataFrame, message: str) -> None:
    """Raise when a check found rows; one row is enough to know."""
    if not violations.isEmpty():
        raise ValueError(message)


def in_range(column: str, low, high, null_ok: bool = False) -> Column:
    ok = F.col(column).between(low, high)
    return ok | F.col(column).isNull() if null_ok else values.true_only(ok)


def in_set(column: str, members: Sequence, null_ok: bool = False) -> Column:
    ok = F.col(column).isin(list(members))
    return ok | F.col(column).isNull() if null_ok else values.true_only(ok)


def not_null(column: str) -> Column:
    return F.col(column).isNotNull()


def check_constraints(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations): all rules in one pass. A rule that yields NULL passes, as a SQL CHECK does."""
    counted = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations")


def watch(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """The frame and an observation that the next action on it fills: ``checked_rows`` and violations per rule.

    The counts come from the pass that writes the frame, so checking costs no scan.
    A rule that yields NULL passes, as a SQL CHECK does.
    """
    seen = Observation()
    counts = [F.count_if(~rule).alias(name) for name, rule in rules.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("checked_rows"), *counts), seen


def observed_report(spark: SparkSession, seen: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """(table_name, rule, violations, checked_rows) of the metrics that loads have left: a row per declared rule."""
    rows = [
        (table, rule, n, metrics["checked_rows"])
        for table, metrics in seen.items()
        for rule, n in metrics.items()
        if rule != "checked_rows"
    ]
    return spark.createDataFrame(rows, "table_name string, rule string, violations long, checked_rows long")


def require_clean(seen: Mapping[str, Mapping[str, int]]) -> None:
    """Raise when a load has seen violations."""
    broken = {f"{t}.{r}": n for t, metrics in seen.items() for r, n in metrics.items() if r != "checked_rows" and n}
    if broken:
        raise ValueError(f"constraints violated: {broken}")


def warehouse_rules() -> dict[str, dict[str, Column]]:
    """The declared constraints of the star's tables: required columns, ranges and domains."""

    def zero_one(*columns: str) -> dict[str, Column]:
        return {f"{c}_domain": F.col(c).isin(0, 1) for c in columns}

    def required(*columns: str) -> dict[str, Column]:
        return {f"{c}_required": not_null(c) for c in columns}

    measures = ["nkill", "nwound", "nkillter", "nwoundter", "nkillus", "nwoundus", "total_casualties"]
    flags = ["success", "propvalue_imputed", "us_casualty_imputed", "high_impact", "consistency_flag"]
    return {
        "dim_time": {
            **required("year", "month", "day", "extended"),
            "year_range": F.col("year").between(1970, 2017),
            "month_range": F.col("month").between(1, 12),
            "day_range": F.col("day").between(1, 31),
            **zero_one("extended"),
        },
        "dim_location": {
            **required("region", "country", "unknown_location_flag"),
            "latitude_range": F.col("latitude").between(-90, 90),
            "longitude_range": F.col("longitude").between(-180, 180),
            "specificity_range": F.col("specificity").between(1, 5),
            **zero_one("vicinity", "unknown_location_flag"),
        },
        "dim_attacktype": required("attack_type"),
        "dim_targettype": required("target_type"),
        "dim_terroristgroup": {
            **required("group_name", "unknown_group_flag"),
            **zero_one("uncertainty", "unknown_group_flag"),
        },
        "dim_propertydamage": {
            **required("property"),
            "property_range": F.col("property").between(-1, 1),
        },
        "fact_incidents": {
            **required(*measures, *flags),
            **{f"{m}_range": F.col(m) >= 0 for m in measures},
            **zero_one(*flags),
        },
    }


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def duplicate_tuple_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows repeat an earlier tuple."""
    per_tuple = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return per_tuple.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def fk_violations(
    fact: DataFrame, references: Mapping[str, tuple[str, DataFrame, str]]
) -> DataFrame:
    """(reference, violations): fact keys that are set but absent in the referenced frame.

    ``references`` maps a name to (fact column, referenced frame, its key). Fact
    keys are grouped first, so a hot key crosses the join once. Keys are merged:
    the size Spark expects of a stored key column is that of its packed file, so
    parents of any size would be broadcast, and all of them at once.
    """
    out = None
    for name, (column, parent, key) in references.items():
        keys = fact.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        lost = keys.join(parent.select(F.col(key).alias("_k")).hint("merge"), "_k", "left_anti").agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")
        )
        row = lost.select(F.lit(name).alias("reference"), "violations")
        out = row if out is None else out.unionAll(row)
    return out


def date_violations(df: DataFrame) -> DataFrame:
    """Rows whose date parts are zero or below the accepted start."""
    y, m, d = F.col("year"), F.col("month"), F.col("day")
    return df.where(values.true_only((y < 1970) | (m < 1) | (d < 1)))


def zero_date_breakdown(df: DataFrame) -> DataFrame:
    """Which of year, month and day are 0: inclusive and exclusive counts in one pass."""
    zero = {c: F.col(c) == 0 for c in ("year", "month", "day")}
    counts = {f"{c}_zero": z for c, z in zero.items()}
    names = list(zero)
    for picked in (
        ("year",), ("month",), ("day",), ("year", "month"), ("year", "day"), ("month", "day"), tuple(names)
    ):
        condition = F.lit(True)
        for c in names:
            condition = condition & (zero[c] if c in picked else ~zero[c])
        label = "all_zero" if len(picked) == 3 else "_".join(picked) + "_only"
        counts[label] = condition
    return df.agg(*[F.count_if(c).alias(n) for n, c in counts.items()])


def calendar_flags(df: DataFrame) -> DataFrame:
    ok = dates.is_calendar_date(F.col("year"), F.col("month"), F.col("day"))
    return df.withColumn("valid_date", ok.cast("int"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("row_count"), column)


PROFILE = ("positive", "zero", "negative", "missing", "mean_value", "max_value")


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: positive, zero, negative and missing counts, mean, maximum; one pass."""
    cells = []
    for c in columns:
        v = values.nan_to_null(F.col(c).cast("double"))
        stats = (
            F.count_if(v > 0), F.count_if(v == 0), F.count_if(v < 0), F.count_if(v.isNull()), F.avg(v), F.max(v)
        )
        cells.append(F.struct(F.lit(c).alias("measure"), *[s.alias(n) for s, n in zip(stats, PROFILE)]))
    row = df.agg(F.array(*cells).alias("cells"))
    return row.select(F.inline("cells"))


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in columns])


def crosstab(
    df: DataFrame, rows: str, columns: str, members: Sequence[str] | None = None, rest: str = "rest"
) -> DataFrame:
    """Counts of rows × column members, 0 where a pair does not occur.

    Without ``members`` they are taken from the data (Spark refuses more than
    ``spark.sql.pivotMaxValues``); with them, ``rest`` counts the rows of all others.
    """
    if members is None:
        return df.groupBy(rows).pivot(columns).count().fillna(0)
    value = F.col(columns)
    listed = F.coalesce(value.isin(list(members)), F.lit(False))
    return df.groupBy(rows).agg(*[F.count_if(value == m).alias(m) for m in members], F.count_if(~listed).alias(rest))


def step_counts(steps: Mapping[str, DataFrame]) -> DataFrame:
    """(step, row_count) for several frames."""
    out = None
    for name, df in steps.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("step"), "row_count")
        out = row if out is None else out.unionAll(row)
    return out


def point_lookup(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose column equals a value given as text, cast to the column's type."""
    return df.where(F.col(column) == F.lit(value).cast(df.schema[column].dataType))


def sample_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The first n distinct values in order."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(n)
