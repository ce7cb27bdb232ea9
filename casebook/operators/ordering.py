"""Order-dependent work without a one-task window: running totals, dense ids, exact quantiles."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from casebook.session import materialize


def running_total(
    df: DataFrame, order_by: Sequence[str], out: str, weight: Column | None = None
) -> DataFrame:
    """Add the running total of ``weight`` (rows by default) over the whole order.

    Rows are range-partitioned by the order and stored with their partition
    number, so both passes see the same split; each partition then adds the
    totals of those before it. ``order_by`` should name unique rows.
    """
    weight = F.lit(1) if weight is None else weight
    ranged = (
        df.withColumn("_weight", weight.cast("long"))
        .repartitionByRange(*order_by)
        .withColumn("_split", F.spark_partition_id())
    )
    stored = materialize(ranged, "ranged")
    # One row per split, so this window is bounded by the number of partitions.
    before = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy("_split")
        .agg(F.sum("_weight").alias("_total"))
        .select("_split", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("_split").orderBy(*order_by)
    return (
        stored.join(F.broadcast(starts), "_split")
        .withColumn(out, F.col("_start") + F.sum("_weight").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("_split", "_start", "_weight")
    )


#: So many distinct rows are numbered by one task; the number is counted first.
FEW = 100_000


def dense_ids(df: DataFrame, id_column: str, natural_key: Sequence[str], first: int = 1, few: int = FEW) -> DataFrame:
    """Number distinct rows first, first+1, … in natural key order.

    The distinct rows are stored. Up to ``few`` of them take one ordered window; more are ranged over the cluster.
    """
    members = materialize(df.select(*natural_key).distinct(), "members")
    if members.count() <= few:
        place = F.row_number().over(Window.orderBy(*natural_key)).cast("long")
        return members.select((place + (first - 1)).alias(id_column), *natural_key)
    numbered = running_total(members, natural_key, id_column)
    return numbered.select((F.col(id_column) + (first - 1)).alias(id_column), *natural_key)


#: Quantiles a sketch reports at a time, and its accuracy: a rank error of at most one in ``ACCURACY``.
GRID, ACCURACY = 128, 10_000
#: So many values of a bracket are ordered by one task, no more.
HELD = 10_000


@dataclass
class _Search:
    """The value of one rank (from 0): it lies strictly between ``low`` and ``high``, which are proven by counts.

    ``below`` values are at or under ``low`` and ``inside`` between both; ``first``
    and ``last`` are the next bracket to try, which a sketch proposed.
    """

    column: str
    rank: int
    low: float = float("-inf")
    high: float = float("inf")
    below: int = 0
    inside: int = 0
    first: float = float("-inf")
    last: float = float("inf")
    held: bool = False
    value: float | None = None

    @property
    def bracket(self) -> tuple[str, float, float, bool]:
        return self.column, self.first, self.last, self.held

    def learn(self, seen) -> None:
        """Take the counts of a pass: an end that many values share, or a bracket that holds the rank, narrows the search."""
        start = seen["under"] + seen["at_first"]
        end = start + seen["within"]
        if seen["under"] <= self.rank < start:
            self.value = self.first
        elif end <= self.rank < end + seen["at_last"]:
            self.value = self.last
        elif start <= self.rank < end:
            self.low, self.high, self.below, self.inside = self.first, self.last, start, seen["within"]
            if self.held:
                self.value = seen["found"][self.rank - start]
            else:
                self._narrow(seen["found"])
        else:
            # The proposal missed the rank: what lies on its other side is left.
            if self.rank < seen["under"]:
                self.high, self.inside = self.first, seen["under"] - self.below
            else:
                self.low, self.below = self.last, end + seen["at_last"]
                self.inside = max(1, self.inside)
            self.first, self.last, self.held = self.low, self.high, False

    def _narrow(self, grid: list[float]) -> None:
        place = (self.rank - self.below + 0.5) / self.inside
        slack = 2 / ACCURACY
        low, high = math.floor((place - slack) * GRID) - 1, math.ceil((place + slack) * GRID) + 1
        self.first = grid[low] if low >= 0 else self.low
        self.last = grid[high] if high <= GRID else self.high
        # The sketch's promise bounds how many values the bracket can hold.
        most = self.inside * ((min(high, GRID) - max(low, 0)) / GRID + 4 / ACCURACY)
        self.held = self.inside <= HELD or most <= HELD


def _look(numbers: DataFrame, brackets: Sequence[tuple[str, float, float, bool]]) -> dict:
    """One aggregation: what lies below, on and between the ends of every bracket, and its values or their sketch."""
    parts = []
    for i, (column, first, last, held) in enumerate(brackets):
        v = F.col(column)
        within = F.when((v > first) & (v < last), v)
        if held:
            found = F.sort_array(F.collect_list(within))
        else:
            found = F.percentile_approx(within, [g / GRID for g in range(GRID + 1)], ACCURACY)
        parts.append(
            F.struct(
                F.count_if(v < first).alias("under"), F.count_if(v == first).alias("at_first"),
                F.count(within).alias("within"), F.count_if(v == last).alias("at_last"), found.alias("found"),
            ).alias(f"s{i}")
        )
    return dict(zip(brackets, numbers.agg(*parts).first()))


def order_statistics(
    df: DataFrame, columns: Sequence[str], ranks: Callable[[str, int], Sequence[int]]
) -> dict[str, dict[int, float]]:
    """Per column the values of the ranks (from 0) that ``ranks(column, count)`` asks for; exact, no row sorted or stored.

    Every pass is one aggregation for all columns and ranks at once. Sketches
    propose a bracket of values around each rank, the next pass counts what lies below,
    on and between its ends, and brackets that hold few values are ordered whole.
    A pass narrows a bracket a hundredfold, so their number grows with the logarithm
    of the rows. NULL and NaN are no numbers.
    """
    numbers = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    seen = _look(numbers, [_Search(c, 0).bracket for c in columns])
    searches = []
    for c in columns:
        whole = seen[_Search(c, 0).bracket]
        size = whole["at_first"] + whole["within"] + whole["at_last"]
        searches += [_Search(c, r) for r in dict.fromkeys(ranks(c, size))]
    open_ = searches
    while open_:
        for search in open_:
            search.learn(seen[search.bracket])
        open_ = [s for s in open_ if s.value is None]
        if open_:
            seen = _look(numbers, list(dict.fromkeys(s.bracket for s in open_)))
    return {c: {s.rank: s.value for s in searches if s.column == c} for c in columns}


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float]) -> DataFrame:
    """Linear-interpolated quantiles, one row per measure that has numbers, with one column per named probability."""
    sizes: dict[str, int] = {}

    def ranks(column: str, size: int) -> list[int]:
        sizes[column] = size
        spots = [p * (size - 1) for p in probabilities.values()] if size else []
        return [r for at in spots for r in (math.floor(at), math.ceil(at))]

    found = order_statistics(df, columns, ranks)

    def between(column: str, p: float) -> float:
        at = p * (sizes[column] - 1)
        low, high = found[column][math.floor(at)], found[column][math.ceil(at)]
        return low if low == high else low + (high - low) * (at - math.floor(at))

    rows = [(c, *[between(c, p) for p in probabilities.values()]) for c in columns if sizes[c]]
    schema = "measure string, " + ", ".join(f"{n} double" for n in probabilities)
    return df.sparkSession.createDataFrame(rows, schema)


def as_one_row(per_measure: DataFrame, measures: Sequence[str], names: Sequence[str]) -> Column:
    """A few rows of bounds as one struct ``<measure>_<name>``, used as a scalar subquery."""
    cells = [
        F.max(F.when(F.col("measure") == m, F.col(n))).alias(f"{m}_{n}") for m in measures for n in names
    ]
    row = per_measure.agg(*cells)
    return row.select(F.struct(*row.columns)).scalar()


def first_rows(df: DataFrame, order_by: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of a total order."""
    return df.orderBy(*order_by).limit(n)


def first_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Keep one row per key.

    The rank filter lets Spark drop all but the first row per key in each task
    before the shuffle, so a hot key never gathers its rows in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order_by))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
