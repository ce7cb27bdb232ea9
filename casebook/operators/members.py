"""Member sets as expressions: level members, listed ones, ranges, unions, differences, products, the top of a set.

An expression names members of one or more levels. It is evaluated on counts per
combination of all levels it names, so a filter of any depth scans the rows once for
its sets and once to be applied. Sets are relevant ones: members and combinations
that the rows hold. A product is never built: a row belongs to it when it belongs to
both sides, and a top set is taken within the set below it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from casebook.session import materialize

COUNT = "_incidents"


class Members:
    """A set of members of ``levels``."""

    @property
    def levels(self) -> tuple[str, ...]:
        raise NotImplementedError

    def among(self, counts: DataFrame) -> DataFrame:
        """The rows of ``counts`` that belong to the set."""
        raise NotImplementedError

    def of(self, counts: DataFrame) -> DataFrame:
        """The members, one row each."""
        return self.among(counts).select(*self.levels).distinct()

    def __or__(self, other: Members) -> Members:
        return Union(self, other)

    def __sub__(self, other: Members) -> Members:
        return Except(self, other)

    def __and__(self, other: Members) -> Members:
        return Product(self, other)

    def top(self, n: int) -> Members:
        return Top(self, n)


@dataclass(frozen=True)
class Level(Members):
    """All members of a level, NULL left out as no member."""

    name: str

    @property
    def levels(self) -> tuple[str, ...]:
        return (self.name,)

    def among(self, counts: DataFrame) -> DataFrame:
        return counts.where(F.col(self.name).isNotNull())


@dataclass(frozen=True)
class Listed(Members):
    """Listed members, or combinations of members of several levels."""

    names: tuple[str, ...]
    values: tuple[tuple, ...]

    @staticmethod
    def one(level: str, *values) -> Listed:
        return Listed((level,), tuple((v,) for v in values))

    @property
    def levels(self) -> tuple[str, ...]:
        return self.names

    def among(self, counts: DataFrame) -> DataFrame:
        return counts.where(self.condition())

    def condition(self) -> Column:
        some = F.lit(False)
        for combination in self.values:
            each = F.lit(True)
            for level, value in zip(self.names, combination):
                each = each & F.col(level).eqNullSafe(F.lit(value))
            some = some | each
        return some


@dataclass(frozen=True)
class Range(Members):
    """Members from low to high; ``with_null`` keeps rows without a member too."""

    name: str
    low: object
    high: object
    with_null: bool = False

    @property
    def levels(self) -> tuple[str, ...]:
        return (self.name,)

    def among(self, counts: DataFrame) -> DataFrame:
        inside = F.col(self.name).between(self.low, self.high)
        return counts.where(inside | F.col(self.name).isNull() if self.with_null else inside)


@dataclass(frozen=True)
class Union(Members):
    left: Members
    right: Members

    def __post_init__(self) -> None:
        if self.left.levels != self.right.levels:
            raise ValueError(f"sets of {self.left.levels} and {self.right.levels} have no union")

    @property
    def levels(self) -> tuple[str, ...]:
        return self.left.levels

    def among(self, counts: DataFrame) -> DataFrame:
        both = self.left.of(counts).unionAll(self.right.of(counts)).distinct()
        return _semi(counts, both, self.levels, "left_semi")


@dataclass(frozen=True)
class Except(Members):
    """The left set without the members of the right one, which may name fewer levels."""

    left: Members
    right: Members

    def __post_init__(self) -> None:
        if not set(self.right.levels) <= set(self.left.levels):
            raise ValueError(f"{self.right.levels} are not levels of {self.left.levels}")

    @property
    def levels(self) -> tuple[str, ...]:
        return self.left.levels

    def among(self, counts: DataFrame) -> DataFrame:
        return _semi(self.left.among(counts), self.right.of(counts), self.right.levels, "left_anti")


@dataclass(frozen=True)
class Product(Members):
    """Combinations of members of both sides."""

    left: Members
    right: Members

    @property
    def levels(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([*self.left.levels, *self.right.levels]))

    def among(self, counts: DataFrame) -> DataFrame:
        rows = self.left.among(counts)
        return _semi(rows, self.right.of(counts), self.right.levels, "left_semi")


@dataclass(frozen=True)
class Top(Members):
    """The n members of a set with most incidents, ties by name."""

    inner: Members
    n: int

    @property
    def levels(self) -> tuple[str, ...]:
        return self.inner.levels

    def among(self, counts: DataFrame) -> DataFrame:
        inner = self.inner.among(counts)
        sums = inner.groupBy(*self.levels).agg(F.sum(COUNT).alias("_n"))
        best = sums.orderBy(F.desc("_n"), *self.levels).limit(self.n).select(*self.levels)
        # The set has n rows at most.
        return _semi(inner, F.broadcast(best), self.levels, "left_semi")


def _semi(rows: DataFrame, members: DataFrame, levels: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join in which NULL is a value."""
    named = members.select(*[F.col(c).alias(f"_m_{c}") for c in levels])
    same = F.lit(True)
    for c in levels:
        same = same & rows[c].eqNullSafe(named[f"_m_{c}"])
    return rows.join(named, same, how)


def counted(rows: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Incidents per combination of levels, stored: what all sets of a dashboard are read from."""
    return materialize(rows.groupBy(*levels).agg(F.count("eventid").alias(COUNT)), "counted")


def keep(rows: DataFrame, *sets: Members, counts: DataFrame | None = None) -> DataFrame:
    """Rows that belong to every set; each set is taken on all rows, as dashboard filters are."""
    levels = list(dict.fromkeys(c for s in sets for c in s.levels))
    counts = counted(rows, levels) if counts is None else counts
    for s in sets:
        rows = _semi(rows, s.of(counts), s.levels, "left_semi")
    return rows
