"""Cuboids that grow by batches, and member-set expressions against plain sets."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from casebook.operators import cuboid as E
from casebook.operators.members import Level, Listed, Product, Range, Union, counted, keep
from casebook.session import fresh_path


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(4)
    rows = [
        (i, rnd.choice(["a", "b", "c", None]), rnd.choice(["x", "y"]), rnd.randint(1990, 1994), rnd.choice([None, 1.0, 2.5]), rnd.choice([0, 1]))
        for i in range(3000)
    ]
    return rows, spark.createDataFrame(rows, "eventid long, r string, t string, y int, v double, f int")


def cells_of(df):
    return sorted(map(tuple, df.select("r", "t", "y", "incidents", "sum_v", "count_v", "min_f").collect()), key=str)


def test_refresh_equals_rebuild_and_replays_change_nothing(spark, events):
    _, df = events
    whole = E.Cuboid(fresh_path(spark, "cuboid"), ["r", "t", "y"], ["v"], ["f"])
    grown = E.Cuboid(fresh_path(spark, "cuboid"), ["r", "t", "y"], ["v"], ["f"])
    with pytest.raises(FileNotFoundError):
        grown.read(spark)
    whole.add(df, 0)
    for number, part in enumerate([df.where("eventid < 500"), df.where("eventid BETWEEN 500 AND 2000"), df.where("eventid > 2000")]):
        grown.add(part, number)
        grown.add(part, number)
    assert cells_of(grown.merged(grown.read(spark), grown.levels)) == cells_of(whole.read(spark))
    means = grown.read(spark).groupBy("t").agg(E.mean("v").alias("m"), E.values("v").alias("n"), E.least("f").alias("f")).collect()
    plain = {r.t: (r.m, r.n, r.f) for r in df.groupBy("t").agg(F.avg("v").alias("m"), F.count("v").alias("n"), F.min("f").alias("f")).collect()}
    assert {r.t: (pytest.approx(r.m), r.n, r.f) for r in means} == plain


def test_merged_sketches_stay_within_their_error(spark):
    df = spark.range(60_000).select(F.col("id").alias("eventid"), (F.col("id") % 7).alias("k"))
    made = E.Cuboid(fresh_path(spark, "cuboid"), ["k"], [])
    for number in range(3):  # events of the batches overlap
        made.add(df.where(F.col("eventid").between(number * 15_000, number * 15_000 + 30_000)), number)
    about = made.read(spark).agg(E.about_distinct()).first()[0]
    assert abs(about - 60_000) <= 4 * E.ERROR * 60_000
    assert made.read(spark).agg(E.incidents()).first()[0] == 90_002


def test_sets_equal_plain_sets(spark, events):
    rows, df = events
    counts = counted(df, ["r", "t", "y"])
    got = lambda s: {tuple(x) for x in s.of(counts).collect()}
    assert got(Level("r")) == {("a",), ("b",), ("c",)}
    assert got(Level("r") - Listed.one("r", "a", "z")) == {("b",), ("c",)}
    assert got(Listed.one("r", "a") | Listed.one("r", "z")) == {("a",)}
    assert got(Range("y", 1991, 1992)) == {(1991,), (1992,)}
    number = Counter(r[1] for r in rows if r[1])
    best = sorted(number, key=lambda m: (-number[m], m))
    assert got(Level("r").top(2)) == {(m,) for m in best[:2]}
    within = Counter(r[1] for r in rows if r[1] and r[1] != best[0])
    assert got((Level("r") - Listed.one("r", best[0])).top(1)) == {(max(within, key=lambda m: (within[m], m)),)}
    pairs = Level("r") & Level("t")
    assert got(pairs - Listed(("r", "t"), (("a", "x"),))) == {(r, t) for r in "abc" for t in "xy"} - {("a", "x")}
    assert got(pairs - Listed.one("t", "y")) == {(r, "x") for r in "abc"}
    assert got(Product(Level("r"), Listed.one("t", "y")) | Listed(("r", "t"), (("a", "x"),))) == {("a", "x"), *((r, "y") for r in "abc")}
    with pytest.raises(ValueError):
        Union(Level("r"), Level("t"))
    with pytest.raises(ValueError):
        Level("r") - Level("t")


def test_kept_rows_belong_to_every_set(spark, events):
    rows, df = events
    got = {r.eventid for r in keep(df, Level("r") - Listed.one("r", "b"), Range("y", 1991, 1993), Listed(("r", "t"), (("a", "x"), ("c", "y"), (None, "x")))).collect()}
    assert got == {r[0] for r in rows if 1991 <= r[3] <= 1993 and (r[1], r[2]) in {("a", "x"), ("c", "y")}}
    nulls = keep(df, Listed.one("r", None)).select("r").distinct().collect()
    assert [tuple(r) for r in nulls] == [(None,)]


def test_a_filter_reads_its_rows_twice(spark, events):
    _, df = events
    sets = (Level("r").top(2), Level("t") - Listed.one("t", "y"), (Level("r") & Level("y")).top(4))
    counts = counted(df, ["r", "t", "y"])
    plan = keep(df, *sets, counts=counts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1 and "Cartesian" not in plan
