"""Loads that grow and tables that are replaced: replays, late members, what a batch reads, writes that fail half-way."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from casebook.operators import warehouse as W
from casebook.plans import star
from casebook.plans.cleaning import clean, sample_cut
from casebook.session import Folder, fresh_path
from casebook.sources import tables
from casebook.sources.versions import Conflict, VersionedTable
from casebook.streaming import incremental as I

SF = "/root/testdata/sf0.001"


def same(one, two):
    return one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


# Versioned tables


@pytest.fixture
def versioned(spark):
    return VersionedTable(spark, fresh_path(spark, "versioned"))


def test_replacing_keeps_readers_of_the_old_version(spark, versioned):
    versioned.replace(spark.range(10).withColumn("half", F.col("id") % 2), ("half",))
    old = versioned.read()
    versioned.replace(versioned.read().where("id < 4"))
    assert old.count() == 10 and versioned.read().count() == 4 and versioned.read(1).count() == 10
    versioned.replace(spark.range(7))
    assert [v.number for v in versioned.versions()] == [2, 3]
    assert len(versioned.data.names()) == 2 and versioned.read().columns == ["id"]
    with pytest.raises(FileNotFoundError):
        versioned.read(1)


def test_a_write_that_fails_leaves_the_old_table(spark, versioned):
    with pytest.raises(FileNotFoundError):
        versioned.read()
    versioned.replace(spark.range(100))
    # The last partitions fail when others have already written their files.
    broken = spark.range(0, 100, 1, 8).withColumn("x", F.when(F.col("id") > 90, F.raise_error(F.lit("stopped"))).otherwise(1))
    with pytest.raises(Exception, match="stopped"):
        versioned.replace(broken)
    assert versioned.read().count() == 100 and versioned.read().columns == ["id"]
    assert len(versioned.versions()) == 1
    versioned.replace(spark.range(3))
    versioned.replace(spark.range(4))
    assert versioned.read().count() == 4
    assert sorted(versioned.data.names()) == sorted(v.path.rsplit("/", 1)[-1] for v in versioned.versions())


def test_a_write_that_stops_before_its_manifest_is_not_seen(spark, versioned, monkeypatch):
    versioned.replace(spark.range(5))

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(versioned.manifests, "create", stop)
    with pytest.raises(KeyboardInterrupt):
        versioned.replace(spark.range(50))
    again = VersionedTable(spark, versioned.path)
    assert again.read().count() == 5 and len(again.data.names()) == 2
    again.replace(spark.range(6))
    # The abandoned folder has a committed number now, so it goes.
    assert again.read().count() == 6 and len(again.data.names()) == 2


def test_two_writers_cannot_commit_one_number(spark, versioned, monkeypatch):
    versioned.replace(spark.range(5))
    other = VersionedTable(spark, versioned.path)
    create = versioned.manifests.create

    def late(name, text):
        other.replace(spark.range(8))
        return create(name, text)

    monkeypatch.setattr(versioned.manifests, "create", late)
    with pytest.raises(Conflict):
        versioned.replace(spark.range(9))
    assert VersionedTable(spark, versioned.path).read().count() == 8


# Incremental load


@pytest.fixture(scope="module")
def raw(spark):
    path = fresh_path(spark, "raw")
    tables.raw_incidents(spark, SF).repartitionByRange(4, "eventid").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def rules(spark, raw):
    rules = star.view_rules(spark, SF)
    return replace(rules, sample_cap=40, sample_cut=sample_cut(raw, replace(rules, sample_cap=40)))


@pytest.fixture(scope="module")
def whole(spark, raw, rules):
    cleaned = clean(raw, replace(rules, sample_cut=None))[0].withColumnRenamed("event_id", "eventid")
    return star.build(cleaned).flat


def parts_of(raw):
    low, high = raw.agg(F.min("eventid"), F.max("eventid")).first()
    step = (high - low) // 3 + 1
    return [raw.where(F.col("eventid").between(low + i * step, low + (i + 1) * step - 1)) for i in range(3)]


def flat_of(spark, grown, raw, rules):
    return W.star_flat(*I.loaded(spark, grown, raw, rules))


def test_stream_from_raw_rows_equals_the_batch(spark, raw, rules, whole):
    folder, progress = fresh_path(spark, "arriving"), fresh_path(spark, "progress")
    grown = I.Star(fresh_path(spark, "grown"), buckets=8)
    first, second, third = parts_of(raw)
    first.repartition(2).write.mode("append").parquet(folder)
    I.load_stream(spark, folder, grown, progress, rules)
    before = I.loaded(spark, grown, raw, rules)[1]["dim_location"]
    known = before.count()
    # Later files bring new events and some that are loaded already, with another city.
    second.unionAll(first.limit(30).withColumn("city", F.lit("elsewhere"))).write.mode("append").parquet(folder)
    third.write.mode("append").parquet(folder)
    I.load_stream(spark, folder, grown, progress, rules)
    fact, dimensions = I.loaded(spark, grown, raw, rules)
    columns = [c for c in whole.columns]
    assert same(flat_of(spark, grown, raw, rules).select(*columns), whole)
    for name, dim in W.DIMENSIONS.items():
        ids = dimensions[name].agg(F.min(dim.id_column), F.max(dim.id_column), F.count_distinct(dim.id_column), F.count("*")).first()
        assert ids[0] == 1 and ids[1] == ids[2] == ids[3], name
    assert dimensions["dim_location"].count() > known
    assert dimensions["dim_location"].where(F.col("location_id") > known).select("city").distinct().count() > 0


def test_a_replayed_batch_changes_nothing(spark, raw, rules, whole):
    grown = I.Star(fresh_path(spark, "grown"), buckets=8)
    parts = parts_of(raw)
    for number, part in enumerate(parts):
        if number == 1:
            # The first attempt stores members and stops before the facts.
            cleaned = clean(part, rules)[0].withColumnRenamed("event_id", "eventid")
            for dim in list(W.DIMENSIONS.values())[:3]:
                I.grow(grown, cleaned, dim, number)
        I.load_batch(part, number, grown, rules)
        once = I.loaded(spark, grown, raw, rules)[0].collect()
        I.load_batch(part, number, grown, rules)
        assert sorted(map(str, I.loaded(spark, grown, raw, rules)[0].collect())) == sorted(map(str, once))
    assert same(flat_of(spark, grown, raw, rules).select(*whole.columns), whole)


def test_a_batch_reads_the_files_of_its_own_buckets(spark):
    target = I.Target(fresh_path(spark, "target"), ["id"], buckets=32)
    rows = spark.range(2000).withColumn("value", F.col("id") * 2)
    target.append(rows, 0)
    batch = rows.where("id IN (5, 17, 1999)").unionAll(spark.sql("SELECT 2001L AS id, 0L AS value"))
    buckets = {r[0] for r in batch.select(target.bucket()).collect()}
    read = target.loaded_keys(spark, batch, 1)
    met = {f.rsplit("bucket=", 1)[1].split("/")[0] for f in (r[0] for r in read.select(F.input_file_name()).distinct().collect())}
    plan = read._jdf.queryExecution().toString()
    assert len(buckets) < 32 and met <= {str(b) for b in buckets}
    assert "PartitionFilters: [isnotnull(batch" in plan and "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,5)" in plan
    assert "ReadSchema: struct<id:bigint>" in plan
    files = Folder(spark, f"{target.path}/batch=0").names()
    assert len([f for f in files if f.startswith("bucket=")]) == 32
    target.append(batch, 1)
    target.append(batch, 1)
    assert target.read(spark, rows.schema).where("batch = 1").count() == 1
    assert target.read(spark, rows.schema).count() == 2001
    assert target.loaded_keys(spark, rows.limit(0), 2) is None


def test_rows_stream_into_a_plain_table_once_per_key(spark):
    folder, progress = fresh_path(spark, "events"), fresh_path(spark, "progress")
    target = I.Target(fresh_path(spark, "target"), ["event_id"], buckets=4)
    events = tables.table(spark, SF, "events").select("event_id", "user_id", "value")
    first, second = events.where("event_id < 60"), events.where("event_id >= 50 AND event_id < 100")

    def load():
        source = I.file_stream(spark, folder, events.schema, "*.parquet")
        I.append_stream(source, lambda batch: batch, target, progress, ["user_id", "value"])
        return target.read(spark, events.schema).count()

    first.repartition(3).write.mode("append").parquet(folder)
    assert load() == 60
    assert load() == 60
    second.repartition(2).write.mode("append").parquet(folder)
    assert load() == 100
