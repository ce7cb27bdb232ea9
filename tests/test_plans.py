"""Whole plans: SQL answers at a small scale, invariants of the star, stream against batch, files."""

import pytest
from pyspark.sql import functions as F

import compare
from casebook import schemas
from casebook.operators import cleaning as C, quality as Q, warehouse as W
from casebook.plans import catalog, queries_warehouse, star
from casebook.plans.cleaning import clean, one_per_event, sample_cut
from casebook.session import Folder, fresh_path, materialize
from casebook.sources import files, tables

SF = "/root/testdata/sf0.001"
FUNCTIONS, ANSWERS = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(FUNCTIONS))
def test_query_equals_sql(spark, name):
    assert compare.compare(spark, compare.connect(SF), FUNCTIONS[name], ANSWERS.get(name), SF, empty_ok=True) is None


def test_every_query_has_sql():
    assert set(FUNCTIONS) == set(ANSWERS)


def test_sets_and_filters_keep_and_remove_rows(spark):
    """Every member set is smaller than its dimension, and years lie on both sides of the ranges."""
    flat = star.flat(spark, SF)
    for dim, n in {"attack_type": 3, "region": 4, "target_type": 3, "country": 20, "city": 20, "group_name": 10}.items():
        assert flat.select(dim).distinct().count() > n, dim
    years = flat.agg(F.min("year"), F.max("year")).first()
    assert years[0] < 1996 and years[1] > 2000
    flags = {r[0]: r[1] for r in FUNCTIONS["flag_text_year"](spark, SF).groupBy("summary_date_mismatch_flag").count().collect()}
    assert min(flags.get(0, 0), flags.get(1, 0)) > 10
    for name, column in (("regex_flag", "damage_flag"), ("regex_flag", "claimed_flag")):
        assert FUNCTIONS[name](spark, SF).select(column).distinct().count() == 2
    stats = FUNCTIONS["text_clean_stats"](spark, SF).first()
    assert stats.claimed_before > stats.claimed
    assert {r.motive for r in FUNCTIONS["motive_counts"](spark, SF).collect()} >= {"the-like", "german", "french", "spanish"}


def test_crosstab_counts_members_that_are_not_listed(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (2, "c")], "k int, v string")
    listed = Q.crosstab(df, "k", "v", ["a"]).collect()
    assert sorted(map(tuple, listed)) == [(1, 1, 1), (2, 0, 2)]
    assert set(Q.crosstab(df, "k", "v").columns) == {"k", "a", "b", "c", "null"}


def test_rows_without_key_are_set_aside_and_repeats_are_loaded_once(spark):
    raw = tables.raw_incidents(spark, SF).limit(50).cache()
    keyless = raw.limit(5).withColumn("eventid", F.lit(None).cast("long"))
    other = raw.limit(7).withColumn("city", F.lit("zz other place"))
    rules = star.view_rules(spark, SF)
    cleaned, rejected = clean(raw.unionAll(keyless).unionAll(raw).unionAll(other), rules)
    assert rejected["missing_key"].count() == 5
    assert Q.duplicate_keys(cleaned, ["event_id"]).isEmpty()
    assert cleaned.where("city = 'zz other place'").isEmpty()  # later in the total order
    twice = cleaned.unionAll(cleaned).withColumnRenamed("event_id", "eventid")
    assert W.load_fact(twice, star.star(spark, SF).dimensions).count() == cleaned.count()
    assert W.reconcile(twice, "incidents").count() == W.reconcile(twice.distinct(), "incidents").count()


def test_clean_and_quarantine_cover_the_input(spark):
    raw = tables.raw_incidents(spark, SF)
    cleaned, rejected = clean(raw, star.view_rules(spark, SF))
    assert cleaned.count() + rejected["zero_date"].count() == raw.count()


def test_star_invariants(spark):
    published = star.star(spark, SF)
    assert published.fact.count() == published.cleaned.count()
    assert Q.duplicate_keys(published.fact, ["eventid"]).isEmpty()
    references = {
        name: (dim.id_column, published.dimensions[name], dim.id_column) for name, dim in W.DIMENSIONS.items()
    }
    lost = Q.fk_violations(published.fact, references)
    assert lost.agg(F.sum("violations")).first()[0] == 0
    for name, dim in W.DIMENSIONS.items():
        ids = published.dimensions[name].agg(F.min(dim.id_column), F.max(dim.id_column), F.count("*")).first()
        assert ids[0] == 1 and ids[1] == ids[2]


def test_star_meets_its_declared_constraints(spark):
    published = star.star(spark, SF)
    tables_by_name = {**published.dimensions, "fact_incidents": published.fact}
    for name, rules in Q.warehouse_rules().items():
        assert Q.check_constraints(tables_by_name[name], rules).where("violations > 0").isEmpty(), name
    broken = published.dimensions["dim_time"].withColumn("month", F.lit(13))
    assert not Q.check_constraints(broken, Q.warehouse_rules()["dim_time"]).where("violations > 0").isEmpty()


def test_loads_count_violations_while_they_write(spark):
    published = star.star(spark, SF)
    tables_by_name = {**published.dimensions, "fact_incidents": published.fact}
    for name, rules in Q.warehouse_rules().items():
        assert set(published.checks[name]) == {"checked_rows", *rules}
        assert published.checks[name]["checked_rows"] == tables_by_name[name].count()
    Q.require_clean(published.checks)
    df = spark.range(0, 100, 1, 4).withColumn("v", F.when(F.col("id") % 10 != 0, F.col("id")))
    rules = {"small": F.col("v") < 50, "there": F.col("v").isNotNull()}
    context = spark.sparkContext

    def jobs(group, frame):
        context.setJobGroup(group, group)
        materialize(frame, "watched")
        return len(context.statusTracker().getJobIdsForGroup(group))

    watched, seen = Q.watch(df, rules)
    assert jobs("watched", watched) == jobs("plain", df)
    assert seen.get == {"checked_rows": 100, "small": 45, "there": 10}
    with pytest.raises(ValueError, match="t.there"):
        Q.require_clean({"t": seen.get})


def test_exported_star_reads_back(spark):
    published = star.star(spark, SF)
    frames = {**published.dimensions, "fact_incidents": published.fact}
    folder = fresh_path(spark, "export")
    files.export_tables(frames, folder)
    back = files.read_collection(spark, folder, {**schemas.DIMENSIONS, "fact_incidents": schemas.FACT}, views=True)
    for name, df in frames.items():
        assert back[name].exceptAll(df.select(*back[name].columns)).isEmpty(), name
        assert back[name].count() == df.count() == spark.table(name).count()
    assert Q.point_lookup(back["dim_time"], "time_id", "1").first().year == 1970
    assert [r.year for r in Q.sample_values(back["dim_time"], "year", 2).collect()] == [1970, 1995]


def test_files(spark):
    path = fresh_path(spark, "csv")
    rows = [(1, 'say "hi", ok\nnext', 1.5), (2, None, None)]
    df = spark.createDataFrame(rows, "eventid long, summary string, propvalue double")
    files.write_csv(df, path)
    back = files.read_raw_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == rows
    fallback = spark.createDataFrame([("kabul", 1.0, 2.0, "a", "b")], schemas.GAZETTEER)
    assert files.read_or_fallback(spark, path + "-none", fallback).count() == 1
    assert files.with_header_row(df).where("eventid = 'eventid'").count() == 1
    quarantined = fresh_path(spark, "quarantine")
    files.write_quarantine({"a": df, "b": df.select("eventid")}, quarantined)
    assert spark.read.parquet(quarantined).groupBy("reason").count().count() == 2


def test_latin1_csv(spark, tmp_path):
    (tmp_path / "raw.csv").write_bytes("eventid,city\n1,São\n".encode("latin-1"))
    assert files.read_raw_csv(spark, str(tmp_path / "raw.csv")).first().city == "São"


def test_plans_prune_and_push(spark):
    flat = star.flat(spark, SF).where("year BETWEEN 1996 AND 1999").groupBy("country").count()
    plan = flat._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<country:string>" in plan
    deduped = FUNCTIONS["dedupe_keep_first"](spark, SF)._jdf.queryExecution().toString()
    assert deduped.count("WindowGroupLimit") >= 2


def test_no_cartesian_products(spark):
    for name in ("pct_total_countries", "member_set_algebra", "cap_iqr", "fuzzy_city"):
        plan = FUNCTIONS[name](spark, SF)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_that_stand_once_are_neither_ranked_nor_prepared_twice(spark):
    published = star.star(spark, SF)
    assert "Window" not in plan(W.load_fact(published.cleaned, published.dimensions))
    cleaned, _ = clean(tables.raw_incidents(spark, SF), star.view_rules(spark, SF))
    assert "Window" not in plan(cleaned) and "lineitem" not in plan(cleaned)


def test_outcome_runs_read_stored_rows(spark, monkeypatch):
    given, write = [], files.write_outcomes
    monkeypatch.setattr(files, "write_outcomes", lambda df, *rest: (given.append(df), write(df, *rest)))
    FUNCTIONS["tagged_outcomes"](spark, SF)
    assert len(given) == 3 and not any("Join" in plan(df) for df in given)


def test_outcomes_are_written_without_a_shuffle(spark, monkeypatch):
    rows = [(i, None if i % 10 == 0 else i % 7, "x" * (i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "eventid long, nkill int, city string")
    drops = {"none_killed": F.col("nkill") == 0}
    suspects = {f"below_{n}": F.col("nkill") < n for n in range(2, 7)} | {"no_city": F.col("city") == ""}
    wanted = [(*r, "accepted", "none") for r in rows if r[1] != 0]
    wanted += [(*r, "set_aside", "none_killed") for r in rows if r[1] == 0]
    wanted += [(*r, "set_aside", f"below_{n}") for r in rows for n in range(2, 7) if r[1] is not None and r[1] < n]
    wanted += [(*r, "set_aside", "no_city") for r in rows if r[2] == ""]
    next_shuffle, open_files = spark.sparkContext._jsc.sc().newShuffleId, "spark.sql.maxConcurrentOutputFileWriters"
    for most in (files.OPEN_FILES, 2):  # with two files open, a task sorts its further rows
        monkeypatch.setattr(files, "OPEN_FILES", most)
        path, before = fresh_path(spark, "outcomes"), next_shuffle()
        for run in (1, 2, 2):
            files.write_outcomes(df, path, run, drops, suspects)
        assert next_shuffle() == before + 1 and spark.conf.get(open_files, None) is None
        found = files.read_outcomes(spark, path).select("run", *df.columns, "outcome", "reason").collect()
        assert sorted(map(repr, map(tuple, found))) == sorted(repr((run, *r)) for run in (1, 2) for r in wanted)


def test_outcome_runs_leave_only_what_they_write(spark):
    folder = Folder(spark, fresh_path(spark, "any").rpartition("/")[0])
    before = {*folder.names()}
    found = FUNCTIONS["tagged_outcomes"](spark, SF)
    assert [n.rpartition("-")[0] for n in {*folder.names()} - before] == ["outcomes"]
    assert {r.run for r in found.collect()} == {1, 2}


def test_repeated_arrivals_are_one_pass(spark, monkeypatch):
    given = []
    monkeypatch.setattr(queries_warehouse, "clean", lambda raw, rules: (given.append(raw), clean(raw, rules))[1])
    FUNCTIONS["repeated_event_kpis"](spark, SF)
    raw, key = tables.raw_incidents(spark, SF), F.col("eventid")
    wanted = raw.count() + raw.where(key % 3 == 0).count() + raw.where(key % 7 == 0).count()
    assert "Union" not in plan(given[0]) and given[0].count() == wanted
    assert given[0].where(key.isNull()).count() == raw.where(key % 7 == 0).count()


def test_the_cut_of_the_sample_prepares_only_events_that_may_be_sampled(spark, monkeypatch):
    given, cut = [], C.sample_cut
    monkeypatch.setattr(C, "sample_cut", lambda df, *rest: (given.append(df), cut(df, *rest))[1])
    raw, rules = tables.raw_incidents(spark, SF), star.view_rules(spark, SF)
    found = sample_cut(raw, rules)
    whole = C.impute_by_bucket(one_per_event(raw, rules)[0], rules.extent_values, "propvalue_imputed")
    assert found == tuple(cut(whole, "event_id", rules.sample_cap, rules.sample_seed).first()["cut"])
    assert "LeftSemi" in plan(given[0])
