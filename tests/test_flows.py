import datetime as dt
import os
import random
from contextlib import suppress

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from dayline.models.grid import Config
from dayline.models.series import fit
from dayline.plans.curation import Sources, curate, run_curation
from dayline.plans.loading import Entity, load_static, update_all
from dayline.plans.modelling import (forecast_run, model_series, read_forecasts, store_forecasts,
                                     run_tuning, tune)
from dayline.plans.stations import link_stations, station_table
from dayline.schemas import empty_table, schema_of
from dayline.session import scratch_path
from dayline.sinks.loads import read_loads
from dayline.sinks.tables import replace_by_key
from dayline.streaming.totals import blocks_before, drop_merged, read_totals, totals_stream, write_batch

FIRST = dt.date(2021, 1, 1)


def at(n):
    return FIRST + dt.timedelta(n)


@pytest.fixture(scope="module")
def sources(spark):
    rng = random.Random(1)
    status, risk, index, doses = [], [], [], []
    for region in ("A", "B", "C"):
        deaths = 0
        for n in range(30):
            deaths += rng.randrange(3)
            if region == "B" and n % 11 == 5:
                continue  # a day without status
            status.append((at(n), region, 100 + n, n, deaths, rng.choice([None, 2]), 3, 4, 5, 1, 1, 1, 9))
            if n % 4:
                risk.append((at(n), region, rng.choice(["red", "white"])))
            for age in ("12-19", "30-39", " 60-69", "90+", "25-34"):
                if region != "C" and rng.random() < 0.6:
                    doses.append((at(n), region, "s", age, 1, 1, rng.randrange(20), rng.randrange(9)))
    index = [(at(n), 50.0 + n) for n in range(30) if n != 7] + [(at(8), 1.0)]
    make = spark.createDataFrame
    return Sources(
        make(status, """date date, region string, cases int, new_cases int, deaths int,
             hospitalized_infectious_diseases int, hospitalized_high_intensity int,
             hospitalized_intensive_care int, active int, active_rsa int, active_nursing_homes int,
             active_int_struct int, active_rsa_total int"""),
        make(risk, "date date, region string, risk string"),
        make(index, "date date, value double"),
        make(doses, """date date, region string, supplier string, age_group string, male int, female int,
             first_dose int, second_dose int"""),
        make([("x", dt.date(2020, 12, 28), at(2)), ("y", at(9), at(10))], "holiday string, start date, end date"),
        make([("A", 1000), ("B", 500)], "region string, population int"))


def test_curated_columns_and_values(spark, sources):
    out = curate(sources)
    assert out.schema.simpleString() == schema_of("curated").simpleString()
    rows = {(r["region"], r["date"]): r for r in out.collect()}
    assert {k[0] for k in rows} == {"A", "B"}  # no doses, no rows for C
    first, eighth = rows["A", at(0)], rows["A", at(8)]
    assert first["new_deaths"] == first["deaths"] and first["holiday"] and first["risk"] is None
    assert not rows["A", at(2)]["holiday"] and rows["A", at(9)]["holiday"]
    assert eighth["stringency_index"] == 58.0 and rows["A", at(7)]["stringency_index"] is None
    assert first["hospitalized"] in (7, 9)
    for r in rows.values():
        assert r["new_first_doses"] == sum(r[f"new_first_doses_ag{b}"] for b in range(3))
    last = rows["A", at(29)]
    assert last["first_doses"] == sum(r["new_first_doses"] for k, r in rows.items() if k[0] == "A")
    assert last["vaccinated_population"] == pytest.approx(last["first_doses"] / 1000)


@pytest.mark.parametrize("cuts", [(0,), (12,), (5, 6, 20)])
def test_increments_equal_full_reprocess(spark, sources, rows, cuts):
    curated = empty_table(spark, "curated")
    for cut in [*cuts, 29]:
        path = scratch_path(spark, "curated")
        curated.unionByName(curate(sources, curated, hi=at(cut))).write.parquet(path)
        curated = spark.read.parquet(path)
    assert rows(curated) == rows(curate(sources))
    assert curate(sources, curated).count() == 0


def test_stored_curation_appends_once_and_reprocesses(spark, sources, rows):
    path = scratch_path(spark, "curated")
    first = run_curation(spark, sources, path, hi=at(9))
    rest = run_curation(spark, sources, path)
    assert run_curation(spark, sources, path) == 0
    grown = rows(read_loads(spark, path))
    assert first > 0 and len(grown) == first + rest
    assert run_curation(spark, sources, path, reprocess_all=True) == len(grown)
    assert rows(read_loads(spark, path)) == grown


@pytest.mark.parametrize("name", ["risk", "stringency", "vaccines", "status"])
def test_one_empty_source_closes_the_gate(sources, name):
    short = sources._replace(**{name: getattr(sources, name).filter("false")})
    assert curate(short).count() == 0


def test_source_behind_the_last_curated_day_closes_the_gate(spark, sources):
    curated = curate(sources, hi=at(10))
    for name in ("risk", "stringency", "vaccines"):
        late = getattr(sources, name).filter(F.col("date") <= at(10))
        assert curate(sources._replace(**{name: late}), curated).count() == 0
    assert curate(sources, curated).count() > 0


def test_stations_are_placed_and_linked(spark, rows):
    square = [(m, 0, i, x + 10.0 * m, y) for m in (0, 1)
              for i, (x, y) in enumerate([(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)])]
    vertices = spark.createDataFrame(square, "poly_id int, ring int, seq int, x double, y double")
    towns = spark.createDataFrame([(100, 5.0, 5.0), (101, 5.0, 15.0)], "code int, lat double, lon double")
    stations = spark.createDataFrame([
        ("low", "n", 1.0, 1.0, 500), ("tie", "n", 2.0, 2.0, 500), ("high", "n", 3.0, 3.0, 1600),
        ("poor", "n", 4.0, 4.0, 100), ("dead", "n", 1.0, 11.0, 100), ("far", "n", 1.0, 99.0, 1)],
        "station_id string, name string, lat double, lon double, elev int")
    seen = spark.createDataFrame(
        [(s, at(0), 1.0, 1.0) for s in ("low", "tie", "high")] + [("poor", at(0), 1.0, None),
                                                                 ("dead", at(0), None, None)],
        "station_id string, date date, precipitation_total double, temperature_mean double")
    seen = seen.withColumns({c: F.lit(None).cast("double") for c in (
        "humidity_mean", "wind_speed_mean", "atmospheric_pressure_mean", "solar_rad_total")})
    table = station_table(stations, seen, towns, vertices, 3.0, at(0), at(2))
    assert table.schema.simpleString() == schema_of("weather_station").simpleString()
    assert rows(table, "station_id", "mun_code", "n_sensors") == [
        ("dead", 101, 0), ("high", 100, 2), ("low", 100, 2), ("poor", 100, 1), ("tie", 100, 2)]
    assert rows(link_stations(table)) == [(100, "low"), (100, "tie")]
    assert rows(link_stations(table, elevation_limit=1601), "station_id") == [("low",), ("tie",)]
    with pytest.raises(ValueError):
        link_stations(table, rule="nearest")


def test_stations_are_linked_without_the_joined_table(spark, rows):
    """Overlapping polygons, ties, repeated and unplaced rows: the links are those of the joined table."""
    rng = random.Random(4)
    square = [(m, 0, i, x + 2.0 * (m % 4), y + 2.0 * (m // 4)) for m in range(12)
              for i, (x, y) in enumerate([(0.0, 0.0), (5.0, 0.0), (5.0, 5.0), (0.0, 5.0)])]
    vertices = spark.createDataFrame(square, "poly_id int, ring int, seq int, x double, y double")
    towns = spark.createDataFrame([(c, rng.uniform(0, 10), rng.uniform(0, 12)) for c in [*range(15), 3, None, 40_000]], "code int, lat double, lon double")
    stations = spark.createDataFrame([(f"s{i % 50}" if i else None, "n", rng.uniform(0, 10), rng.uniform(0, 12), rng.choice([None, 100, 200, 1700]))
                                      for i in range(60)], "station_id string, name string, lat double, lon double, elev int")
    seen = spark.createDataFrame([(f"s{i}", at(0), 1.0 if i % 3 else None, 1.0 if i % 2 else None) for i in range(45)],
                                 "station_id string, date date, a double, b double")
    args = stations, seen, towns, vertices, 3.0, at(0), at(2), {"a": "precipitation_available", "b": "temperature_available"}
    path = scratch_path(spark, "stations-joined")
    station_table(*args).write.parquet(path)
    want = rows(link_stations(spark.read.parquet(path)))
    found = link_stations(station_table(*args, joined=False))
    assert rows(found) == want and len(want) > 15 and len(set(want)) < len(want)
    assert "stations-joined" not in found._jdf.queryExecution().executedPlan().toString()


def test_update_all_reports_and_is_idempotent(spark, rows):
    df = spark.createDataFrame([("a", at(n), n) for n in range(5)], "k string, date date, v int")
    path = scratch_path(spark, "entity")
    broken = df.select(F.col("k"), F.col("date"), F.raise_error(F.lit("boom")).alias("v"))
    entities = {"good": Entity(df, path, ["k"]), "bad": Entity(broken, scratch_path(spark, "bad"), ["k"]),
                "skipped": Entity(df, path, ["k"])}
    report = update_all(spark, entities, skip=["skipped"])
    assert rows(report, "entity", "status", "records") == [("bad", "failed", 0), ("good", "success", 5)]
    assert rows(update_all(spark, entities, selected=["good"]), "records") == [(0,)]
    assert read_loads(spark, path).count() == 5
    split = {"split": Entity(df.filter(F.col("date") < at(3)), scratch_path(spark, "split"), ["k"],
                             partition_by=["date"])}
    assert rows(update_all(spark, split), "status", "records") == [("success", 3)]
    split["split"] = split["split"]._replace(landed=df)
    assert rows(update_all(spark, split), "status", "records") == [("success", 2)]
    assert rows(spark.read.parquet(split["split"].path), "date", "v") == [(at(n), n) for n in range(5)]


def test_static_tables(spark, rows):
    codes = spark.createDataFrame([(1, 46.0, 11.0), (2, 46.5, 11.5), (9, 1.0, 1.0)], "code int, lat double, lon double")
    towns = spark.createDataFrame([(1, "X", 10), (2, "Y", 20)], "code int, name string, population int")
    municipality, province = load_static(codes, towns, "P", 22)
    assert rows(municipality, "code", "province", "population") == [(1, "P", 10), (2, "P", 20)]
    assert rows(province) == [("P", 22, 30)]


@pytest.fixture(scope="module")
def curated(spark):
    rng = random.Random(8)
    data = []
    for region in ("A", "B"):
        level = 40.0
        for n in range(150):
            level = max(5.0, level + rng.gauss(0, 2))
            if n not in (30, 31, 77):
                data.append((region, at(n), int(level + 5 * (n % 7 == 0)), 50.0 + n % 13))
    return spark.createDataFrame(data, "region string, date date, new_cases int, stringency_index double")


CONF = {"p_values": [0, 1], "d_values": [1], "q_values": [0, 1], "P_values": [0], "Q_values": [0],
        "cv_n_splits": 5, "cv_max_test_size": 7}


def test_tuning_run_document(spark, curated):
    run = tune(curated, CONF)
    assert run.select("log", "configuration", "results").schema.simpleString() \
        == schema_of("hyperparameters").simpleString()
    row = run.filter("region = 'A'").first()
    assert row["configuration"]["outputs"] == ["new_cases"] and row["configuration"]["cv_n_splits"] == 5
    assert [d.date() for d in row["log"]["date_range"]] == [at(0), at(149)]
    assert (row["log"]["splits_train_size_min"], row["log"]["splits_train_size_max"],
            row["log"]["splits_test_size"]) == (25, 125, 7)
    scores = [r["score_mean"] for r in row["results"]]
    assert len(scores) == 4 and scores == sorted(scores)


def test_forecast_run_uses_best_config_and_replaces(spark, curated, rows):
    path = scratch_path(spark, "runs")
    tune(curated, CONF).unionByName(tune(curated, {**CONF, "regressors": ["stringency_index"]})) \
        .write.parquet(path)
    runs = spark.read.parquet(path)
    models = [{"output": "new_cases", "regressors": []},
              {"output": "new_cases", "regressors": ["stringency_index"]}]
    made = forecast_run(curated, runs, models, steps=9)
    assert made.count() == 2 * 2 * 9
    assert made.filter("date <= DATE '2021-05-30' OR lower_ci > forecast OR upper_ci < forecast "
                       "OR forecast IS NULL").count() == 0
    alone = forecast_run(curated, runs, models[:1])
    kept = scratch_path(spark, "forecasts")
    assert store_forecasts(alone.withColumn("output_variable", F.lit("other")), kept) == 14
    assert store_forecasts(alone, kept) == 14 and store_forecasts(alone, kept) == 14
    assert spark.read.parquet(kept).count() == 28
    assert read_forecasts(spark, kept, "new_cases", hi="2021-05-31").count() == 2
    stored = replace_by_key(alone, replace_by_key(alone, made.limit(0), ["output_variable"]), ["output_variable"])
    assert stored.count() == 14
    series = model_series(curated, ["region"], "date", "new_cases", [])
    assert series.count() == 300 and series.filter("new_cases IS NULL").count() == 0
    assert fit(series, ["region"], "date", "new_cases", [], Config(1, 1, 1), "sqrt").count() == 2


def test_a_stored_run_knows_its_time(spark, curated, caplog):
    path = scratch_path(spark, "runs")
    gap = curated.withColumn("new_cases", F.when(F.col("date") != at(40), F.col("new_cases")))
    missing = gap.filter("new_cases IS NULL").count()
    for _ in range(2):
        assert run_tuning(gap, path, CONF, name="first") == 2
    assert f"new_cases has {missing} missing values" in caplog.text
    runs = read_loads(spark, path)
    assert runs.count() == 2 and runs.schema.simpleString() == tune(gap, CONF).schema.simpleString()
    assert all(r.log.elapsed_time.startswith("0:") for r in runs.collect())
    assert run_tuning(gap, path, CONF, name="second") == 2 and read_loads(spark, path).count() == 4


def test_no_stored_run_gives_no_forecast(spark, curated):
    runs = empty_table(spark, "hyperparameters").withColumn("region", F.lit("A"))
    assert forecast_run(curated, runs, [{"output": "new_cases", "regressors": []}]).count() == 0


def test_micro_batches_add_up_and_a_repeated_batch_does_not_count_twice(spark, rows, tmp_path):
    base = str(tmp_path)
    landing, target, state, marks = (os.path.join(base, n) for n in ("in", "out", "state", "marks"))
    df = spark.createDataFrame([(k, at(n), n + 1) for k in "ab" for n in range(9)], "k string, date date, v long")
    spent = df.limit(0)
    for lo, hi in ((0, 2), (3, 5), (6, 8)):
        part = df.filter(F.col("date").between(at(lo), at(hi)))
        part.write.mode("append").parquet(landing)
        totals_stream(spark, landing, df.schema, target, state, marks, ["k"], "date", {"v": "t"}).awaitTermination()
        spent = spent.unionByName(part)
        got = read_totals(spark, target, ["k"], "date")
        assert rows(got, "k", "date", "t") == sorted(
            ((r["k"], r["date"], sum(range(1, r["v"] + 1))) for r in spent.collect()), key=repr)
    # the last batch again, as after a failure between its output and its commit
    last = df.filter(F.col("date") >= at(6))
    write_batch(last, 2, target, state, ["k"], "date", {"v": "t"})
    assert read_totals(spark, target, ["k"], "date").count() == 18
    assert read_totals(spark, target, ["k"], "date").agg(F.max("t")).first()[0] == 45
    # one more file of a day that was seen: its rows count, on that day and after it
    df.filter(F.col("date") == at(4)).write.mode("append").parquet(landing)
    totals_stream(spark, landing, df.schema, target, state, marks, ["k"], "date", {"v": "t"}).awaitTermination()
    got = {r["date"]: r["t"] for r in read_totals(spark, target, ["k"], "date").filter("k = 'a'").collect()}
    assert got == {at(n): (n + 1) * (n + 2) // 2 + (5 if n >= 4 else 0) for n in range(9)}


@pytest.mark.parametrize("max_files", [None, 1, 2])
def test_batches_do_not_change_totals(spark, rows, tmp_path, max_files):
    landing, target, state, marks = (str(tmp_path / n) for n in ("in", "out", "state", "marks"))
    df = spark.createDataFrame([("a", at(n % 2), 1) for n in range(32)], "k string, date date, v long")
    df.repartition(4).write.parquet(landing)
    totals_stream(spark, landing, df.schema, target, state, marks, ["k"], "date", {"v": "t"}, max_files=max_files).awaitTermination()
    assert rows(read_totals(spark, target, ["k"], "date"), "date", "v", "t") == [(at(0), 16, 16), (at(1), 16, 32)]


def test_blocks_of_batches():
    for n in range(300):
        blocks = blocks_before(n)
        assert [i for a, b in blocks for i in range(a, b)] == list(range(n)) and len(blocks) <= n.bit_length()
        sizes = [b - a for a, b in blocks]
        assert sizes == sorted(set(sizes), reverse=True) and all(s & (s - 1) == 0 for s in sizes)


@pytest.mark.parametrize("fails_at", range(8))
def test_state_is_merged_and_a_batch_that_fails_in_a_merge_is_repeated(spark, rows, tmp_path, monkeypatch, fails_at):
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    rng = random.Random(fails_at)
    batches = [[("ab"[rng.randrange(2)], at(rng.randrange(4)), rng.randrange(9)) for _ in range(5)] for _ in range(8)]
    frames = [spark.createDataFrame(b, "k string, date date, v long") for b in batches]
    write, read, opened = DataFrameWriter.parquet, DataFrameReader.parquet, []

    def failing(self, place, *a, **b):
        write(self, place, *a, **b)
        if "first=" in place and f"end={fails_at + 1}" in place and f"first={fails_at}-" not in place:
            raise RuntimeError("the merge fails")

    def noted(self, *places, **b):
        opened.append([p for p in places if "first=" in p])
        return read(self, *places, **b)
    for n, batch in enumerate(frames):
        if n == fails_at:
            with monkeypatch.context() as m:
                m.setattr(DataFrameWriter, "parquet", failing)
                with suppress(RuntimeError):
                    write_batch(batch, n, target, state, ["k"], "date", {"v": "t"})
        with monkeypatch.context() as m:
            m.setattr(DataFrameReader, "parquet", noted)
            write_batch(batch, n, target, state, ["k"], "date", {"v": "t"})
        assert max(map(len, opened)) <= 4
        if n % 3 == 2:
            drop_merged(spark, state, n + 1)
    sums = {}
    for k, d, v in (r for b in batches for r in b):
        sums[k, d] = sums.get((k, d), 0) + v
    want = [(k, d, v, sum(x for (q, e), x in sums.items() if q == k and e <= d)) for (k, d), v in sorted(sums.items())]
    assert rows(read_totals(spark, target, ["k"], "date"), "k", "date", "v", "t") == sorted(want, key=repr)
    drop_merged(spark, state, 8)
    assert sorted(x for x in os.listdir(state) if x.startswith("first=")) == sorted(
        f"first={a}-end={b}" for a, b in {*blocks_before(7), *blocks_before(8)})


def test_forecasts_of_other_series_stay(spark, tmp_path):
    path = str(tmp_path / "f")
    made = spark.createDataFrame([(k, "y", at(n), float(n)) for k in ("01", "02") for n in range(3)],
                                 "region string, output_variable string, date date, forecast double")
    assert store_forecasts(made, path) == 6 and store_forecasts(made.filter("region = '01'"), path) == 3
    kept = spark.read.schema(made.schema).parquet(path)
    assert kept.count() == 6 and {r.region for r in kept.collect()} == {"01", "02"}
