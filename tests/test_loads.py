"""Loads: what counts, what a failure leaves, and what is read."""

import datetime as dt

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from dayline.operators.incremental import rows_after
from dayline.plans.curation import SEED, Sources, curate, run_curation
from dayline.plans.loading import Entity, update_entity
from dayline.session import scratch_path
from dayline.sinks.loads import Latest, append_load, read_latest, read_loads

DAY = dt.date(2024, 1, 1)


def frame(spark, *rows):
    return spark.createDataFrame([(k, DAY + dt.timedelta(n), v) for k, n, v in rows], "k string, date date, v int")


def test_a_wrong_count_changes_nothing(spark, rows):
    path, kept = scratch_path(spark, "t"), Latest(["k"], "date", ["v"])
    assert append_load(frame(spark, ("a", 0, 1), ("b", 1, 2)), path, expected=2, latest=kept) == 2
    before = rows(read_loads(spark, path)), rows(read_latest(spark, path))
    with pytest.raises(ValueError, match="expected 7"):
        append_load(frame(spark, ("a", 5, 9)), path, expected=7, latest=kept)
    assert (rows(read_loads(spark, path)), rows(read_latest(spark, path))) == before


@pytest.mark.parametrize("step", ["_load=", "_latest", "_commits"])
@pytest.mark.parametrize("after", [False, True])
def test_a_kill_between_the_steps_changes_nothing(spark, rows, monkeypatch, step, after):
    """The rows, the newest rows and the line are three writes; the process ends before or after one."""
    path, kept = scratch_path(spark, "t"), Latest(["k"], "date")
    append_load(frame(spark, ("a", 0, 1)), path, "one", latest=kept)
    write = DataFrameWriter.parquet

    def killed(self, place, *a, **b):
        last = step in place and not self._df.isEmpty()  # the folder of lines is also made, empty
        if not last or after:
            write(self, place, *a, **b)
        if last:
            raise KeyboardInterrupt
    monkeypatch.setattr(DataFrameWriter, "parquet", killed)
    with pytest.raises(KeyboardInterrupt):
        append_load(frame(spark, ("a", 3, 7), ("b", 2, 5)), path, latest=kept)
    monkeypatch.undo()
    published = after and step == "_commits"
    assert rows(read_loads(spark, path), "k", "v") == [("a", 1)] + [("a", 7), ("b", 5)] * published
    assert rows(read_latest(spark, path), "k") == [("a",)] + [("b",)] * published
    append_load(frame(spark, ("a", 3, 7), ("b", 2, 5)), path, latest=kept)
    assert read_loads(spark, path).count() == 3 + 2 * published
    assert rows(read_latest(spark, path)) == [("a", DAY + dt.timedelta(3)), ("b", DAY + dt.timedelta(2))]


def test_a_repeated_name_is_loaded_once(spark, rows):
    path = scratch_path(spark, "t")
    for _ in range(2):
        assert append_load(frame(spark, ("a", 0, 1), ("a", 1, 2)), path, "2024-01-01") == 2
    assert append_load(frame(spark, ("c", 0, 3)), path) == 1
    assert rows(read_loads(spark, path), "k", "v") == [("a", 1), ("a", 2), ("c", 3)]
    with pytest.raises(ValueError, match="named"):
        append_load(frame(spark, ("a", 0, 1)), path, "../x")


def test_replacement_partitions_and_empty_loads(spark, rows):
    path, kept = scratch_path(spark, "t"), Latest(["k"], "date", ["v"])
    assert read_latest(spark, path) is None
    with pytest.raises(ValueError, match="nothing"):
        read_loads(spark, path)
    none = frame(spark, ("a", 0, 1)).filter("false")
    assert append_load(none, path, latest=kept, partition_by=["date"]) == 0
    assert read_loads(spark, path).count() == 0 and read_latest(spark, path).count() == 0
    append_load(frame(spark, ("a", 0, 1), ("b", 1, None)), path, latest=kept, partition_by=["date"])
    assert rows(read_loads(spark, path)) == [("a", DAY, 1), ("b", DAY + dt.timedelta(1), None)]
    append_load(frame(spark, ("z", 4, 4)), path, latest=kept, partition_by=["date"], replace=True)
    append_load(frame(spark, ("z", 3, 3)), path, latest=kept, partition_by=["date"])
    assert rows(read_loads(spark, path), "k", "v") == [("z", 3), ("z", 4)]
    assert rows(read_latest(spark, path)) == [("z", DAY + dt.timedelta(4), 4)]


def test_marks_of_loads_that_kept_none(spark, rows):
    path, kept = scratch_path(spark, "t"), Latest([], "date")
    append_load(frame(spark, ("a", 0, 1), ("b", 6, 2)), path)
    assert read_latest(spark, path) is None
    assert rows(read_latest(spark, path, kept)) == [(DAY + dt.timedelta(6),)]
    append_load(frame(spark, ("a", 2, 1)), path, latest=kept)
    assert rows(read_latest(spark, path)) == [(DAY + dt.timedelta(6),)]


def test_updates_read_no_stored_rows(spark):
    path, landed = scratch_path(spark, "t"), scratch_path(spark, "landed")
    frame(spark, *[(k, n, n) for k in "ab" for n in range(9)]).write.parquet(landed)
    entity = Entity(spark.read.parquet(landed).filter("v < 5"), path, ["k"])
    assert update_entity(spark, entity) == 10
    fresh = rows_after(spark.read.parquet(landed), read_latest(spark, path), ["k"], "date")
    assert fresh.count() == 8
    read = [f for f in rows_after(spark.read.parquet(landed), read_latest(spark, path), ["k"], "date", measured=False).inputFiles()]
    assert any("_latest" in f for f in read) and not any("_load=" in f for f in read)
    assert update_entity(spark, entity._replace(landed=spark.read.parquet(landed))) == 8
    assert read_loads(spark, path).count() == 18


def test_curation_reads_no_curated_rows(spark):
    days = [DAY + dt.timedelta(n) for n in range(6)]
    make = spark.createDataFrame
    sources = Sources(
        make([(d, "A", 1, i, None) for i, d in enumerate(days)], "date date, region string, cases int, deaths int, hospitalized int"),
        make([(d, "A", "red") for d in days], "date date, region string, risk string"), make([(d, 1.0) for d in days], "date date, value double"),
        make([(d, "A", "90+", 2, 1) for d in days], "date date, region string, age_group string, first_dose int, second_dose int"),
        make([("x", days[0], days[1])], "holiday string, start date, end date"), make([("A", 10)], "region string, population int"))
    path = scratch_path(spark, "curated")
    assert run_curation(spark, sources, path, hi=days[2]) == 3
    fresh = curate(sources, None, None, None, read_latest(spark, path, SEED))
    read = fresh.inputFiles()
    assert any("_latest" in f for f in read) and not any("_load=" in f for f in read)
    assert [r.first_doses for r in fresh.orderBy("date").select("first_doses").collect()] == [8, 10, 12]
    assert run_curation(spark, sources, path) == 3 and read_loads(spark, path).agg(F.sum("new_first_doses")).first()[0] == 12
