import pytest
from pyspark.sql import functions as F

from dayline.sinks.audit import audit_keys, load_report, orphans
from dayline.sinks.changes import (apply_changes, change_counts, count_where, delete_where, find,
                                   modified_count, update_where)
from dayline.sinks.tables import (append_checked, insert_if_absent, overwrite, replace_by_key,
                                  replace_partitions)


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, "a", None), (4, None, 8)],
                                 "id int, s string, n int")


def test_append_counts_and_refuses_a_wrong_count(spark, table, tmp_path):
    path = str(tmp_path / "t")
    assert append_checked(table, path, expected=4) == 4
    assert append_checked(table, path) == 4
    assert spark.read.parquet(path).count() == 8
    with pytest.raises(ValueError):
        append_checked(table, path, expected=5)


def test_overwrite_and_partition_replacement(spark, table, tmp_path, rows):
    path = str(tmp_path / "t")
    overwrite(table, path, ["s"])
    replace_partitions(table.filter("s = 'a'").withColumn("n", F.lit(0)), path, ["s"])
    assert rows(spark.read.parquet(path), "id", "n") == [(1, 0), (2, 6), (3, 0), (4, 8)]
    overwrite(table.filter("id = 2"), path, ["s"])
    assert spark.read.parquet(path).count() == 1


def test_insert_twice_changes_nothing(spark, table, rows):
    new = spark.createDataFrame([(2, "x", 1), (9, "old", 1), (9, "new", 2)], "id int, s string, n int")
    once = table.unionByName(insert_if_absent(new, table, ["id"], "n"))
    assert rows(once.filter("id = 9"), "s") == [("new",)] and once.count() == 5
    assert insert_if_absent(new, once, ["id"], "n").count() == 0


def test_replace_by_key_twice(spark, table, rows):
    new = spark.createDataFrame([(7, "a", 1), (8, "a", 2)], "id int, s string, n int")
    once = replace_by_key(new, table, ["s"])
    assert rows(once, "id") == [(2,), (4,), (7,), (8,)]
    assert rows(replace_by_key(new, once, ["s"])) == rows(once)


def test_find_sorts_limits_and_projects(table):
    assert [r["id"] for r in find(table, None, ["id"], ("id", -1), limit=2).collect()] == [4, 3]
    assert find(table, {"s": "a"}, limit=None).count() == 2


def test_update_many_and_one(table, rows):
    out = update_where(table, {"s": "a"}, {"n": 0})
    assert rows(out, "id", "n") == [(1, 0), (2, 6), (3, 0), (4, 8)]
    out = update_where(table, {"s": "a"}, {"n": 0}, only_one=True, order_by=["id"])
    assert rows(out, "id", "n") == [(1, 0), (2, 6), (3, None), (4, 8)]
    assert tuple(modified_count(table, {"s": "a"}, {"n": 5}).first()) == (2, 1)
    with pytest.raises(ValueError):
        update_where(table, {"s": "a"}, {"n": 0}, only_one=True)


def test_delete_keeps_rows_where_the_condition_is_unknown(table, rows):
    assert rows(delete_where(table, {"s": "a"}), "id") == [(2,), (4,)]
    assert rows(delete_where(table, {"s": "a"}, only_one=True, order_by=["id"]), "id") == [(2,), (3,), (4,)]
    assert delete_where(table, {}, delete_all=True).count() == 0
    with pytest.raises(ValueError):
        delete_where(table, {})
    with pytest.raises(ValueError):
        delete_where(table, {"s": "a"}, delete_all=True)


def test_nothing_matches_only_one(table):
    assert delete_where(table, {"s": "zzz"}, only_one=True, order_by=["id"]).count() == 4


def test_bulk_changes(spark, table, rows):
    changes = spark.createDataFrame([
        (1, "q", 1, 1, "update"), (1, "r", 2, 2, "update"), (2, None, None, 3, "delete"),
        (7, "new", 7, 4, "insert"), (8, "up", 8, 5, "upsert"), (9, "none", 9, 6, "update"),
        (3, "a", None, 7, "upsert"), (10, "x", 1, 8, "delete")],
        "id int, s string, n int, seq int, op string")
    assert rows(apply_changes(table, changes, ["id"])) == sorted(
        [(1, "r", 2), (3, "a", None), (4, None, 8), (7, "new", 7), (8, "up", 8)], key=repr)
    assert change_counts(table, changes, ["id"]).first().asDict() == {
        "matched": 2, "inserted": 1, "modified": 1, "upserted": 1, "deleted": 1}


def test_audits(spark, table, rows):
    assert rows(audit_keys(table, ["s"]), "s", "n_rows") == [("a", 2)]
    parents = spark.createDataFrame([("a",)], "name string")
    assert rows(orphans(table, parents, {"s": "name"}), "id") == [(2,)]
    assert count_where(table, {"s": "a"}).first()["n"] == 2
    assert count_where(table).first()["n"] == 4
    dated = table.withColumn("date", F.lit("2021-01-01").cast("date"))
    report = load_report({"t": (dated, "date"), "e": (dated.filter("false"), "date")})
    assert rows(report, "entity", "status", "records") == [("e", "empty", 0), ("t", "loaded", 4)]
