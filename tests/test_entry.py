"""What the entry module offers, with and without its optional part."""

import os
import subprocess
import sys
from textwrap import dedent

import __spark_entry__ as entry
from dayline.session import scratch_path
from dayline.sinks.audit import audit_entities

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_lives_without_the_libraries_of_its_optional_part():
    """xxhash and tokenizers cannot be imported: the other queries are there, none of the optional ones."""
    code = dedent(f"""
        import sys
        for name in ("xxhash", "tokenizers", "public_tokenizers"):
            sys.modules[name] = None
        sys.path.insert(0, {ROOT!r})
        import __spark_entry__ as e
        names = e.queries()
        assert len(names) > 140 and not [n for n in names if n.startswith("op1_")] and set(e.oracle_sql()) <= set(names)
    """)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


def test_queries_ship_the_package(spark, monkeypatch):
    """A session that build_session did not make gets the package with its first query."""
    from dayline import session
    monkeypatch.setattr(session, "_shipped", set())
    added = []
    monkeypatch.setattr(type(spark.sparkContext), "addPyFile", lambda self, path: added.append(path))
    for _ in range(2):
        entry.queries()["deleted_orders"](spark, "/root/testdata/sf0.001")
    assert len(added) == 1 and added[0].endswith("dayline-package.zip")


def test_declared_keys_and_references(spark, rows):
    make = spark.createDataFrame
    tables = {
        "province": make([("P",), ("Q",), ("Q",)], "name string"),
        "province_data": make([("P", "2021-01-01"), ("Q", "2021-01-01"), ("P", "2021-01-01"), ("R", "2021-01-02")], "name string, date string"),
        "municipality": make([(1, "P"), (2, None)], "code int, province string"),
        "municipality_station_link": make([(1, "a"), (3, "a")], "municipality_code int, station_id string")}
    found = rows(audit_entities(tables), "entity", "check", "columns", "n")
    assert found == [("municipality", "key", "code", 0), ("municipality", "reference", "province", 0),
                     ("municipality_station_link", "reference", "municipality_code", 1), ("province", "key", "name", 1),
                     ("province_data", "key", "name,date", 1), ("province_data", "reference", "name", 1)]
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
