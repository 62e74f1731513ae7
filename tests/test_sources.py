import datetime as dt
import json
from html import unescape
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from dayline.operators.filters import scan_between
from dayline.sources import landed
from dayline.sources.documents import (explode_country_index, explode_events, html_rows, scan_stations,
                                       station_days)
from dayline.sources.files import csv_headers, scan, scan_csv, scan_documents, scan_json_array, scan_json_records
from dayline.sources.snapshots import latest_snapshot_per_day


def docs(spark, *texts):
    return spark.createDataFrame([(t if isinstance(t, str) else json.dumps(t),) for t in texts], "value string")


def test_csv_by_name_with_bad_values(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("name,extra,code,population\nX,1,7,12\nY,2,oops,\n")
    out = scan_csv(spark, str(tmp_path), "province")
    assert rows(out) == [("X", 7, 12), ("Y", None, None)]


def test_json_records_and_documents(spark, tmp_path, rows):
    (tmp_path / "r.json").write_text('[{"region": "A", "risk": "red"},\n {"region": "B"}]')
    out = scan_json_records(spark, str(tmp_path), "region string, risk string")
    assert rows(out) == [("A", "red"), ("B", None)]
    assert scan_documents(spark, str(tmp_path)).count() == 1


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("block", ["128MB", "700"])
def test_one_large_json_array(spark, tmp_path, rows, indent, block):
    """Blocks that end within records, strings and escapes; braces and quotes in strings; nested records."""
    texts = ["plain", "", '}, {"a": 1', "{{", "}}]", '\\', '\\"', 'a\\\\"}', "[{]", "é漢\n}", None]
    found = [{"n": i, "t": texts[i % len(texts)], "in": {"x": [i, i + 1], "s": texts[i % 7]} if i % 4 else None} for i in range(300)]
    (tmp_path / "a.json").write_text(json.dumps(found, indent=indent, ensure_ascii=False))
    (tmp_path / "b.json").write_text("\n" + json.dumps([{"n": 1000 + i, "other": {}} for i in range(50)], indent=indent) + "\n\n")
    for name, text in (("c", "[]"), ("d", ""), ("e", ' [ {"n": 2000} , {} ] ')):
        (tmp_path / f"{name}.json").write_text(text)
    schema = "n int, t string, in struct<x:array<int>,s:string>"
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        tasks = spark.read.text(str(tmp_path), lineSep="}").select(F.spark_partition_id()).distinct().count()
        got = rows(scan_json_array(spark, str(tmp_path), schema))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == rows(spark.read.schema(schema).json(str(tmp_path), multiLine=True)) and len(got) == 352
    assert block != "700" or tasks > 20


def test_stored_table_fits_its_schema(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("X", 1, "5")], "name string, code int, population string").write.parquet(path)
    assert scan(spark, path, "province").dtypes == [("name", "string"), ("code", "smallint"), ("population", "int")]


def test_country_index_and_error_documents(spark, rows):
    good = {"data": {"2021-01-02": {"ITA": {"stringency": 70.5}, "FRA": {"stringency": 1}},
                     "2021-01-03": {"FRA": {"stringency": 2}}}}
    out = explode_country_index(docs(spark, good, {"status": "error", "code": 404},
                                     {"status": "error", "code": 500, "data": {}}, "not json"), "ITA")
    assert rows(out) == [(dt.date(2021, 1, 2), 70.5)]


def test_calendar_items(spark, rows):
    doc = {"items": [{"summary": "Easter", "start": {"date": "2021-04-04"}, "end": {"date": "2021-04-05"}}]}
    assert rows(explode_events(docs(spark, doc, {"items": []}))) == [
        ("Easter", dt.date(2021, 4, 4), dt.date(2021, 4, 5))]


def test_active_stations(spark, rows):
    def record(i, end):
        return {"id": i, "nome": "N" + i, "lat": 46.0, "lon": 11.0, "elev": 900, "est": 1, "nord": 2,
                "fine": end, "inizio": "1/1/1990"}
    feed = docs(spark, {"records": [record("T1", ""), record("T2", "31/12/2010")]})
    assert rows(scan_stations(feed), "station_id", "name", "elev") == [("T1", "NT1", 900.0)]
    assert scan_stations(feed, active_only=False).count() == 2


PAGE = """<html><body><TABLE border=1>
<tr><th colspan=2>Station</th></tr><tr><td>daily</td></tr>
<tr><td>Date</td><td>Temp. aria (°C)</td><td>Qual</td><td>Pioggia (mm)</td></tr>
<tr><td></td><td>mean</td><td></td><td>sum</td></tr>
<tr><td>00:00:00 02/03/2021</td><td> <b>7.5</b></td><td>1</td><td>0.0</td></tr>
<tr><td>00:00:00 01/03/2021</td><td></td><td>1</td><td>&nbsp;2.4</td></tr>
<tr><td>00:00:00 03/03/2021</td><td></td><td>1</td><td></td></tr>
<tr><td></td><td>1</td><td>1</td><td>1</td></tr>
</TABLE><table><tr><td>other</td></tr></table></body></html>"""


def test_station_page(spark, rows):
    pages = spark.createDataFrame([("T1", PAGE), ("T2", "<p>down</p>")], "station_id string, html string")
    out = station_days(pages)
    assert rows(out, "station_id", "date", "temperature_mean", "precipitation_total", "humidity_mean") == [
        ("T1", dt.date(2021, 3, 1), None, 2.4, None), ("T1", dt.date(2021, 3, 2), 7.5, 0.0, None)]
    assert html_rows(pages).count() == 8


def test_newest_version_of_a_day_wins(spark, rows):
    df = spark.createDataFrame([(1, 10, "a"), (1, 12, "b"), (1, 12, "c"), (2, 9, "d"), (3, 1, "e")],
                               "day int, version int, row string")
    assert rows(latest_snapshot_per_day(df, "day", "version", lo=1, hi=2), "row") == [("b",), ("c",), ("d",)]


@pytest.mark.parametrize("lo_open, expected", [(False, [1, 2, 3]), (True, [2, 3])])
def test_ranges(spark, lo_open, expected):
    df = spark.createDataFrame([(i,) for i in range(6)], "v int")
    assert sorted(r["v"] for r in scan_between(df, "v", 1, 3, lo_open).collect()) == expected
    assert scan_between(df, "v").count() == 6


def test_landed_tables(spark, rows):
    status = spark.createDataFrame([("24/02/2020", "3", "x"), ("22/02/2020", "1", "1")],
                                   "giorno string, totale_pos string, deceduti string")
    assert rows(landed.province_data(status, "P"), "date", "name", "cases", "deaths") == [
        (dt.date(2020, 2, 24), "P", 3, None)]
    risk = spark.createDataFrame([("2021-01-05", "Here", "rosso"), ("2021-01-06", "Here", "nero"),
                                  ("2021-01-06", "There", "bianco")],
                                 "data string, denominazione_regione string, colore string")
    assert rows(landed.region_risk(risk, names={"Here": "H"}, only_named=True), "region", "risk") == [
        ("H", "red"), ("H", None)]
    assert landed.region_risk(risk, "2021-01-05", lo_open=True).count() == 2
    towns = spark.createDataFrame([(1, "A", 10), (2, "B", 20)], "codice int, comune string, abitanti int")
    assert rows(landed.municipality_codes(towns)) == [(1, "A", 10), (2, "B", 20)]


def test_csv_files_with_other_headers(spark, tmp_path, rows):
    """Columns in another order, missing ones, more of them, an empty file and blank lines."""
    (tmp_path / "a.csv").write_text("name,extra,code,population\nX,1,7,12\n")
    (tmp_path / "b.csv").write_text("population,name\r\n5,Y\r\n6,Z\r\n")
    (tmp_path / "c d+e%20.csv").write_text("\n\ncode,name,population\n9,W,\n")
    (tmp_path / "d.csv").write_text("name,extra,code,population\nV,,8,1\n")
    (tmp_path / "e.csv").write_text("")
    out = scan_csv(spark, str(tmp_path), "province")
    assert rows(out) == [("V", 8, 1), ("W", 9, None), ("X", 7, 12), ("Y", None, 5), ("Z", None, 6)]
    headers = csv_headers(spark, str(tmp_path))
    assert rows(headers.groupBy("header").count(), "count") == [(1,), (1,), (2,)]


def test_csv_without_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    assert scan_csv(spark, str(tmp_path), "province").count() == 0


def test_one_header_needs_no_list_of_files(spark, tmp_path, rows):
    """A large file is cut in splits; only the first has a header."""
    (tmp_path / "a.csv").write_text("code,name\n" + "".join(f"{i},n{i}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        assert rows(csv_headers(spark, str(tmp_path)), "header") == [("code,name",)]
        out = scan_csv(spark, str(tmp_path), "province")
        assert out.rdd.getNumPartitions() > 3 and out.count() == 5000 and out.filter("name IS NULL OR code IS NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


NESTED = ("<table><tr><th>a</th><th>b</th></tr>"
          "<tr><td>1<TABLE class=x><tr><td>in</td><td>ner</td></tr><tr><td><table><tr><td>most</td></tr></table></td></tr></TABLE >!</td><td>2</td></tr>"
          "<tr><td>3</td><td>4</td></tr></table><table><tr><td>second</td></tr></table>")


def test_tables_in_cells(spark, rows):
    pages = spark.createDataFrame([(1, NESTED), (2, "<p><table><tr><td>x<table>y"), (3, "</table><table><tr><td>z</td></tr></table><table></table>"),
                                   (4, ""), (5, None)], "page int, html string")
    assert rows(html_rows(pages)) == [(1, 0, ["a", "b"]), (1, 1, ["1innermost!", "2"]), (1, 2, ["3", "4"]), (3, 0, ["z"])]


def test_all_entities(spark):
    """Every named entity with a semicolon, numbers, and what is none, as the standard library reads them."""
    cells = [f"x&{n}y" for n in html5 if n.endswith(";")] + ["&#233;&#xE9;&#x1F600;", "&amp;lt;", "a & b", "&nosuch;", "&;", "&#;", "&&lt;", "&amp;#65;"]
    pages = spark.createDataFrame([(i, f"<table><tr><td>{c}</td></tr></table>") for i, c in enumerate(cells)], "page int, html string")
    got = {r.page: r.cells[0] for r in html_rows(pages).collect()}
    for i, cell in enumerate(cells):
        assert got[i] == unescape(cell).replace(chr(160), " ").strip(" "), cell
