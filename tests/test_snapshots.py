"""Histories of landed files: what is listed, chosen and opened."""

import datetime as dt
import os

from dayline.sources.landed import municipality_files
from dayline.sources.snapshots import landed_files, newest_files, scan_newest


def history(tmp_path, files):
    for name, text in files.items():
        place = tmp_path / "2020-01-01 a+b%20" / name  # a day above the history is not of it
        os.makedirs(place.parent, exist_ok=True)
        place.write_text(text)
    return str(tmp_path / "2020-01-01 a+b%20")


FILES = {"t_2021-03-01T10-00.csv": "k,v\n1,old\n", "t_2021-03-01T18-30.csv": "k,v\n1,new\n2,new\n",
         "deep/t_2021-03-02T09-00.csv": "k,v\n3,only\n", "t_2021-03-04T09-00.csv": "k,v\n9,late\n", "notes.csv": "k,v\n0,none\n"}


def test_only_chosen_files_are_opened(spark, rows, tmp_path):
    path = history(tmp_path, FILES)
    listed = landed_files(spark, path)
    assert rows(listed, "day", "version") == [
        (dt.date(2021, 3, 1), "T10-00.csv"), (dt.date(2021, 3, 1), "T18-30.csv"), (dt.date(2021, 3, 2), "T09-00.csv"), (dt.date(2021, 3, 4), "T09-00.csv")]
    assert newest_files(listed).count() == 3
    got = scan_newest(spark, path, "k int, v string", hi="2021-03-03", header=True)
    assert rows(got, "k", "v", "_day") == [(1, "new", dt.date(2021, 3, 1)), (2, "new", dt.date(2021, 3, 1)), (3, "only", dt.date(2021, 3, 2))]
    assert sorted(f.rpartition("/")[2] for f in got.inputFiles()) == ["t_2021-03-01T18-30.csv", "t_2021-03-02T09-00.csv"]
    for name in ("t_2021-03-01T10-00.csv", "t_2021-03-04T09-00.csv"):
        os.chmod(os.path.join(path, name), 0)  # unreadable, and of no concern
    assert got.count() == 3


def test_no_file_in_range(spark, tmp_path):
    got = scan_newest(spark, history(tmp_path, FILES), "k int, v string", lo="2022-01-01", header=True)
    assert got.count() == 0 and got.columns == ["k", "v", "_day", "_version"]


def test_keys_and_versions_of_several_files(spark, rows, tmp_path):
    files = {f"{area}/2021-03-0{d}/{version}/part-{n}.csv": f"{d},{version}{n}\n"
             for area in "NS" for d in (1, 2) for version in ("a", "b") for n in range(2) if not (area == "S" and version == "b")}
    path = history(tmp_path, files)
    got = scan_newest(spark, path, "k int, v string", version=r"/([ab])/", keys={"area": r"^([NS])/"})
    assert rows(got, "area", "k", "v") == sorted([("N", d, f"b{n}") for d in (1, 2) for n in range(2)] + [("S", d, f"a{n}") for d in (1, 2) for n in range(2)])


def test_versions_by_time_of_change(spark, rows, tmp_path):
    path = history(tmp_path, {"x-2021-03-01-b.csv": "1,first\n", "x-2021-03-01-a.csv": "1,second\n"})
    os.utime(os.path.join(path, "x-2021-03-01-b.csv"), (1e9, 1e9))
    assert rows(scan_newest(spark, path, "k int, v string", version=None), "v") == [("second",)]


def test_municipalities_from_files(spark, rows, tmp_path):
    head = "codice,nome,contagi,guariti,decessi,aggiornamento,lat,lon\n"
    path = history(tmp_path, {"2021-03-01T1.csv": head + "7,A,1,0,0,01/03/2021,0,0\n", "2021-03-01T2.csv": head + "7,A,4,0,0,01/03/21,0,0\n"})
    got = municipality_files(spark, path, "2021-01-01", "2021-12-31")
    assert rows(got, "date", "code", "cases") == [(dt.date(2021, 3, 1), 7, 4)]
