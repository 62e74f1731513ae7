import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from dayline.operators.aggregates import availability, best_per_key, histogram, pivot_sum, top_k
from dayline.operators.filters import gate_complete
from dayline.operators.joins import attach_lookup, cover_flag, newest_per_key
from dayline.operators.spatial import cells_size, contains_join, join_cells, match_through_polygons, polygon_cells
from dayline.session import scratch_path


def day(n, month=1):
    return dt.date(2021, month, n)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


@pytest.fixture
def january(spark):
    return frame(spark, [("a", day(n)) for n in range(1, 11)] + [("b", day(n)) for n in (1, 5)],
                 "region string, date date")


def covered(df, *key):
    return sorted(tuple(r[k] for k in key) + (r["date"].day,) for r in df.filter("holiday").collect())


def test_one_day_three_days_overlap_and_empty(spark, january):
    spans = frame(spark, [("x", day(2), day(3)), ("y", day(4), day(7)), ("z", day(5), day(8)),
                          ("empty", day(9), day(9)), ("reversed", day(10), day(8))],
                  "holiday string, start date, end date")
    out = cover_flag(january.filter("region = 'a'"), spans.drop("holiday"))
    assert covered(out) == [(2,), (4,), (5,), (6,), (7,)]
    assert out.count() == 10


def test_interval_that_starts_before_the_window_counts(spark, january):
    spans = frame(spark, [(dt.date(2020, 12, 20), day(3))], "start date, end date")
    assert covered(cover_flag(january, spans), "region") == [("a", 1), ("a", 2), ("b", 1)]


def test_no_intervals_means_false(spark, january):
    out = cover_flag(january, frame(spark, [], "start date, end date"))
    assert out.filter("holiday").count() == 0 and out.filter("holiday IS NULL").count() == 0


def test_touching_intervals_and_keys(spark, january):
    spans = frame(spark, [("a", day(1), day(3)), ("a", day(3), day(4)), ("b", day(5), day(6))],
                  "region string, start date, end date")
    out = cover_flag(january, spans, keys=["region"])
    assert covered(out, "region") == [("a", 1), ("a", 2), ("a", 3), ("b", 5)]


def test_random_intervals_against_brute_force(spark):
    rng = random.Random(3)
    first = dt.date(2021, 1, 1)
    spans = [(rng.choice("ab"), first + dt.timedelta(rng.randrange(60)), rng.randrange(-2, 9))
             for _ in range(40)]
    spans = [(k, s, s + dt.timedelta(n)) for k, s, n in spans]
    days = [(k, first + dt.timedelta(i)) for k in "ab" for i in range(70)]
    out = cover_flag(frame(spark, days, "k string, date date"),
                     frame(spark, spans, "k string, start date, end date"), keys=["k"])
    got = {(r["k"], r["date"]): r["holiday"] for r in out.collect()}
    assert got == {(k, d): any(s <= d < e for q, s, e in spans if q == k) for k, d in days}


SQUARES = [(1, 0, i, x, y) for i, (x, y) in enumerate([(0, 0), (4, 0), (4, 4), (0, 4)])] + \
          [(1, 1, i, x, y) for i, (x, y) in enumerate([(1, 1), (2, 1), (2, 2), (1, 2)])] + \
          [(2, 0, i, x, y) for i, (x, y) in enumerate([(4, 0), (8, 0), (8, 4), (4, 4)])] + \
          [(3, 0, i, x, y) for i, (x, y) in enumerate([(10, 0), (20, 0), (10, 10)])]


@pytest.mark.parametrize("cell, limit", [(0.5, 1 << 20), (3.0, 1 << 20), (100.0, 0), (0.5, 0)])
def test_points_on_edges_vertices_and_in_holes(spark, rows, cell, limit):
    shapes = frame(spark, [(p, r, s, float(x), float(y)) for p, r, s, x, y in SQUARES],
                   "poly_id int, ring int, seq int, x double, y double")
    points = [(1, 3.0, 3.0), (2, 1.5, 1.5), (3, 4.0, 2.0), (4, 0.0, 0.0), (5, 9.0, 1.0),
              (6, 18.0, 8.0), (7, 11.0, 2.0), (8, None, 1.0), (9, 8.0, 2.0)]
    out = contains_join(frame(spark, points, "point_id int, x double, y double"), shapes, cell,
                        broadcast_limit=limit)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert ("SortMergeJoin" in text) == (limit == 0)
    # the shared edge x=4 goes to one square, the hole to none, the far corner of the box to none
    assert rows(out) == [(1, 1), (3, 2), (4, 1), (7, 3)]


def test_random_points_against_brute_force(spark):
    rng = random.Random(5)
    polys = {}
    for p in range(12):
        cx, cy = rng.uniform(-20, 20), rng.uniform(-20, 20)
        polys[p] = [(cx + rng.uniform(1, 6) * dx, cy + rng.uniform(1, 6) * dy)
                    for dx, dy in ((1, 0), (0.7, 0.7), (0, 1), (-0.7, 0.7), (-1, 0), (0, -1))]
    points = [(i, rng.uniform(-25, 25), rng.uniform(-25, 25)) for i in range(400)]

    def inside(x, y, ring):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
        return odd

    shapes = frame(spark, [(p, 0, i, x, y) for p, ring in polys.items() for i, (x, y) in enumerate(ring)],
                   "poly_id int, ring int, seq int, x double, y double")
    out = contains_join(frame(spark, points, "point_id int, x double, y double"), shapes, 4.0)
    assert {tuple(r) for r in out.select("point_id", "poly_id").collect()} == {
        (i, p) for i, x, y in points for p, ring in polys.items() if inside(x, y, ring)}


def odd(px, py, edges):
    return sum((y1 <= py) != (y2 <= py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1) for x1, y1, x2, y2 in edges) % 2 == 1


def test_cells_hold_what_touches_them(spark):
    shapes = frame(spark, [(p, r, s, float(x), float(y)) for p, r, s, x, y in SQUARES],
                   "poly_id int, ring int, seq int, x double, y double")
    cells = polygon_cells(shapes, 0.5)
    for c in cells.collect():
        for x1, y1, x2, y2 in c["edges"]:
            assert min(x1, x2) <= c.cx / 2 + 0.5 + 1e-6 and max(x1, x2) >= c.cx / 2 - 1e-6
            assert min(y1, y2) <= c.cy / 2 + 0.5 + 1e-6 and max(y1, y2) >= c.cy / 2 - 1e-6
    inner = cells.filter("size(edges) = 0 AND corner = 1 AND poly_id = 1").count()
    assert inner and not cells.filter("size(edges) = 0 AND corner = 0").count()
    assert cells_size(cells) == cells.selectExpr("sum(88 + 32 * size(edges)) AS n").first()["n"]
    assert cells_size(polygon_cells(shapes.filter("false"), 0.5)) == 0


@pytest.mark.parametrize("cell", [0.1, 0.7, 5.0])
def test_shapes_on_grid_lines_against_brute_force(spark, cell):
    """Rings with holes, horizontal and repeated vertices, one-point rings; points on vertices, edges and lines."""
    rng = random.Random(17)
    rings = {}
    for p in range(25):
        for r in range(rng.choice([1, 1, 2, 3])):
            rings[p, r] = [(rng.randrange(-20, 20) * 0.1, rng.randrange(-20, 20) * 0.1) for _ in range(rng.choice([1, 2, 3, 5, 9]))]
    edges = {}
    for (p, _), v in rings.items():
        edges.setdefault(p, []).extend((*a, *b) for a, b in zip(v, v[1:] + v[:1]))
    points = [(x * 0.1, y * 0.1) for x in range(-21, 21, 2) for y in range(-21, 21, 3)] + [v for ring in rings.values() for v in ring]
    points += [(rng.uniform(-2, 2), rng.uniform(-2, 2)) for _ in range(200)]
    shapes = frame(spark, [(p, r, i * 3, x, y) for (p, r), v in rings.items() for i, (x, y) in enumerate(v)],
                   "poly_id int, ring int, seq int, x double, y double")
    out = contains_join(frame(spark, [(i, *p) for i, p in enumerate(points)], "point_id int, x double, y double"), shapes, cell)
    assert {tuple(r) for r in out.collect()} == {(i, p) for i, (x, y) in enumerate(points) for p, e in edges.items() if odd(x, y, e)}


def test_a_polygon_of_ten_thousand_edges(spark):
    rng = random.Random(3)
    n = 5000
    ring = [(float(i), rng.randrange(0, 90) / 10) for i in range(n)] + [(float(n - i), 20 + rng.randrange(0, 90) / 10) for i in range(n)]
    edges = [(*a, *b) for a, b in zip(ring, ring[1:] + ring[:1])]
    points = [(i, rng.uniform(-5, n + 5), rng.uniform(-2, 32)) for i in range(1500)]
    shapes = frame(spark, [(1, 0, i, x, y) for i, (x, y) in enumerate(ring)], "poly_id int, ring int, seq int, x double, y double")
    cells = polygon_cells(shapes, 4.0).cache()
    assert cells.selectExpr("max(size(edges)) AS n").first()["n"] < 20
    out = join_cells(frame(spark, points, "point_id int, x double, y double"), cells, 4.0)
    assert {r.point_id for r in out.collect()} == {i for i, x, y in points if odd(x, y, edges)}
    cells.unpersist()


def test_polygons_are_read_once_for_both_sides(spark):
    shapes = frame(spark, [(p, r, s, float(x), float(y)) for p, r, s, x, y in SQUARES],
                   "poly_id int, ring int, seq int, x double, y double")
    path = scratch_path(spark, "shapes")
    shapes.write.parquet(path)
    points = frame(spark, [(1, 3.0, 3.0), (2, 5.0, 1.0)], "point_id int, x double, y double")
    towns = points.withColumnRenamed("point_id", "town")
    out = match_through_polygons(points, towns, spark.read.parquet(path), 0.5, "point_id", "town")
    assert sorted(map(tuple, out.select("point_id", "town", "poly_id").collect())) == [(1, 1, 1), (2, 2, 2)]
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "shapes-" not in text and "Window" not in text and "cells-" in text


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_pairs_are_counted_in_generated_code(spark, limit):
    """No function over an array for cells of few edges; cells of more edges count them all."""
    star = [(1, 0, i, (2.0 if i % 2 else 0.3) * math.cos(i * math.pi / 8), (2.0 if i % 2 else 0.3) * math.sin(i * math.pi / 8)) for i in range(16)]
    edges = [(*star[i][3:], *star[(i + 1) % 16][3:]) for i in range(16)]
    places = [(i, random.Random(i).uniform(-2, 2), random.Random(-i - 1).uniform(-2, 2)) for i in range(300)]
    points = frame(spark, places, "point_id int, x double, y double")
    for cell, whole in ((4.0, True), (0.05, False)):
        cells = polygon_cells(frame(spark, star, "poly_id int, ring int, seq int, x double, y double"), cell).cache()
        found = join_cells(points, cells, cell, broadcast_limit=limit)
        assert {r.point_id for r in found.collect()} == {i for i, x, y in places if odd(x, y, edges)}
        if not whole:
            few = cells.filter("size(edges) <= 4")
            assert "lambda" not in join_cells(points, few, cell, broadcast_limit=limit)._jdf.queryExecution().executedPlan().toString()
        cells.unpersist()


def test_matches_are_steps_in_lists(spark, monkeypatch):
    """Points that share a polygon: each pair once a polygon and repeat, the join has a row for each list."""
    monkeypatch.setattr("dayline.operators.spatial.LIST", 7, raising=False)
    shapes = frame(spark, [(p, r, s, float(x), float(y)) for p, r, s, x, y in SQUARES], "poly_id int, ring int, seq int, x double, y double")
    points = frame(spark, [(i, 3.0 + i / 100, 3.0) for i in range(40)] + [(1, 3.0, 3.0), (None, 3.0, 3.0)], "point_id int, x double, y double")
    towns = frame(spark, [(i, 0.5, 0.5) for i in range(30)] + [(2, 0.5, 0.5), (None, 0.5, 0.5)], "town int, x double, y double")
    out = match_through_polygons(points, towns, shapes, 0.5, "point_id", "town")
    assert out.count() == 42 * 32 and out.filter("town IS NULL").count() == 42 and out.filter("town = 2 AND point_id = 1").count() == 4
    assert "Generate explode" in out._jdf.queryExecution().executedPlan().toString()


def test_ties_stay_and_threshold_is_strict(spark, rows):
    df = frame(spark, [("m", "s1", 5, 300), ("m", "s2", 5, 200), ("m", "s3", 5, 200), ("m", "s4", 4, 10),
                       ("n", "s5", 1, 1599), (None, "s6", 9, 1)],
               "mun string, id string, n int, elev int")
    assert rows(best_per_key(df, ["mun"], {"n": "desc", "elev": "asc"}), "id") == [("s2",), ("s3",), ("s5",)]


def test_gate_needs_every_source(spark, rows):
    base = frame(spark, [("a", 1), ("b", 2)], "region string, v int")
    one = frame(spark, [("a",), ("b",)], "region string")
    other = frame(spark, [("b",)], "region string")
    assert rows(gate_complete(base, [one, other], ["region"])) == [("b", 2)]
    assert gate_complete(base, [one, other.filter("false")]).count() == 0
    assert gate_complete(base, [one, other]).count() == 2


def test_station_without_readings_has_no_sensors(spark):
    stations = frame(spark, [("s1",), ("s2",), ("s3",)], "station_id string")
    readings = frame(spark, [("s1", day(1), 1.0, None), ("s1", day(2), 2.0, 3.0), ("s2", day(9), 1.0, 1.0)],
                     "station_id string, date date, a double, b double")
    out = availability(stations, readings, "station_id", {"a": "a_ok", "b": "b_ok"}, "date", day(1), day(3))
    got = {r["station_id"]: (r["a_ok"], r["b_ok"], r["n_sensors"]) for r in out.collect()}
    assert got == {"s1": (True, False, 1), "s2": (False, False, 0), "s3": (False, False, 0)}


def test_lookup_without_keys_and_without_rows(spark, rows):
    df = frame(spark, [(1,), (2,)], "v int")
    dim = frame(spark, [(10, "x")], "p int, q string")
    assert rows(attach_lookup(df, dim, [], ["p", "q"])) == [(1, 10, "x"), (2, 10, "x")]
    assert rows(attach_lookup(df, dim.filter("false"), [], ["p"])) == [(1, None), (2, None)]


def test_pivot_with_an_absent_band(spark, rows):
    df = frame(spark, [(day(1), 0, 5), (day(1), None, 9), (day(2), 2, 1)], "date date, band int, d int")
    out = pivot_sum(df, ["date"], "band", [0, 1, 2], {"d": "new"}, name="{col}_ag{value}")
    assert out.columns == ["date", "new_ag0", "new_ag1", "new_ag2", "new"]
    assert rows(out) == [(day(1), 5, 0, 0, 5), (day(2), 0, 0, 1, 1)]


def test_histogram_of_equal_values(spark, rows):
    df = frame(spark, [(2.0,)] * 4, "v double")
    assert rows(histogram(df, "v", 10), "bin", "n") == [(5, 4)]
    ends = frame(spark, [(0.0,), (1.0,), (10.0,)], "v double")
    assert rows(histogram(ends, "v", 10), "bin", "n") == [(0, 1), (1, 1), (9, 1)]


def test_newest_and_top(spark, rows):
    df = frame(spark, [("a", 1, 7), ("a", 2, 5), ("b", 1, 1)], "k string, seq int, v int")
    assert rows(newest_per_key(df, ["k"], "seq")) == [("a", 2, 5), ("b", 1, 1)]
    assert rows(top_k(df, ["k"], [F.col("v").desc()], 1)) == [("a", 1, 7), ("b", 1, 1)]
