import datetime as dt
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from dayline.functions.columns import (Band, back_transform, normal_quantile, reband, rmse, row_sum,
                                       same_set, transform_column)
from dayline.functions.dates import (date_bounds, days_between, local_date, parse_date,
                                     parse_timestamp, partial_date)
from dayline.operators.filters import drop_empty, predicate, select_where
from dayline.operators.projections import nan_to_null, recode
from dayline.schemas import ENTITIES, conform, empty_table, schema_of


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize("text, band", [
    ("12-19", 0), ("30-39", 1), ("50-59", 1), ("60-69", 2), ("90+", 2), (" 20-29 ", 0),
    ("25-34", None), ("0-15", 0), ("80-89", 2), ("abc", None), ("", None)])
def test_age_bands(spark, text, band):
    assert one(spark, reband(F.lit(text))) == band


def test_first_fitting_band_wins(spark):
    bands = (Band(1, low=0), Band(2, below=50))
    assert one(spark, reband(F.lit("10-20"), bands)) == 1
    assert one(spark, reband(F.lit("50+"), (Band(7, below=90),))) is None


def test_two_date_layouts(spark):
    assert one(spark, parse_date(F.lit("01/02/21"))) == dt.date(2021, 2, 1)
    assert one(spark, parse_date(F.lit("01/02/2021"))) == dt.date(2021, 2, 1)
    assert one(spark, parse_date(F.lit("2021-02-01"))) is None
    assert one(spark, parse_timestamp(F.lit("13:05:09 01/02/2021"), "HH:mm:ss dd/MM/yyyy")) \
        == dt.datetime(2021, 2, 1, 13, 5, 9)


def test_partial_dates(spark):
    assert one(spark, partial_date("2021")) == dt.date(2021, 1, 1)
    assert one(spark, partial_date("2021-05")) == dt.date(2021, 5, 1)
    assert one(spark, partial_date("2021-05-06")) == dt.date(2021, 5, 6)


def test_default_bounds(spark):
    low, high = date_bounds()
    assert one(spark, low) == dt.date(2020, 2, 23)
    assert abs((one(spark, high) - dt.date.today()).days) <= 1
    assert one(spark, date_bounds("2021-01-02", "2021-02-03")[1]) == dt.date(2021, 2, 3)


def test_late_evening_utc_is_the_next_day_in_zone(spark):
    assert one(spark, local_date(F.lit("2021-06-30 22:30:00").cast("timestamp"))) == dt.date(2021, 7, 1)


def test_reversed_range_has_no_days(spark):
    a, b = F.lit("2021-01-03").cast("date"), F.lit("2021-01-01").cast("date")
    assert one(spark, days_between(a, b)) == []
    assert len(one(spark, days_between(b, a))) == 3


def test_sets_ignore_order_and_repeats(spark):
    a = F.array(F.lit("x"), F.lit("y"), F.lit("x"))
    assert one(spark, same_set(a, F.array(F.lit("y"), F.lit("x")))) is True
    assert one(spark, same_set(a, F.array(F.lit("y")))) is False
    empty = F.array().cast("array<string>")
    assert one(spark, same_set(empty, empty)) is True


def test_row_sum_skips_nulls(spark):
    assert one(spark, row_sum([F.lit(2), F.lit(None).cast("int"), F.lit(3)])) == 5


@pytest.mark.parametrize("predicted, expected", [(3.0, 1.0), (None, 1e6), (float("nan"), 1e6),
                                                 (float("inf"), 1e6)])
def test_rmse_penalty(spark, predicted, expected):
    df = spark.createDataFrame([(2.0, predicted), (4.0, 5.0)], "a double, p double")
    assert df.agg(rmse("a", "p")).first()[0] == expected


def test_transform_round_trip(spark):
    assert one(spark, back_transform(transform_column(F.lit(7.0), "sqrt"), "sqrt")) == pytest.approx(7.0)
    with pytest.raises(ValueError):
        transform_column("x", "log")


@pytest.mark.parametrize("p", [1e-6, 0.01, 0.02425, 0.3, 0.5, 0.8, 0.99, 1 - 1e-6])
def test_normal_quantile(spark, p):
    assert one(spark, normal_quantile(F.lit(p))) == pytest.approx(NormalDist().inv_cdf(p), abs=1e-7)


def test_unknown_category_is_null(spark, rows):
    df = spark.createDataFrame([("giallo",), ("verde",), (None,)], "risk string")
    assert rows(recode(df, "risk", {"giallo": "yellow"})) == sorted(
        [("yellow",), (None,), (None,)], key=repr)
    assert rows(recode(df, "risk", {"giallo": "yellow"}, "other"))[0] == ("other",)


def test_nan_becomes_null(spark, rows):
    df = spark.createDataFrame([(float("nan"),), (1.5,)], "x double")
    assert rows(nan_to_null(df, ["x"])) == [(1.5,), (None,)]


def test_conform_casts_fills_and_drops(spark):
    df = spark.createDataFrame([("2021-01-02", "x1", "7", 1.0)], "date string, cases string, deaths string, extra double")
    out = conform(df, "municipality_data")
    assert out.schema.simpleString() == schema_of("municipality_data").simpleString()
    row = out.first()
    assert (row["date"], row["cases"], row["deaths"], row["code"]) == (dt.date(2021, 1, 2), None, 7, None)


def test_every_entity_has_a_schema(spark):
    for name in ENTITIES:
        assert empty_table(spark, name).count() == 0
    assert len(schema_of("curated")) == 35


def test_predicate_kinds(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (9, "a")], "n int, s string")
    assert rows(df.filter(predicate({"n": range(1, 4), "s": "a"}))) == [(1, "a"), (3, "a")]
    assert rows(df.filter(predicate({"n": [2, 9]}))) == [(2, "b"), (9, "a")]
    with pytest.raises(TypeError):
        predicate({"n": object()})
    with pytest.raises(ValueError):
        select_where(df, {"n": 1}, join=df)


def test_rows_need_key_and_measure(spark, rows):
    df = spark.createDataFrame([(1, None, None), (None, 1.0, 2.0), (2, None, 0.0)],
                               "k int, a double, b double")
    assert rows(drop_empty(df, "k", ["a", "b"])) == [(2, None, 0.0)]
