"""Names and label texts, by table."""

import datetime

import pytest
from pyspark.sql import functions as F

from lookout.functions import boxes, names


def value(spark, column, **cells):
    row = spark.createDataFrame([tuple(cells.values())], ", ".join(f"{k} string" for k in cells))
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(("folder", "camera"), [("gorse_ridge-north_2031-11-02T23-59-01", "gorse_ridge-north"), ("q7_2031-", "q7"), ("a_1999x_2030-01", "a_1999x"), ("heron_20300101T0", "heron"), ("plain", "plain"), ("", ""), ("x_2031y_2032z", "x_2031y_2032z")])
def test_camera(spark, folder, camera):
    assert value(spark, names.camera(F.col("f")), f=folder) == camera


@pytest.mark.parametrize(("camera", "site", "azimuth"), [("gorse_45", "gorse", 45), ("elm_hill_359", "elm_hill", 359), ("mast", "mast", None), ("_8", "_8", None)])
def test_site(spark, camera, site, azimuth):
    assert value(spark, names.site(F.col("c")), c=camera) == site
    assert value(spark, names.azimuth(F.col("c")), c=camera) == azimuth


@pytest.mark.parametrize(("stem", "moment"), [("gorse_2031_11_02T23_59_01", datetime.datetime(2031, 11, 2, 23, 59, 1)), ("gorse_2031-11_02T00-00_00", datetime.datetime(2031, 11, 2)), ("gorse_2031-11-02", None), ("gorse_2031-13-01T00-00-00", None), ("gorse", None)])
def test_moment(spark, stem, moment):
    assert value(spark, names.moment(F.col("s")).cast("timestamp_ntz"), s=stem) == moment


@pytest.mark.parametrize("stem", ["src_click-u1000_90_2024-01-12T09-45-29", "2023-07-12_2024-01-12T09-45-29", "a_2024_01_12_2024_01_12T09_45_29"])
def test_moment_after_what_looks_like_a_date(spark, stem):
    assert value(spark, names.moment(F.col("s")).cast("timestamp_ntz"), s=stem) == datetime.datetime(2024, 1, 12, 9, 45, 29)


@pytest.mark.parametrize(("stem", "found"), [("platform_gorse-45_2031-11-02T23-59-01", ("gorse", 45, None)), ("pyro_elm_3_2031_11_02T23_59_01", ("elm", None, 3)), ("platform_elm-hill-12_2031-11-02T23-59-01", ("elm-hill", 12, None)), ("pyro_elm_3", None), ("mast_2031_11_02T23_59_01", None)])
def test_camera_details(spark, stem, found):
    got = value(spark, names.camera_details(F.col("s")), s=stem)
    assert (got if got is None else tuple(got)) == found


def test_platform_fields(spark):
    assert value(spark, names.file_stamp(F.col("t")), t="2031-11-02T23:59:01.5") == "2031-11-02T23-59-01"
    got = value(spark, boxes.platform_boxes(F.col("t")), t="[[0.1, 0.2, 0.3, 0.6, 0.9], [0.0, 0.0, 1.0, 1.0, 0.5]]")
    assert [round(b.cx, 9) for b in got] == [0.2, 0.5]
    assert [round(b.h, 9) for b in got] == [0.4, 1.0]


@pytest.mark.parametrize(("text", "n", "conf"), [("", 0, None), (None, 0, None), ("0 0.5 0.5 0.1 0.2", 1, 1.0), ("0 0.5 0.5 0.1 0.2 0.7\n\n0 0 0 0 0", 1, 0.7), ("0 0.5 0.5 0.1 0.2 high", 1, 1.0), ("0 a 0.5 0.1 0.2", 0, None), ("0 nan 0.5 0.1 0.2", 0, None), ("0 0.5 0.5 -0.1 0.2", 0, None), ("0 0.5 0.5", 0, None)])
def test_boxes(spark, text, n, conf):
    got = value(spark, boxes.boxes(F.col("t")), t=text)
    assert len(got) == n
    assert conf is None or got[0].conf == conf


def test_label_texts(spark):
    assert value(spark, boxes.normalised(F.col("t")), t="0 0.1 0.2 0.3 0.4 0.9\n\n1 0.5 0.5 0.1 0.1\n") == "0 0.1 0.2 0.3 0.4\n1 0.5 0.5 0.1 0.1"
    assert value(spark, boxes.max_score(F.col("t")), t="0 0.1 0.2 0.3 0.4 0.9\n0 0 0 0 0 0.95\n1 1 1 1 1") == 0.95
    assert value(spark, boxes.max_score(F.col("t")), t="") == 0.0


def test_box_round_trip(spark):
    row = spark.createDataFrame([(0.5, 0.4, 0.2, 0.1)], "cx double, cy double, w double, h double")
    c = boxes.corners(*map(F.col, ("cx", "cy", "w", "h")))
    back = row.select(c.alias("c")).select(boxes.centred(*(F.col(f"c.{x}") for x in ("x1", "y1", "x2", "y2"))).alias("b")).first().b
    assert [round(x, 9) for x in back] == [0.5, 0.4, 0.2, 0.1]
