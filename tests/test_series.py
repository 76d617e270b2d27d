from datetime import date

import pytest

from cohortrates.operators import series

SCHEMA = "Condition string, `Group` string, Subgroup string, Date string, Prevalence string, Lower_CI string, Upper_CI string"
POINTS = [
    ("c", "SEX", "F", "2002-07-01", "40.0", "30.0", "90.0"),
    ("c", "SEX", "F", "2001-07-01", "20.0", None, "25.0"),
    ("c", "SEX", "M", "2001-07-01", None, None, None),
    ("c", "AGE", "x", "2001-07-01", None, None, None),
    ("d", "SEX", "F", "2001-07-01", "0.0", None, "3.0"),
    ("d", "OTHER", "F", "2001-07-01", "1.0", None, "3.0"),
]


@pytest.fixture
def points(spark):
    return spark.createDataFrame(POINTS, SCHEMA)


def test_series_are_ordered_and_empty_panels_left_out(points):
    rows = series.report_series(points, "Prevalence", ["SEX", "AGE"]).collect()
    assert [(r["Condition"], r["Group"], r["Subgroup"], r["Date"]) for r in rows] == [
        ("c", "SEX", "F", date(2001, 7, 1)),
        ("c", "SEX", "F", date(2002, 7, 1)),
        ("d", "SEX", "F", date(2001, 7, 1)),
    ]
    assert rows[1]["Prevalence"] == 40.0


def test_axis_and_error_bars(points):
    limits = {(r["Condition"], r["Group"]): r for r in series.panel_limits(points, "Prevalence").collect()}
    # 40 + 40 / 6.5 = 46.2, rounded up to 50
    assert (limits["c", "SEX"]["y_min"], limits["c", "SEX"]["y_max"], limits["c", "SEX"]["tick"]) == (0, 50, 1)
    assert limits["d", "SEX"]["y_max"] == 0
    assert ("c", "AGE") not in limits
    bars = {(r["Condition"], r["Group"], r["Date"], r["Subgroup"]): r for r in series.error_bars(points, "Prevalence").collect()}
    clipped = bars["c", "SEX", "2002-07-01", "F"]
    assert (clipped["error_up"], clipped["error_down"]) == (10, 10)
    absent = bars["c", "SEX", "2001-07-01", "F"]
    assert (absent["error_up"], absent["error_down"]) == (5, 20)
    assert ("c", "SEX", "2001-07-01", "M") not in bars
    # panels of a level split can share one axis
    shared = {r["Condition"]: r["y_max"] for r in series.panel_limits(points, "Prevalence", ["Condition"]).collect()}
    assert shared["c"] == 50


def test_subgroups_are_ordered_as_numbers_where_they_are(spark):
    labels = [("n", x) for x in ("10", "2", None, "1.5")] + [("s", x) for x in ("10", "2", "x")]
    frame = spark.createDataFrame([("c", g, x, "2001-07-01", "1", "1", "1") for g, x in labels], SCHEMA)
    found = [(r["Group"], r["Subgroup"]) for r in series.report_series(frame, "Prevalence", ["n", "s"]).collect()]
    assert found == [("n", "1.5"), ("n", "2"), ("n", "10"), ("n", "Null"), ("s", "10"), ("s", "2"), ("s", "x")]


def test_numbers_that_cannot_be_drawn(spark):
    odd = [float("nan"), float("inf"), float("-inf"), None]
    frame = spark.createDataFrame([("c", "g", "s", v) for v in [*odd, 0.0, 10.0]], "Condition string, `Group` string, Subgroup string, v double")
    row = series.panel_limits(frame, "v").first()
    assert (row["y_min"], row["y_max"]) == (0, pytest.approx(15))
    bins = series.histogram_bins(frame, "v", None, 2).collect()
    assert sorted((r["bin"], r["lower"], r["upper"], r["n"]) for r in bins) == [(1, 0.0, 5.0, 1), (2, 5.0, 10.0, 1)]
    assert series.histogram_bins(frame.where("isnan(v)"), "v", None, 2).count() == 0


def test_negative_values_widen_the_axis(spark):
    df = spark.createDataFrame([("c", "g", -13.0), ("c", "g", 13.0)], "Condition string, `Group` string, v double")
    row = series.panel_limits(df, "v").first()
    assert (row["y_min"], row["y_max"]) == (pytest.approx(-15), pytest.approx(15))


def test_histogram(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 9.9), ("a", 10.0), ("b", 5.0), ("b", None)], "g string, x double")
    rows = sorted((r["Subgroup"], r["bin"], r["lower"], r["upper"], r["n"]) for r in series.histogram_bins(df, "x", "g", 5).collect())
    assert rows == [("a", 1, 0.0, 2.0, 1), ("a", 5, 8.0, 10.0, 2), ("b", 3, 4.0, 6.0, 1)]
    flat = spark.createDataFrame([("a", 3.0), ("a", 3.0)], "g string, x double")
    assert [(r["bin"], r["n"]) for r in series.histogram_bins(flat, "x", "g", 5).collect()] == [(1, 2)]
    assert series.histogram_bins(flat.where("x > 5"), "x", "g", 5).count() == 0


def test_ignored_and_missing_subgroups(spark, points):
    assert series.report_series(points, "Prevalence", ["SEX"], ignore=["F"]).count() == 0
    quoted = spark.createDataFrame([("a", "x, 'F'"), ("a", "F G"), ("a", None)], "`Group` string, Subgroup string")
    assert [r[0] for r in series.without(quoted, ["F"]).select("Subgroup").collect()] == ["F G", None]
    df = spark.createDataFrame([("a", 1.0), (None, 2.0)], "g string, x double")
    assert {r["Subgroup"] for r in series.histogram_bins(df, "x", "g", 2).collect()} == {"a", "Null"}
    assert {r["Subgroup"] for r in series.histogram_bins(df, "x", None, 2).collect()} == {"Overall"}


def test_boxes(spark):
    df = spark.createDataFrame([("a", 1, float(v)) for v in (1, 2, 3, 4)] + [("b", 1, 7.0), ("b", 2, None)], "g string, x int, y double")
    rows = {(r["Subgroup"], r["x"]): tuple(r)[2:] for r in series.box_summary(df, "y", "x", "g").collect()}
    assert rows == {("a", 1): (1.0, 4.0, 4, 1.75, 2.5, 3.25), ("b", 1): (7.0, 7.0, 1, 7.0, 7.0, 7.0)}


def test_levels_are_ordered_as_numbers_where_they_are(spark):
    df = spark.createDataFrame(
        [("n", x) for x in ("10", "9", "2", "02")] + [("s", x) for x in ("10", "9", "x")] + [("f", x) for x in ("1.5", "10")],
        "`Group` string, Subgroup string",
    )
    rows = series.level_panels(df, 2).collect()
    panels = {}
    for r in sorted(rows, key=lambda r: (r["Group"], r["place"])):
        panels.setdefault((r["Group"], r["panel"]), []).append(r["level"])
    assert panels == {
        ("n", 0): ["2", "9"], ("n", 1): ["10"],
        ("s", 0): ["10", "9"], ("s", 1): ["x"],
        ("f", 0): ["1.5", "10.0"],
    }


def test_whiskers_and_outliers(spark):
    rows = [("a", i, float(v)) for i in (1, 2) for v in [*range(1, 10), 30 * i, -20, -20]] + [("a", None, 5.0), ("b", 1, None), (None, 1, float("nan")), (None, 1, 2.0)]
    df = spark.createDataFrame(rows, "g string, x int, y double")
    found = {(r["Subgroup"], r["x"]): r for r in series.box_whiskers(df, "y", "x", "g").collect()}
    assert set(found) == {("a", 1), ("a", 2), ("a", None), ("Null", 1)}
    for i in (1, 2):
        box = found["a", i]
        assert (box["lower_whisker"], box["upper_whisker"], box["n_outliers"], box["low"], box["high"]) == (1, 9, 3, -20, 30 * i)
    assert found["a", None]["n_outliers"] == 0 and found["Null", 1]["upper_whisker"] == 2
    points = sorted(tuple(r) for r in series.box_outliers(df, "y", "x", "g").collect())
    assert points == [("a", 1, -20.0, 2), ("a", 1, 30.0, 1), ("a", 2, -20.0, 2), ("a", 2, 60.0, 1)]
    wide = series.box_whiskers(df, "y", "x", "g", fence=100.0)
    assert {r["n_outliers"] for r in wide.collect()} == {0}


def test_histogram_reads_nothing_early(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", 2.5), ("b", None)], "g string, x double")
    spark.sparkContext.setJobGroup("histogram", "histogram")
    made = series.histogram_bins(df, "x", "g", 3)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("histogram")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(tuple(r) for r in made.collect()) == [("a", 1, 1.0, 2.0, 1), ("a", 3, 3.0, 4.0, 1), ("b", 2, 2.0, 3.0, 1)]
