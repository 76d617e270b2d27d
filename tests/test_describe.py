import math
import statistics

import pytest
from pyspark.sql import functions as F

from cohortrates.operators import describe
from cohortrates.operators.quantiles import exact_quantiles, verified_quantiles

SCHEMA = "arm string, sex string, town string, score double, age int"
PEOPLE = [
    ("x", "F", "a", 1.0, 30),
    ("x", "M", "b", 2.5, 40),
    ("x", "F", "null", None, 50),
    ("x", "F", "a", 4.0, 60),
    ("y", "M", "", 8.0, 20),
    ("y", "M", "c", 16.0, 21),
    ("y", "F", None, 3.0, None),
]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, SCHEMA)


def test_categorical_counts_leave_missing_out_of_percent(people):
    rows = describe.categorical_summary(people, ["sex", "town"]).collect()
    found = {(r["variable"], r["level"]): (r["n"], r["percent"], r["n_missing"], r["group_total"]) for r in rows}
    assert found["town", "a"] == (2, pytest.approx(50.0), 3, 7)
    assert found["sex", "F"] == (4, pytest.approx(400 / 7), 0, 7)
    assert len(found) == 5


def test_grouped_counts_and_chi_square(people):
    rows = describe.categorical_summary(people, ["sex", "town"], "arm").collect()
    found = {(r["variable"], r["group"], r["level"]): r for r in rows}
    assert found["town", "y", "c"]["percent"] == 100.0
    assert ("town", "y", "a") not in found
    # town: a 2/0, b 1/0, c 0/1 -> expected 1.5, 0.5; 0.75, 0.25; 0.75, 0.25
    statistic = 2 * 0.25 / 1.5 * 0 + 0.25 / 1.5 + 0.25 / 0.5 + 0.0625 / 0.75 + 0.0625 / 0.25 + 0.5625 / 0.75 + 0.5625 / 0.25
    assert found["town", "x", "a"]["pvalue"] == pytest.approx(math.exp(-statistic / 2))
    # sex: 3 F 1 M / 1 F 2 M, two levels, corrected by a half
    expected = [(3, 16 / 7), (1, 12 / 7), (1, 12 / 7), (2, 9 / 7)]
    yates = sum((abs(o - e) - min(0.5, abs(o - e))) ** 2 / e for o, e in expected)
    assert found["sex", "x", "F"]["pvalue"] == pytest.approx(math.erfc(math.sqrt(yates / 2)))


def test_one_level_is_no_evidence(spark):
    df = spark.createDataFrame([("x", "a"), ("y", "a"), ("y", "a")], "arm string, v string")
    row = describe.chi_square(describe.level_counts(df, ["v"], "arm")).first()
    assert (row["statistic"], row["freedom"], row["pvalue"]) == (0.0, 0, 1.0)


def test_numeric_summary_and_t_test(people):
    rows = {(r["variable"], r["group"]): r for r in describe.numeric_summary(people, ["score", "age"], "arm").collect()}
    x = [1.0, 2.5, 4.0]
    y = [8.0, 16.0, 3.0]
    row = rows["score", "x"]
    assert (row["mean"], row["std"]) == (pytest.approx(2.5), pytest.approx(statistics.stdev(x)))
    assert (row["median"], row["min"], row["max"], row["n_missing"], row["group_total"]) == (2.5, 1.0, 4.0, 1, 4)
    pooled = (2 * statistics.variance(x) + 2 * statistics.variance(y)) / 4
    t = (statistics.mean(x) - statistics.mean(y)) / math.sqrt(pooled * 2 / 3)
    # the distribution function of four degrees of freedom in closed form
    share = t * t / 4 / (1 + t * t / 4)
    assert row["pvalue"] == pytest.approx(1 - 0.75 * abs(t) / math.sqrt(1 + t * t / 4) * (1 - share / 3))
    alone = {r["variable"]: r for r in describe.t_test(people, ["score", "age"], "arm").collect()}
    assert (alone["score"]["statistic"], alone["score"]["freedom"]) == (pytest.approx(t), 4)
    assert alone["score"]["pvalue"] == pytest.approx(row["pvalue"])
    assert rows["age", "y"]["median"] == 20.5


def test_all_values_missing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "v double, w double")
    rows = {r["variable"]: r for r in describe.numeric_summary(df, ["v", "w"]).collect()}
    assert rows["v"]["median"] is None and rows["v"]["n_missing"] == 2
    assert rows["w"]["median"] == 1.5


def test_groups_must_be_two(people):
    for column in ("town", "sex"):
        if column == "town":
            with pytest.raises(ValueError):
                describe.two_groups(people, column)
        else:
            assert describe.two_groups(people, column) == ["F", "M"]
    for wrong in ("town", "one"):
        frame = people.withColumn("one", F.lit("only"))
        with pytest.raises(Exception, match="exactly two groups"):
            describe.categorical_summary(frame, ["sex"], wrong).collect()
        with pytest.raises(Exception, match="exactly two groups"):
            describe.numeric_summary(frame, ["score"], wrong).collect()


def test_formatted_lines(people):
    table = describe.formatted_table(people, ["sex", "town"], ["score", "age"])
    assert table.columns == ["line", "Group", "Subgroup", "Missing", "Count"]
    lines = [tuple(r)[1:] for r in table.collect()]
    assert lines == [
        ("sex", "F", "0 (0.0%)", "4 (57.14%)"),
        ("", "M", "", "3 (42.86%)"),
        ("town", "a", "3 (42.86%)", "2 (50.0%)"),
        ("", "b", "", "1 (25.0%)"),
        ("", "c", "", "1 (25.0%)"),
        ("score", "mean std", "1 (14.29%)", "5.75 5.55"),
        ("", "median min max", "", "3.5 1.0 16.0"),
        ("age", "mean std", "1 (14.29%)", "36.83 16.13"),
        ("", "median min max", "", "35.0 20 60"),
    ]


def test_formatted_groups_show_absent_levels(people):
    table = describe.formatted_table(people, ["town"], [], "arm")
    assert table.columns == ["line", "Group", "Subgroup", "Missing_x", "Count_x", "Missing_y", "Count_y", "pvalue"]
    lines = [tuple(r)[1:] for r in table.collect()]
    assert [line[:6] for line in lines] == [
        ("town", "a", "1 (25.0%)", "2 (66.67%)", "2 (66.67%)", "0 (0.0%)"),
        ("", "b", "", "1 (33.33%)", "", "0 (0.0%)"),
        ("", "c", "", "0 (0.0%)", "", "1 (100.0%)"),
    ]
    assert [line[6] == "" for line in lines] == [False, True, True]


def interpolated(values, p):
    values = sorted(values)
    rank = p * (len(values) - 1)
    low, high = values[math.floor(rank)], values[math.ceil(rank)]
    return low + (high - low) * (rank - math.floor(rank))


@pytest.mark.parametrize("accuracy", [200, 1_000, 50_000])
def test_quantiles_are_exact(spark, accuracy):
    """One group holds most rows, another one value many times, others from one to a few rows."""
    hot = spark.range(20_000).select(F.lit("hot").alias("k"), ((F.col("id") * 7919) % 20_011).cast("double").alias("v"))
    same = spark.range(3_000).select(
        F.lit("same").alias("k"), F.when(F.col("id") < 2_000, 5).otherwise(F.col("id")).cast("double").alias("v")
    )
    few = spark.createDataFrame([("few", 1.0), ("few", 4.0), ("few", None), (None, 3.0), ("nan", float("nan"))], "k string, v double")
    sizes = spark.range(1, 12).selectExpr("concat('n', id) AS k", "explode(sequence(1, id)) AS i").selectExpr("k", "double(i * i) AS v")
    df = hot.unionByName(same).unionByName(few).unionByName(sizes)
    wanted = {"low": 0.0, "a": 0.013, "quarter": 0.25, "half": 0.5, "b": 0.9, "high": 1.0}
    found = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", wanted, accuracy=accuracy).collect()}
    values = {}
    for k, v in df.where("v IS NOT NULL AND NOT isnan(v)").collect():
        values.setdefault(k, []).append(v)
    assert set(found) == {"hot", "same", "few", None, "nan"} | {f"n{i}" for i in range(1, 12)}
    for k, group in values.items():
        for name, p in wanted.items():
            assert found[k][name] == pytest.approx(interpolated(group, p)), (k, name)
    assert found["nan"]["half"] is None


def test_a_missed_bracket_fails_and_is_widened(spark):
    """Brackets far too narrow, on sorted and skewed values: an error, and exact values after widening."""
    df = spark.range(30_000).selectExpr("if(id < 29000, 'sorted', 'skewed') AS k", "if(id < 29000, double(id), exp(double(id - 29000) / 9)) AS v").coalesce(3)
    wanted = {"a": 0.013, "half": 0.5, "b": 0.987}
    with pytest.raises(Exception, match="outside of its bracket"):
        exact_quantiles(df, ["k"], "v", wanted, accuracy=10, margin=0.0).collect()
    for margin in (0.0, 0.001, 32):
        found = {r["k"]: r for r in verified_quantiles(df, ["k"], "v", wanted, {"n": F.count("v")}, accuracy=10, margin=margin).collect()}
        for k, values in {"sorted": list(range(29_000)), "skewed": [math.exp(i / 9) for i in range(1000)]}.items():
            assert found[k]["n"] == len(values)
            for name, p in wanted.items():
                assert found[k][name] == pytest.approx(interpolated(values, p)), (k, name)


def test_levels_of_a_variable_are_not_brought_to_one_task(spark):
    df = spark.range(40_000).selectExpr("string(id % 20000) AS many", "if(id % 3 = 0, 'a', 'b') AS g", "string(id % 2) AS two")
    whole = describe.categorical_summary(df, ["many", "two"])
    found = {(r["variable"], r["level"]): r["percent"] for r in whole.collect()}
    assert len(found) == 20_002 and found["two", "1"] == 50 and found["many", "7"] == pytest.approx(0.005)
    assert "Window" not in whole._jdf.queryExecution().executedPlan().toString()
    grouped = describe.categorical_summary(df, ["many", "two"], "g")
    rows = grouped.where("variable = 'many'").collect()
    assert sum(r["n"] for r in rows) == 40_000 and len({r["pvalue"] for r in rows}) == 1
    # windows are over totals of groups, so their input is dealt by variable from sums per variable and group
    plan = grouped._jdf.queryExecution().optimizedPlan().toString()
    for window in plan.split("Window [")[1:]:
        assert "level" not in window.split("\n")[0]
