from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortrates.functions.limits import exact_limits
from cohortrates.operators import disclosure, standardise
from cohortrates.operators.grid import PREVALENCE

DAY = date(2001, 1, 1)
BREAKDOWNS = {"Overall": "AGE, SEX", "by_a": "AGE, SEX, a", "by_ab": "AGE, SEX, a, b"}
CRUDE = "Condition string, `Group` string, AGE string, SEX string, a string, b string, Numerator bigint, Denominator double"


@pytest.fixture
def weights(spark):
    return spark.createDataFrame([("0-16, F", 30), ("0-16, M", 10), ("17+, F", 60)], "std_group string, weight bigint")


def parts(spark, cells):
    crude = spark.createDataFrame(cells, CRUDE).withColumns({"Date": F.lit(DAY), "Subgroup": F.lit("?")})
    return standardise.std_parts(crude, standardise.breakdown_groups(BREAKDOWNS))


def rates(spark, cells, weights):
    found = standardise.standardise(parts(spark, cells), weights, BREAKDOWNS, PREVALENCE, per=1.0).collect()
    return {(r["Group"], r["Subgroup"]): (r["Prevalence"], r["Lower_CI"], r["Upper_CI"]) for r in found}


def cell(group, age, sex, o, n, a=None, b=None):
    return ("c", group, age, sex, a, b, o, float(n))


def test_weights_are_normalised_over_the_cells_present(spark, weights):
    found = rates(spark, [cell("AGE, SEX", "0-16", "F", 2, 10), cell("AGE, SEX", "0-16", "M", 3, 20)], weights)
    rate, low, high = found["Overall", "Overall"]
    dsr = (30 * 2 / 10 + 10 * 3 / 20) / 40
    variance = (900 * 2 / 100 + 100 * 3 / 400) / 1600
    assert rate == pytest.approx(dsr)
    limits = exact_limits(0.05)[5]
    assert low == pytest.approx(dsr + (variance / 5) ** 0.5 * (limits[0] - 5))
    assert high == pytest.approx(dsr + (variance / 5) ** 0.5 * (limits[1] - 5))


def test_one_unknown_cell_voids_its_stratum_only(spark, weights):
    found = rates(
        spark,
        [
            cell("AGE, SEX, a", "0-16", "F", 2, 10, "MIDDLE EAST"),
            cell("AGE, SEX, a", "17+", "M", 2, 10, "MIDDLE EAST"),
            cell("AGE, SEX, a", "0-16", "F", 2, 10, "FAR EAST"),
        ],
        weights,
    )
    assert set(found) == {("by_a", "FAREAST")}


def test_empty_cell_voids_and_no_cases_means_no_limits(spark, weights):
    group = "AGE, SEX, a, b"
    found = rates(
        spark,
        [
            cell(group, "0-16", "F", 0, 0, "x", "1"),
            cell(group, "0-16", "M", 4, 5, "x", "1"),
            cell(group, "0-16", "F", 0, 7, "x", "2"),
        ],
        weights,
    )
    assert found == {("by_ab", "x, 2"): (0.0, None, None)}


def test_intersex_and_left_out_strata(spark, weights):
    found = rates(
        spark,
        [
            cell("AGE, SEX", "0-16", "I", 5, 5),
            cell("AGE, SEX", "0-16", "F", 1, 4),
            cell("AGE, SEX, a", "0-16", "F", 1, 4, "Ireland"),
        ],
        weights,
    )
    assert set(found) == {("Overall", "Overall")}
    assert found["Overall", "Overall"][0] == pytest.approx(0.25)


def test_labels_and_columns_split_alike(spark):
    cells = [cell("AGE, SEX, a, b", "0-16", "F", 1, 4, "A B", "1"), cell("AGE, SEX", "17+", "M", 2, 4)]
    typed = parts(spark, cells).select("Group", "std_group", "Subgroup").collect()
    labelled = spark.createDataFrame(
        [("AGE, SEX, a, b", "0-16, F, A B, 1"), ("AGE, SEX", "17+, M"), ("Overall", ""), ("x", None)],
        "`Group` string, Subgroup string",
    )
    split = {r["Group"]: (r["std_group"], r["Subgroup"]) for r in standardise.split_std_group(labelled).collect()}
    assert all(split[r["Group"]] == (r["std_group"], r["Subgroup"]) for r in typed)
    assert split["AGE, SEX, a, b"] == ("0-16, F", "AB, 1")
    assert split["Overall"] == ("", "")
    assert split["x"] == ("NotSpecified", "")


def test_scrub(spark):
    df = spark.createDataFrame([(None, float("inf")), (2.0, 3.0)], "Prevalence double, Upper_CI double")
    assert [tuple(r) for r in standardise.scrub_rates(df, "Prevalence").collect()] == [(0.0, 0.0), (2.0, 3.0)]


def test_intersex_labels(spark):
    labels = ["0-16, I, x", "0-16, I", "0-16, M, I", "0-16, M, IV", "I, M"]
    df = spark.createDataFrame([(x,) for x in labels], "Subgroup string")
    assert [r[0] for r in disclosure.drop_intersex_label(df).collect()] == ["0-16, M, IV", "I, M"]


@pytest.mark.parametrize(
    "numerator, denominator, kept",
    [
        (None, 50.0, (False, True, False)),
        (0, 50.0, (False, True, False)),
        (10, 50.0, (False, True, False)),
        (11, 10.0, (True, False, False)),
        (11, 10.5, (True, True, True)),
        (11, None, (True, False, False)),
    ],
)
def test_small_counts(spark, numerator, denominator, kept):
    df = spark.createDataFrame(
        [(numerator, denominator, 1.0, 0.5, 2.0)],
        "Numerator bigint, Denominator double, Prevalence double, Lower_CI double, Upper_CI double",
    )
    row = disclosure.suppress_crude(df, 10, "Prevalence").first()
    assert (row["Numerator"] is not None, row["Denominator"] is not None, row["Prevalence"] is not None) == kept
    assert (row["Lower_CI"] is None) == (row["Upper_CI"] is None) == (not kept[2])


def test_standardised_rates_follow_their_own_counts(spark, weights):
    """Labels with spaces, two-column breakdowns and equal labels of different groups all match."""
    cells = [
        cell("AGE, SEX, a", "0-16", "F", 6, 40, "A B"),
        cell("AGE, SEX, a", "0-16", "M", 5, 40, "A B"),
        cell("AGE, SEX, a", "0-16", "I", 50, 60, "C"),
        cell("AGE, SEX, a", "0-16", "F", 2, 60, "C"),
        cell("AGE, SEX, a, b", "0-16", "F", 30, 60, "A B", "1"),
        cell("Overall", None, None, 12, 99),
        cell("AGE, SEX", "0-16", "F", 3, 9),
    ]
    crude = spark.createDataFrame(cells, CRUDE).withColumns({"Date": F.lit(DAY), "Subgroup": F.lit("?")})
    dsr = standardise.standardise(parts(spark, cells), weights, BREAKDOWNS, PREVALENCE)
    numerators = disclosure.crude_numerators(crude, BREAKDOWNS)
    attached = disclosure.attach_numerators(dsr, numerators, BREAKDOWNS).collect()
    assert {(r["Group"], r["Subgroup"]): r["Numerator"] for r in attached} == {
        ("by_a", "AB"): 11, ("by_a", "C"): 2, ("by_ab", "AB, 1"): 30, ("Overall", "Overall"): 12
    }
    whole = standardise.std_parts(crude, standardise.breakdown_groups(BREAKDOWNS), whole=True)
    counted = standardise.standardise(whole, weights, BREAKDOWNS, PREVALENCE, counted=True)
    apart = disclosure.attach_numerators(dsr, numerators, BREAKDOWNS)
    assert sorted(map(str, counted.select(apart.columns).collect())) == sorted(map(str, apart.collect()))
    safe = disclosure.suppress_standardised(counted, 10, PREVALENCE)
    assert safe.columns == dsr.columns
    assert {(r["Group"], r["Subgroup"]) for r in safe.collect() if r["Prevalence"] is None} == {("by_a", "C")}


def test_overall_rate_pools_the_cells_of_a_finer_group(spark, weights):
    """One rate per condition and date, Ireland included, from a group of three columns."""
    cells = [
        cell("AGE, SEX, a", "0-16", "F", 2, 40, "Ireland"),
        cell("AGE, SEX, a", "0-16", "F", 6, 20, "x"),
        cell("AGE, SEX, a", "17+", "F", 4, 50, "x"),
    ]
    breakdowns = {"Overall": "AGE, SEX, a", "by_a": "AGE, SEX, a"}
    crude = spark.createDataFrame(cells, CRUDE).withColumns({"Date": F.lit(DAY), "Subgroup": F.lit("?")})
    found = standardise.standardise(standardise.std_parts(crude, ["AGE, SEX, a"]), weights, breakdowns, PREVALENCE, per=1.0)
    rates_of = {(r["Group"], r["Subgroup"]): r["Prevalence"] for r in found.collect()}
    assert rates_of == {
        ("Overall", "Overall"): pytest.approx((30 * 2 / 40 + 30 * 6 / 20 + 60 * 4 / 50) / 120),
        ("by_a", "x"): pytest.approx((30 * 6 / 20 + 60 * 4 / 50) / 90),
    }


def test_labels_of_any_number_of_parts(spark):
    label = ", ".join(f"part{i}" for i in range(1500))
    row = standardise.split_std_group(spark.createDataFrame([("g", label)], "`Group` string, Subgroup string")).first()
    assert row["Subgroup"] == ", ".join(f"part{i}" for i in range(2, 1500))
    assert standardise.split_std_group(spark.createDataFrame([("g", "one")], "`Group` string, Subgroup string")).first()["Subgroup"] == ""
