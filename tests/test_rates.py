"""Rates against the rules applied person by person in plain Python."""

import random
from datetime import date, timedelta
from itertools import product

import pytest

from cohortrates.functions.limits import exact_limits
from cohortrates.operators.grid import INCIDENCE, PREVALENCE, Study, StudyGrid
from cohortrates.operators.rates import analyse, cohort_long, condition_cells, crude_rates, merge_cells, rate_cells, strata_lists

SCHEMA = "INDEX_DATE date, END_DATE date, a date, b date, sex string, band string"
YEARLY = StudyGrid.between(date(2001, 1, 1), date(2004, 12, 31))
MONTHLY = StudyGrid.between(date(2001, 1, 31), date(2002, 12, 31), months=1)


def brute(people, conditions, strata, study):
    """Numerator and denominator by condition, group, subgroup and date."""
    dates, found = study.grid.dates, {}
    periods = list(zip(dates[:-1], dates[1:])) if study.measure == INCIDENCE else [(d, d) for d in dates]
    lists = [("Overall", ())] + [(", ".join(x), x) for x in strata_lists(strata)]
    for person, condition, (group, columns), (lo, hi) in product(people, conditions, lists, periods):
        i, x, e = person["INDEX_DATE"], person["END_DATE"], person[condition]
        label = ", ".join(person[c] or "null" for c in columns)
        entry = found.setdefault((condition, group, label, lo), [0, 0, 0, 0, 0])
        entry[4] = (hi - lo).days
        if study.measure == PREVALENCE:
            here = i is not None and x is not None and i <= lo <= x
            entry[1] += here
            entry[0] += here and e is not None and e <= lo
            continue
        entry[3] += 1
        if i is None or x is None or not (x >= lo and i < hi):
            continue
        entry[0] += e is not None and lo <= e < hi and e > i
        if e is None or (e >= lo and e > i):
            entry[1] += (min(d for d in (x, e, hi) if d) - max(i, lo)).days
            entry[2] += 1
    if study.measure == PREVALENCE:
        return {k: (v[0], v[1]) for k, v in found.items()}
    return {k: (v[0], v[1] / v[4] + 1e-8 * (v[3] - v[2])) for k, v in found.items()}


def check(spark, people, strata, study, conditions=("a", "b")):
    frame = spark.createDataFrame([tuple(p.values()) for p in people], SCHEMA)
    rows = analyse(frame, conditions, strata, study).collect()
    expected = brute(people, conditions, strata, study)
    found = {(r["Condition"], r["Group"], r["Subgroup"], r["Date"]): (r["Numerator"], r["Denominator"]) for r in rows}
    assert len(rows) == len(found)
    assert found.keys() == expected.keys()
    for key, (numerator, denominator) in expected.items():
        assert found[key][0] == numerator, key
        assert found[key][1] == pytest.approx(denominator, abs=1e-12), key
    return rows


def person(i, x, a=None, b=None, sex="F", band=None):
    return dict(INDEX_DATE=i, END_DATE=x, a=a, b=b, sex=sex, band=band)


D = date
EDGES = [
    person(D(2000, 1, 1), D(2005, 1, 1), D(2001, 1, 1)),  # event on the first day of a period
    person(D(2000, 1, 1), D(2005, 1, 1), D(2002, 1, 1)),  # event on the last bound of a period
    person(D(2001, 3, 1), D(2005, 1, 1), D(2001, 3, 1)),  # event on entry: prevalent, not incident
    person(D(2001, 3, 1), D(2002, 1, 1), D(2002, 6, 1)),  # event after exit
    person(D(2001, 3, 1), D(2002, 1, 1)),  # exit on a bound
    person(D(2002, 1, 1), D(2003, 1, 1), D(2001, 5, 5)),  # event before entry; entry on a bound
    person(D(2003, 5, 1), D(2003, 2, 1)),  # exit before entry, same period
    person(D(2003, 5, 1), D(2001, 2, 1), D(2002, 2, 2)),  # exit before entry, other period
    person(D(2003, 5, 1), D(2003, 2, 1), D(2003, 6, 1)),
    person(D(2000, 1, 1), None, D(2002, 2, 2)),  # no exit
    person(None, D(2004, 1, 1), D(2002, 2, 2)),  # no entry
    person(D(1990, 1, 1), D(1995, 1, 1), D(1993, 1, 1)),  # before the study
    person(D(2010, 1, 1), D(2015, 1, 1), D(2012, 1, 1)),  # after the study
    person(D(1990, 1, 1), D(2015, 1, 1), D(1993, 1, 1)),  # event before the study
    person(D(1990, 1, 1), D(2015, 1, 1), D(2012, 1, 1)),  # event after the study
    person(D(2004, 1, 1), D(2004, 12, 31), D(2004, 2, 29), band="x"),  # leap year
    person(D(2002, 2, 2), D(2002, 2, 2), D(2002, 2, 2), D(2002, 2, 3)),  # one day
]


@pytest.mark.parametrize("measure", [INCIDENCE, PREVALENCE])
@pytest.mark.parametrize("grid", [YEARLY, MONTHLY], ids=["yearly", "monthly"])
def test_edge_cases_one_by_one(spark, measure, grid):
    people = [dict(p, sex=f"p{n}") for n, p in enumerate(EDGES)]
    check(spark, people, ["sex"], Study(measure, grid))


def some_people(count, seed):
    draw = random.Random(seed)
    start = date(2000, 1, 1)

    def day(chance=0.9):
        return start + timedelta(days=draw.randrange(2200)) if draw.random() < chance else None

    return [
        person(day(0.97), day(0.97), day(0.6), day(0.05), draw.choice("FMI"), draw.choice(["young", "old", None]))
        for _ in range(count)
    ]


@pytest.mark.parametrize("measure", [INCIDENCE, PREVALENCE])
@pytest.mark.parametrize("grid", [YEARLY, MONTHLY], ids=["yearly", "monthly"])
def test_random_people(spark, measure, grid):
    people = some_people(400, seed=5)
    check(spark, people, ["sex", "band", ["sex", "band"], ["band", "sex"]], Study(measure, grid))


@pytest.mark.parametrize("measure", [INCIDENCE, PREVALENCE])
def test_many_conditions_are_listed_in_batches(spark, measure):
    people = some_people(150, seed=11)
    wide = [dict(p, **{f"c{n}": p["a"] if n % 3 else p["b"] for n in range(40)}) for p in people]
    schema = SCHEMA + "".join(f", c{n} date" for n in range(40))
    frame = spark.createDataFrame([tuple(p.values()) for p in wide], schema)
    study, conditions = Study(measure, YEARLY), ["a", *[f"c{n}" for n in range(40)], "b"]
    rows = analyse(frame, conditions, ["sex"], study).collect()
    expected = brute(wide, conditions, ["sex"], study)
    assert len(rows) == len(expected)
    for r in rows:
        numerator, denominator = expected[r["Condition"], r["Group"], r["Subgroup"], r["Date"]]
        assert r["Numerator"] == numerator
        assert r["Denominator"] == pytest.approx(denominator, abs=1e-12)


def test_single_point_and_no_strata(spark):
    study = Study(PREVALENCE, StudyGrid.between(date(2002, 7, 1), date(2002, 8, 1)))
    assert len(check(spark, some_people(50, seed=2), [], study)) == 2


def test_zero_denominator_gives_no_rate(spark):
    frame = spark.createDataFrame([tuple(person(D(2010, 1, 1), D(2011, 1, 1)).values())], SCHEMA)
    rows = analyse(frame, ["a"], [], Study(PREVALENCE, YEARLY)).collect()
    assert len(rows) == 5
    assert all(r["Denominator"] == 0 and r["Prevalence"] is None and r["Upper_CI"] is None for r in rows)


def test_rate_and_limits(spark):
    people = [person(D(2000, 1, 1), D(2010, 1, 1), D(2000, 5, 5) if n < 3 else None) for n in range(40)]
    frame = spark.createDataFrame([tuple(p.values()) for p in people], SCHEMA)
    row = analyse(frame, ["a"], [], Study(PREVALENCE, YEARLY), alpha=0.1, per=1000).first()
    low, high = exact_limits(0.1)[3]
    assert row["Prevalence"] == pytest.approx(1000 * 3 / 40)
    assert row["Lower_CI"] == pytest.approx(1000 * low / 40)
    assert row["Upper_CI"] == pytest.approx(1000 * high / 40)


def test_sums_over_a_cross_equal_its_parts(spark):
    """Age and sex cells add up to the stratum alone, for both measures, with every row matched."""
    people = some_people(600, seed=9)
    frame = spark.createDataFrame([tuple(p.values()) for p in people], SCHEMA)
    for measure in (INCIDENCE, PREVALENCE):
        rows = analyse(frame, ["a", "b"], ["band", ["sex", "band"]], Study(measure, YEARLY)).collect()
        sums, alone = {}, {}
        for r in rows:
            if r["Group"] == "sex, band":
                key = (r["Condition"], r["Subgroup"].split(", ")[1], r["Date"])
                sums[key] = sums.get(key, 0) + r["Numerator"]
            elif r["Group"] == "band":
                alone[r["Condition"], r["Subgroup"], r["Date"]] = r["Numerator"]
        assert alone and sums == alone


def test_both_measures_in_one_pass(spark):
    frame = spark.createDataFrame([tuple(p.values()) for p in some_people(200, seed=3)], SCHEMA)
    studies = [Study(INCIDENCE, MONTHLY), Study(PREVALENCE, YEARLY)]
    cells = rate_cells(frame, ["a", "b"], ["sex"], studies)
    for study in studies:
        together = crude_rates(cells, study, ["a", "b"], ["sex"])
        alone = analyse(frame, ["a", "b"], ["sex"], study)
        assert sorted(map(str, together.collect())) == sorted(map(str, alone.collect()))


def test_kept_strata_and_odd_names(spark):
    frame = spark.createDataFrame(
        [(D(2000, 1, 1), D(2009, 1, 1), D(2001, 2, 2), "it's", 3)],
        "`in` date, `out` date, `BD_MEDI:x.y` date, `my stratum` string, `a``b` int",
    )
    study = Study(PREVALENCE, YEARLY)
    rows = analyse(
        frame, ["BD_MEDI:x.y"], [["my stratum", "a`b"]], study,
        index_date="in", end_date="out", keep_strata=True,
    ).collect()
    assert {(r["my stratum"], r["a`b"]) for r in rows} == {(None, None), ("it's", "3")}
    assert {(r["Condition"], r["Group"], r["Subgroup"]) for r in rows} == {
        ("BD_MEDI:x.y", "Overall", ""),
        ("BD_MEDI:x.y", "my stratum, a`b", "it's, 3"),
    }


@pytest.mark.parametrize("name", ["period", "days", "kind", "amount", "condition", "Condition", "numerator", "Measure", "stratum_0", "batch"])
def test_strata_of_any_name(spark, name):
    people = spark.createDataFrame([tuple(p.values()) for p in some_people(80, seed=2)], SCHEMA)
    for study in (Study(PREVALENCE, YEARLY), Study(INCIDENCE, YEARLY)):
        wanted = analyse(people, ["a"], ["sex", ["sex", "band"]], study)
        found = analyse(people.withColumnRenamed("sex", name), ["a"], [name, [name, "band"]], study)
        renamed = [str(r).replace(f"Group='{name}", "Group='sex") for r in found.collect()]
        assert sorted(renamed) == sorted(map(str, wanted.collect()))


def test_refused_arguments(spark):
    frame = spark.createDataFrame([tuple(EDGES[0].values())], SCHEMA).withColumnRenamed("sex", "numerator")
    with pytest.raises(ValueError, match="kept"):
        analyse(frame, ["a"], ["numerator"], Study(PREVALENCE, YEARLY), keep_strata=True)
    with pytest.raises(ValueError, match="nothing"):
        analyse(frame, ["a"], [], Study(PREVALENCE, YEARLY), overall=False)
    with pytest.raises(ValueError):
        analyse(frame, [], [], Study(PREVALENCE, YEARLY))


def test_both_measures_in_one_table(spark):
    frame = spark.createDataFrame([tuple(p.values()) for p in some_people(200, seed=4)], SCHEMA)
    studies = [Study(INCIDENCE, MONTHLY), Study(PREVALENCE, YEARLY)]
    cells = rate_cells(frame, ["a", "b"], ["sex"], studies)
    both = crude_rates(cells, studies, ["a", "b"], ["sex"])
    for study in studies:
        alone = analyse(frame, ["a", "b"], ["sex"], study).withColumnRenamed(study.measure, "Rate")
        alone = alone.withColumn("Denominator", alone["Denominator"].cast("double"))
        mine = both.where(both["Measure"] == study.measure).drop("Measure")
        assert sorted(map(str, mine.collect())) == sorted(map(str, alone.collect()))


def test_cohort_long(spark):
    frame = spark.createDataFrame([tuple(EDGES[0].values())], SCHEMA)
    rows = cohort_long(frame, ["a", "b"], ["sex", ["sex", "band"]]).collect()
    assert {(r["Condition"], r["EVENT_DATE"], r["Group"], r["Subgroup"]) for r in rows} == {
        (c, e, g, s)
        for c, e in (("a", D(2001, 1, 1)), ("b", None))
        for g, s in (("Overall", ""), ("sex", "F"), ("sex, band", "F, null"))
    }


@pytest.mark.parametrize("measure", [INCIDENCE, PREVALENCE])
def test_changed_cells_are_those_of_a_full_run(spark, measure):
    """Persons who come, go and are corrected, and a condition added later; sums over a cross still equal its parts."""
    study, strata = Study(measure, MONTHLY), ["band", ["sex", "band"]]
    before, after = some_people(300, 5), some_people(300, 5)
    rng = random.Random(8)
    gone, corrected, come = before[:20] + [p for p in before if p["band"] == "x"], range(40, 90), some_people(60, 6)
    for i in corrected:
        after[i] = {**after[i], "a": after[i]["END_DATE"], "sex": rng.choice("FMI"), "band": "new"}
    now = [p for k, p in enumerate(after) if k >= 20 and not (p["band"] == "x" and p in gone)] + come
    signed = [(*p.values(), -1) for p in gone] + [(*p.values(), 1) for p in come]
    kept = [k for k in corrected if before[k] not in gone]
    now = [p for k, p in enumerate(after) if before[k] not in gone] + come
    signed += [(*before[k].values(), -1) for k in kept] + [(*after[k].values(), 1) for k in kept]
    signed = [r for r in signed]
    frame = spark.createDataFrame([tuple(p.values()) for p in before], SCHEMA)
    changes = spark.createDataFrame(signed, SCHEMA + ", which int")
    full = spark.createDataFrame([tuple(p.values()) for p in now], SCHEMA)
    cells = rate_cells(frame, ["a"], strata, [study])
    first = merge_cells(cells, rate_cells(changes, ["a"], strata, [study], sign="which"))
    merged = merge_cells(first, condition_cells(rate_cells(full, ["b"], strata, [study])))
    rows = {(r["Condition"], r["Group"], r["Subgroup"], r["Date"]): tuple(r) for r in crude_rates(merged, study, ["a", "b"], strata).collect()}
    wanted = {(r["Condition"], r["Group"], r["Subgroup"], r["Date"]): tuple(r) for r in analyse(full, ["a", "b"], strata, study).collect()}
    assert rows == wanted and any(k[2] == "new" for k in rows)
    numerator = list(crude_rates(merged, study, ["a"], strata).columns).index("Numerator")
    for (condition, group, label, day), row in rows.items():
        if group == "band":
            parts = [r[numerator] for (c, g, s, d), r in rows.items() if (c, g, d) == (condition, "sex, band", day) and s.split(", ")[1] == label]
            assert parts and sum(parts) == row[numerator]
