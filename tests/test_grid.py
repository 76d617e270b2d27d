from datetime import date, timedelta

import pytest

from cohortrates.operators.grid import INCIDENCE, Study, StudyGrid, step_date


def test_each_date_steps_from_the_one_before():
    grid = StudyGrid.between(date(2001, 1, 31), date(2001, 4, 30), months=1)
    assert grid.dates == (date(2001, 1, 31), date(2001, 2, 28), date(2001, 3, 28), date(2001, 4, 28))


def test_leap_day_sticks_to_the_28th():
    grid = StudyGrid.between(date(2000, 2, 29), date(2004, 3, 1))
    assert grid.dates[-1] == date(2004, 2, 28)


def test_the_day_after_the_end_belongs_to_the_grid():
    assert StudyGrid.between(date(2001, 1, 1), date(2003, 12, 31)).dates[-1] == date(2004, 1, 1)
    assert StudyGrid.between(date(2001, 1, 1), date(2003, 12, 30)).dates[-1] == date(2003, 1, 1)


def test_mixed_steps():
    assert step_date(date(2001, 11, 30), years=1, months=3, days=2) == date(2003, 3, 2)


def test_bad_grids_are_refused():
    with pytest.raises(ValueError):
        StudyGrid.between(date(2001, 1, 1), date(2002, 1, 1), months=0)
    with pytest.raises(ValueError):
        StudyGrid.between(date(2001, 1, 1), date(2000, 1, 1))
    with pytest.raises(ValueError):
        Study(INCIDENCE, StudyGrid.between(date(2001, 1, 1), date(2001, 2, 1)))
    with pytest.raises(ValueError):
        Study("Mortality", StudyGrid.between(date(2001, 1, 1), date(2003, 2, 1)))


@pytest.mark.parametrize(
    "start, step",
    [
        (date(2000, 1, 31), {"months": 1}),
        (date(2000, 2, 29), {"months": 12}),
        (date(2000, 1, 1), {"months": 0, "days": 1}),
        (date(2000, 1, 1), {"months": 0, "days": 7}),
        (date(2000, 12, 31), {"months": 2, "days": 3}),
        (date(2003, 5, 5), {"months": 240}),
    ],
)
def test_position_is_the_last_date_not_after(spark, start, step):
    grid = StudyGrid.between(start, date(2004, 6, 1), **step)
    first, last = grid.dates[0] - timedelta(days=40), grid.dates[-1] + timedelta(days=40)
    span = (last - first).days
    rows = spark.range(span + 1).selectExpr(f"date_add(date'{first}', int(id)) AS d")
    placed = rows.selectExpr("d", f"{grid.day('d')} AS day").selectExpr("d", f"{grid.position('day')} AS p").collect()
    for row in placed:
        assert row["p"] == sum(g <= row["d"] for g in grid.dates) - 1, row


def test_uneven_grids_find_positions(spark):
    """Dates that crowd at the start, so that a proportional guess is far off."""
    days = sorted({date.fromordinal(date(2000, 1, 1).toordinal() + d) for d in [*range(40), 60, 100, 5_000, 9_000, 9_001, 20_000]})
    grid = StudyGrid(tuple(days))
    sql = grid.position("d")
    assert len(sql) < 20_000
    offsets = [(d - days[0]).days for d in days]
    found = spark.range(-3, 20_010, 7).selectExpr("int(id) AS d").selectExpr("d", f"{sql} AS at").collect()
    assert all(r["at"] == sum(o <= r["d"] for o in offsets) - 1 for r in found)
