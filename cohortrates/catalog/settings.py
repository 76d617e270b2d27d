"""The study every registered query uses."""

from __future__ import annotations

from datetime import date

from ..operators.grid import INCIDENCE, PREVALENCE, Study, StudyGrid

CONDITIONS = ["condition_a", "condition_b"]

STRATA = [
    "SEX",
    "PRACTICE_ID",
    ["FOLLOW_UP", "BALANCE_BAND"],
    ["PRACTICE_ID", "FOLLOW_UP"],
    ["AGE_CATEGORY", "BALANCE_BAND", "SEX"],
    ["BALANCE_BAND", "PRACTICE_ID", "SEX", "FOLLOW_UP"],
]

#: Breakdowns of standardised rates: what is compared besides age and sex.
BREAKDOWNS = {
    "practice": "AGE_CATEGORY, SEX, PRACTICE_ID",
    "balance": "AGE_CATEGORY, SEX, BALANCE_BAND",
    "balance over time": "AGE_CATEGORY, SEX, BALANCE_BAND, FOLLOW_UP",
    "Overall": "AGE_CATEGORY, SEX",
}

#: The age categories of the data, and the ages at which they begin.
AGE_BINS = [0, 16, 30, 40, 50, 60, 70, 80, 115]
AGE_LABELS = ["0-16", "17-30", "31-40", "41-50", "51-60", "61-70", "71-80", "81+"]

SMALL_COUNT = 10

INC = Study(INCIDENCE, StudyGrid.between(date(1997, 1, 1), date(1999, 12, 31)))
PREV = Study(PREVALENCE, StudyGrid.between(date(1997, 7, 1), date(1999, 12, 31)))
#: Long grids over all order dates; the month ends start on a 31st.
STUDY_END = date(2001, 12, 31)
INC_MONTHLY = Study(INCIDENCE, StudyGrid.between(date(1995, 1, 31), STUDY_END, months=1))
PREV_MONTHLY = Study(PREVALENCE, StudyGrid.between(date(1995, 1, 31), STUDY_END, months=1))
PREV_WEEKLY = Study(PREVALENCE, StudyGrid.between(date(1995, 1, 1), STUDY_END, months=0, days=7))

#: Decimals to which registered queries round, so that both engines print the same value.
DIGITS = 6
