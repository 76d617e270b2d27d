"""SQL texts that state the same results plainly: every rule per person and period, no shortcuts."""

from __future__ import annotations

from collections.abc import Sequence

from ..operators.grid import INCIDENCE, Study
from ..operators.rates import OVERALL, PER_PERSONS, strata_columns, strata_lists
from . import views
from .settings import CONDITIONS, DIGITS


#: The normal quantile and the exact Poisson limits of 0 to 9 events at 95 percent.
Z = 1.9599639845400536
EXACT = (
    (None, 3.688879454113936),
    (0.025317807984289842, 5.571643390938899),
    (0.2422092785439643, 7.224687667723961),
    (0.6186721228956016, 8.767273069742327),
    (1.0898653736263242, 10.241588675403698),
    (1.62348639011842, 11.66833207932267),
    (2.20189425349085, 13.059474022518685),
    (2.814363051519866, 14.422675361702378),
    (3.4538321767484996, 15.763189220193315),
    (4.115373097378331, 17.08480345141917),
)

#: Fixed value: what a person who is not at risk adds to the person-time, as a share of the period.
IDLE_SHARE = "1e-8"


def with_views(body: str, **ctes: str) -> str:
    """``body`` with the derived inputs it names put before it."""
    known = {
        "v_cohort": views.V_COHORT,
        "v_refpop": views.V_REFPOP,
        "v_practice_map": views.V_PRACTICE_MAP,
        "v_hospital": views.V_HOSPITAL,
        "v_deprivation": views.V_DEPRIVATION,
    }
    text = body + " ".join(ctes.values())
    parts = [f"{name} as ({sql})" for name, sql in known.items() if name in text]
    parts += [f"{name} as ({sql})" for name, sql in ctes.items()]
    return f"with {', '.join(parts)} {body}" if parts else body


def rounded(expression: str, digits: int = DIGITS) -> str:
    return f"round({expression}, {digits})"


def byar(count: str, upper: bool) -> str:
    whens = " ".join(
        f"when {n} then {'null' if limits[upper] is None else repr(limits[upper])}"
        for n, limits in enumerate(EXACT)
    )
    size = f"(cast({count} as double){' + 1' if upper else ''})"
    sign = "+" if upper else "-"
    core = f"(1 - 1 / (9 * {size}) {sign} {Z} / (3 * sqrt({size})))"
    return f"(case {count} {whens} else {size} * {core} * {core} * {core} end)"


def long_form(conditions: Sequence[str], strata, source: str = "v_cohort") -> str:
    parts = []
    for condition in conditions:
        rows = [(OVERALL, "''", ())]
        for item in strata_lists(strata):
            label = " || ', ' || ".join(f"coalesce({c}, 'null')" for c in item)
            rows.append((", ".join(item), label, item))
        for group, label, item in rows:
            columns = "".join(
                f", {f'''coalesce({c}, 'null')''' if c in item else 'cast(null as varchar)'} as {c}"
                for c in strata_columns(strata)
            )
            parts.append(
                f"select '{condition}' as \"Condition\", '{group}' as \"Group\", {label} as Subgroup{columns}, "
                f"INDEX_DATE as i, END_DATE as x, {condition} as e from {source}"
            )
    return " union all ".join(parts)


def periods(study: Study) -> str:
    dates = study.grid.dates
    pairs = zip(dates[:-1], dates[1:], strict=True) if study.measure == INCIDENCE else zip(dates, dates, strict=True)
    rows = ", ".join(f"(date '{lo}', date '{hi}')" for lo, hi in pairs)
    return f"select * from (values {rows}) as t(lo, hi)"


def counted(study: Study, strata=()) -> str:
    """Numerator and denominator per condition, breakdown and period, from frames ``longs`` and ``grid``."""
    if study.measure == INCIDENCE:
        numerator = "e >= lo and e < hi and e > i and x >= lo and i < hi"
        at_risk = "((e >= lo and e > i) or e is null) and x >= lo and i < hi"
        denominator = (
            f"sum(case when {at_risk} then date_diff('day', greatest(i, lo), least(x, coalesce(e, x), hi)) "
            f"else 0 end) / cast(date_diff('day', lo, hi) as double) "
            f"+ {IDLE_SHARE} * (count(*) - sum(case when {at_risk} then 1 else 0 end))"
        )
    else:
        numerator = "i <= lo and x >= lo and e <= lo"
        denominator = "cast(sum(case when i <= lo and x >= lo then 1 else 0 end) as bigint)"
    kept = "".join(f", {c}" for c in strata_columns(strata))
    return (
        f"select \"Condition\", \"Group\", Subgroup{kept}, lo as \"Date\", "
        f"cast(sum(case when {numerator} then 1 else 0 end) as bigint) as Numerator, {denominator} as Denominator "
        f"from longs, grid group by \"Condition\", \"Group\", Subgroup{kept}, lo, hi"
    )


def rates(study: Study, source: str = "counted", keep: Sequence[str] = ()) -> str:
    def per(top: str) -> str:
        return f"case when Denominator = 0 then null else {top} / Denominator * {PER_PERSONS} end"

    kept = "".join(f", {c}" for c in keep)
    return (
        f"select \"Condition\", \"Group\", Subgroup{kept}, \"Date\", Numerator, Denominator, "
        f"{per('cast(Numerator as double)')} as {study.measure}, "
        f"{per(byar('Numerator', False))} as Lower_CI, {per(byar('Numerator', True))} as Upper_CI from {source}"
    )


def crude_ctes(study: Study, strata=(), conditions: Sequence[str] = CONDITIONS, source: str = "v_cohort") -> dict[str, str]:
    return {
        "longs": long_form(conditions, strata, source),
        "grid": periods(study),
        "counted": counted(study, strata),
        "crude": rates(study, keep=strata_columns(strata)),
    }


def show_crude(study: Study, source: str = "crude", where: str = "true") -> str:
    denominator = rounded("Denominator") if study.measure == INCIDENCE else "Denominator"
    return (
        f"select \"Condition\", \"Group\", Subgroup, \"Date\", Numerator, {denominator} as Denominator, "
        f"{rounded(study.measure)} as {study.measure}, {rounded('Lower_CI')} as Lower_CI, "
        f"{rounded('Upper_CI')} as Upper_CI from {source} where {where}"
    )


def crude(study: Study, strata=(), where: str = "true") -> str:
    return with_views(show_crude(study, where=where), **crude_ctes(study, strata))
