"""Crude incidence rates and point prevalence.

A person is at risk, or a case, over one unbroken run of study periods. So a person is turned into
a few dated changes - entering and leaving the population, becoming and ceasing to be a case -
instead of one value per period, and the periods are restored by running totals over the small
aggregated table. The work per person does not depend on the number of periods, and a person
without a condition yields nothing for it: the population is counted once and each event only
corrects it.

All person-level sums are integers, so results do not depend on the order of rows.

Steps::

    person rows --rate_cells--> sums per measure, condition, finest stratum, period
                --crude_rates--> grouping sets, running totals, rate and limits

Only the first step reads person rows. Its shuffle is preceded by map-side sums, so a stratum that
holds a large part of all persons sends no more rows than any other. Its columns are added in short
projections, each of which compiles to a method small enough for the JVM to optimise.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import NO_STRATUM, named, quoted, strata_label, text
from ..functions.limits import byar_lower, byar_upper
from .grid import INCIDENCE, PREVALENCE, Study

PER_PERSONS = 100_000

#: Share of a period that a person who does not contribute adds to the person-time.
IDLE_SHARE = 1e-8

OVERALL = "Overall"

#: Kinds of change at a period: counted there, from there on, up to and including it.
COUNT, ON, OFF = "count", "on", "off"

#: Conditions are numbered ``batch_slot`` while persons are read; the first number is the person.
BATCH = 16
PERSON = "0_0"

#: What a change does to the running totals of a stratum, once its kind has been told apart.
CHANGES = ("persons", "enter", "leave", "idle_days", "case_on", "case_off")

#: Columns of results, which no stratum that is kept beside them may be called, in any case.
RESERVED = {
    "measure", "condition", "group", "subgroup", "date", "numerator", "denominator", "lower_ci", "upper_ci",
    INCIDENCE.lower(), PREVALENCE.lower(), "rate", "active", "breakdown",
}

#: Strata stand in cells under a name of their own, so that they cannot meet another column.
CELL_STRATUM = "stratum {}"

StrataSpec = Sequence["str | Sequence[str]"]


def strata_lists(strata: StrataSpec) -> list[tuple[str, ...]]:
    """Each item as a tuple of columns, repeated items once."""
    lists = [(item,) if isinstance(item, str) else tuple(item) for item in strata]
    return list(dict.fromkeys(lists))


def strata_columns(strata: StrataSpec) -> list[str]:
    return list(dict.fromkeys(name for item in strata_lists(strata) for name in item))


def fill_strata(cohort: DataFrame, names: Sequence[str]) -> DataFrame:
    """Strata as text, with absent values shown as ``null``."""
    filled = {n: F.expr(f"coalesce(string({quoted(n)}), '{NO_STRATUM}')") for n in names}
    return cohort.withColumns(filled) if filled else cohort


def cohort_long(
    cohort: DataFrame,
    conditions: Sequence[str],
    strata: StrataSpec = (),
    index_date: str = "INDEX_DATE",
    end_date: str = "END_DATE",
) -> DataFrame:
    """One row per person, condition and breakdown, the breakdowns as ``Group`` and ``Subgroup``."""
    events = F.array(
        *[F.struct(F.lit(c).alias("Condition"), named(c).alias("EVENT_DATE")) for c in conditions]
    )
    breakdowns = [F.struct(F.lit(OVERALL).alias("Group"), F.lit("").alias("Subgroup"))] + [
        F.struct(F.lit(", ".join(item)).alias("Group"), strata_label(item).alias("Subgroup"))
        for item in strata_lists(strata)
    ]
    dates = [named(index_date).alias("INDEX_DATE"), named(end_date).alias("END_DATE")]
    return (
        cohort.select(*dates, events.alias("e"), F.array(*breakdowns).alias("b"))
        .select("INDEX_DATE", "END_DATE", "b", F.inline("e"))
        .select("INDEX_DATE", "END_DATE", "Condition", "EVENT_DATE", F.inline("b"))
    )


class _Spell:
    """SQL for the periods a person is in the population of one study, and for an event in them.

    Columns are given as ``name -> SQL`` in an order in which each may use those before it; ``@``
    stands for the prefix of the study.
    """

    def __init__(self, study: Study, tag: str):
        self.study, self.tag = study, tag
        self.last = study.n_periods - 1

    def _tagged(self, columns: dict[str, str]) -> list[str]:
        return [f"{sql} AS @{name}".replace("@", self.tag) for name, sql in columns.items()]

    def person_columns(self) -> list[str]:
        """First and last period at risk, null if there is none, and the days idle in them."""
        grid = self.study.grid
        columns = {"entry": grid.day("index_date"), "exit": grid.day("end_date")}
        if self.study.measure == INCIDENCE:
            # the first period that ends after entry
            columns["start"] = f"greatest({grid.position('@entry')}, 0)"
        else:
            # the first grid date on or after entry
            columns["start"] = f"{grid.position('(@entry - 1)')} + 1"
        columns["stop"] = f"least({grid.position('@exit')}, {self.last})"
        known = "@entry IS NOT NULL AND @exit IS NOT NULL"
        columns["first"] = f"CASE WHEN {known} AND @start <= @stop AND @stop >= 0 THEN @start END"
        columns["final"] = "CASE WHEN @first IS NOT NULL THEN @stop END"
        if self.study.measure == INCIDENCE:
            columns["lead"] = f"greatest(@entry - {grid.offset_of('@first')}, 0)"
            columns["tail"] = f"greatest({grid.offset_of('@final + 1')} - @exit, 0)"
        return self._tagged(columns)

    def event_columns(self) -> list[str]:
        """Period of the event and, for incidence, the last period at risk because of it."""
        grid, event = self.study.grid, f"Condition <> '{PERSON}'"
        if self.study.measure == INCIDENCE:
            columns = {
                "event": grid.day("event_date"),
                "new": "@event > @entry",
                "at": grid.position("@event"),
                "early": "@event < @exit",
                "never": f"{event} AND (NOT @new OR (@early AND @at < @first))",
                "shorter": f"{event} AND @new AND @early AND @at >= @first",
                "cut": f"CASE WHEN @shorter THEN least(@at, {self.last}) END",
            }
        else:
            columns = {
                "event": f"greatest({grid.day('event_date')}, @entry)",
                "at": f"CASE WHEN {event} THEN {grid.position('(@event - 1)')} + 1 END",
            }
        return self._tagged(columns)

    def changes(self) -> list[tuple[str, str, str, str, str]]:
        """The changes of one row: prefix, kind, and SQL for period, amount and idle days.

        The row of a person says when the person is in the population; the row of an event corrects
        that for its condition. A change whose period is null does not take place.
        """
        person = f"Condition = '{PERSON}'"
        if self.study.measure == INCIDENCE:
            grid = self.study.grid
            case = f"@new AND @at BETWEEN 0 AND {self.last} AND @exit >= {grid.offset_of('@at')}"
            sign = f"CASE WHEN {person} THEN 1 ELSE -1 END"
            changes = [
                (COUNT, f"CASE WHEN {person} THEN 0 WHEN {case} THEN @at END", "1", "0"),
                (ON, f"CASE WHEN {person} OR @never THEN @first END", sign, f"{sign} * @lead"),
                (OFF, f"CASE WHEN {person} OR @never OR @shorter THEN @final END", sign, f"{sign} * @tail"),
                (OFF, "@cut", "1", f"greatest({grid.offset_of('@cut + 1')} - @event, 0)"),
            ]
        else:
            changes = [
                (COUNT, f"CASE WHEN {person} THEN 0 END", "1", "0"),
                (ON, f"CASE WHEN {person} THEN @first WHEN @at <= @final THEN @at END", "1", "0"),
                (OFF, f"CASE WHEN {person} OR @at <= @final THEN @final END", "1", "0"),
            ]
        return [(self.tag, kind, *(part.replace("@", self.tag) for part in parts)) for kind, *parts in changes]


def _dates_listed(persons: DataFrame, codes: list[str]) -> DataFrame:
    """One row per date that is present, the other columns beside it.

    An expansion over very many columns would compile to a method too large for the JVM to
    optimise, so dates are listed in two steps; a batch without any date ends after the first.
    """
    kept = [c for c in persons.columns if c not in codes]
    slots = [f"_{i}" for i in range(BATCH)]
    batches = [codes[i : i + BATCH] for i in range(0, len(codes), BATCH)]
    filled = [[f"`{c}`" for c in batch] + ["no_date"] * (BATCH - len(batch)) for batch in batches]
    values = ", ".join(f"({', '.join(columns)}) AS `{i}`" for i, columns in enumerate(filled))
    by_batch = persons.sparkSession.sql(
        f"SELECT * FROM {{wide}} UNPIVOT INCLUDE NULLS (({', '.join(slots)}) FOR batch IN ({values}))",
        wide=persons.selectExpr("*", "date(null) AS no_date"),
    ).where(f"coalesce({', '.join(slots)}) IS NOT NULL")
    return (
        by_batch.unpivot([*kept, "batch"], [F.col(s) for s in slots], "slot", "event_date")
        .where("event_date IS NOT NULL")
        .selectExpr(*kept, "concat(batch, slot) AS Condition", "event_date")
    )


def rate_cells(
    cohort: DataFrame,
    conditions: Sequence[str],
    strata: StrataSpec,
    studies: Sequence[Study],
    index_date: str = "INDEX_DATE",
    end_date: str = "END_DATE",
    sign: str | None = None,
) -> DataFrame:
    """Sums of changes by measure, condition, finest stratum, kind and period, in one pass.

    With ``sign``, a column of 1 and -1, rows count for or against: a person's outdated row and the new one make
    cells that ``merge_cells`` adds to those of all persons.

    ``cohort`` has one row per person with typed dates. The rows with a null ``Condition`` hold the
    population that all conditions share. Both unpivots are expansions inside generated code: they
    build no arrays and no objects per row.
    """
    if not conditions:
        raise ValueError("no conditions given")
    names = strata_columns(strata)
    keys = [f"stratum_{i}" for i in range(len(names))]
    spells = [_Spell(study, f"s{i}_") for i, study in enumerate(studies)]
    codes = {f"{i // BATCH}_{i % BATCH}": c for i, c in enumerate([PERSON, *conditions])}
    # names of this plan only, so that later expressions cannot meet a column of the cohort
    persons = cohort.selectExpr(
        *[f"coalesce(string({quoted(n)}), '{NO_STRATUM}') AS {k}" for n, k in zip(names, keys, strict=True)],
        f"date({quoted(index_date)}) AS index_date",
        f"date({quoted(end_date)}) AS end_date",
        *([f"int({quoted(sign)}) AS row_sign"] if sign else []),
        *[("date'1970-01-01'" if code == PERSON else f"date({quoted(c)})") + f" AS `{code}`" for code, c in codes.items()],
    ).selectExpr(*keys, *(["row_sign"] if sign else []), *[f"`{code}`" for code in codes], *[c for s in spells for c in s.person_columns()])
    rows = _dates_listed(persons, list(codes))
    changes = [c for s in spells for c in s.changes()]
    wide = rows.selectExpr("*", *[c for s in spells for c in s.event_columns()]).selectExpr(
        *keys,
        "Condition",
        *[
            f"int({sql}){' * row_sign' if sign and what != 'period' else ''} AS {what}_{i}"
            for i, (_, _, *parts) in enumerate(changes)
            for what, sql in zip(("period", "amount", "days"), parts, strict=True)
        ],
    )
    slots = ", ".join(f"(period_{i}, amount_{i}, days_{i}) AS `{tag}{kind}`" for i, (tag, kind, *_) in enumerate(changes))
    long = cohort.sparkSession.sql(
        f"SELECT * FROM {{wide}} UNPIVOT INCLUDE NULLS ((period, amount, days) FOR change IN ({slots}))", wide=wide
    ).where("period IS NOT NULL")
    sums = long.groupBy("Condition", *keys, "change", "period").agg(
        F.sum("amount").alias("amount"), F.sum("days").alias("days")
    )
    condition = " ".join(f"WHEN '{code}' THEN {text(c)}" for code, c in codes.items() if code != PERSON)
    measure = " ".join(f"WHEN startswith(change, '{s.tag}') THEN '{s.study.measure}'" for s in spells)
    return sums.selectExpr(
        f"CASE {measure} END AS Measure",
        f"CASE Condition {condition} END AS Condition",
        *[f"{k} AS {quoted(CELL_STRATUM.format(n))}" for n, k in zip(names, keys, strict=True)],
        "substring_index(change, '_', -1) AS kind",
        "period",
        "amount",
        "days",
    )


def merge_cells(cells: DataFrame, *more: DataFrame) -> DataFrame:
    """The cells of all persons after changes: all are sums, so they add up.

    ``more`` are cells of signed rows, of persons who came later, or, by ``condition_cells``, of further conditions.
    Cells that changes bring to nothing go, as if they had never been. Persons are not read again.
    """
    every = reduce(lambda a, b: a.unionByName(b), more, cells)
    keys = [named(c) for c in cells.columns if c not in ("amount", "days")]
    return every.groupBy(*keys).agg(F.sum("amount").alias("amount"), F.sum("days").alias("days")).where("amount <> 0 OR days <> 0")


def condition_cells(cells: DataFrame) -> DataFrame:
    """Cells without those of the population, which another table of the same persons has already."""
    return cells.where("Condition IS NOT NULL")


def crude_rates(
    cells: DataFrame,
    study: Study | Sequence[Study],
    conditions: Sequence[str],
    strata: StrataSpec = (),
    overall: bool = True,
    per: float = PER_PERSONS,
    alpha: float = 0.05,
    keep_strata: bool = False,
) -> DataFrame:
    """Numerator, denominator, rate and limits per condition, breakdown, stratum and period.

    With ``keep_strata`` the stratum columns stay beside the ``Subgroup`` label; those that are not
    part of a row's breakdown are null. Several studies are worked out together: their rates stand in
    one column ``Rate``, and ``Measure`` tells them apart.
    """
    together = not isinstance(study, Study)
    studies = list(study) if together else [study]
    if len({s.measure for s in studies}) != len(studies):
        raise ValueError("studies worked out together must differ in their measure")
    lists = strata_lists(strata)
    names = strata_columns(strata)
    clash = {n.lower() for n in names} & RESERVED
    if keep_strata and clash:
        raise ValueError(f"strata that are kept must not be called {sorted(clash)}")
    if not lists and not overall:
        raise ValueError("no strata and no overall rate: nothing to work out")

    def by_measure(sql: Callable[[Study], str]) -> str:
        """SQL that depends on the study, which is that of the row."""
        if not together:
            return sql(studies[0])
        return f"CASE Measure {' '.join(f'WHEN {text(s.measure)} THEN {sql(s)}' for s in studies)} END"

    keys = [f"stratum_{i}" for i in range(len(names))]
    key_of = dict(zip(names, keys, strict=True))
    sets = list(dict.fromkeys(tuple(key_of[n] for n in names if n in item) for item in lists))
    if overall:
        sets.insert(0, ())
    roles = cells.where(F.col("Measure").isin(*[s.measure for s in studies])).selectExpr(
        "Measure",
        "Condition",
        "period",
        *[f"{quoted(CELL_STRATUM.format(n))} AS {k}" for n, k in key_of.items()],
        *[
            by_measure(lambda s, i=i: "CASE WHEN {2} THEN {1} ELSE 0 END".format(*_roles(s)[i])) + f" AS {name}"
            for i, name in enumerate(CHANGES)
        ],
    )
    sums = [F.expr(f"sum({c}) AS {c}") for c in CHANGES]
    fixed = ["Measure", "Condition", "period"]
    if names:
        flags = [F.expr(f"grouping({k}) AS left_out_{k}") for k in keys]
        grouped = roles.groupingSets([[*fixed, *chosen] for chosen in sets], *fixed, *keys).agg(*sums, *flags)
        branches = " ".join(
            "WHEN " + " AND ".join(f"left_out_{k} = {int(k not in chosen)}" for k in keys) + f" THEN {i}"
            for i, chosen in enumerate(sets)
        )
        number = f"CASE {branches} END"
    else:
        grouped = roles.groupBy(*fixed).agg(*sums)
        number = "0"

    # Only now, rolled up, is the population repeated for every condition. Rows of a stratum meet in
    # one partition: at most two per period, so merging and running totals need no other shuffle.
    everyone = ", ".join(map(text, conditions))
    stratum = ["Measure", "Condition", "breakdown", *keys]
    merged = (
        grouped.selectExpr(
            "Measure",
            f"explode(CASE WHEN Condition IS NULL THEN array({everyone}) ELSE array(Condition) END) AS Condition",
            "period",
            *keys,
            *CHANGES,
            f"{number} AS breakdown",
        )
        .repartition(*stratum)
        .groupBy(*stratum, "period")
        .agg(*sums)
    )
    # every stratum has a row for period 0, so filling forward from each row restores all periods
    window = f"OVER (PARTITION BY {', '.join(stratum)} ORDER BY period"
    running = f"{window} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    dense = merged.selectExpr(
        *stratum,
        "period AS changed",
        "leave",
        "idle_days",
        "case_off",
        *[f"sum({c}) {running} AS sum_{c}" for c in CHANGES if c != "idle_days"],
        f"coalesce(lead(period) {window}), {by_measure(lambda s: str(s.n_periods))}) AS until",
    ).selectExpr("*", "explode(sequence(changed, until - 1)) AS period")

    def standing(on: str, off: str) -> str:
        return f"sum_{on} - sum_{off} + CASE WHEN period = changed THEN {off} ELSE 0 END"

    def denominator(s: Study) -> str:
        if s.measure != INCIDENCE:
            return "double(active)" if together else "active"
        length = f"({s.grid.offset_of('(period + 1)')} - {s.grid.offset_of('period')})"
        idle = "CASE WHEN period = changed THEN idle_days ELSE 0 END"
        return f"({length} * active - {idle}) / double({length}) + {IDLE_SHARE!r}D * (sum_persons - active)"

    measured = dense.selectExpr(
        "*",
        f"inline({_breakdown_labels(sets, lists, key_of)})",
    ).selectExpr(
        *(["Measure"] if together else []),
        "Condition",
        "`Group`",
        "Subgroup",
        *[f"{k} AS {quoted(n)}" for n, k in key_of.items() if keep_strata],
        f"{by_measure(lambda s: s.grid.date_of('period'))} AS `Date`",
        f"{standing('case_on', 'case_off')} AS Numerator",
        f"{standing('enter', 'leave')} AS active",
        f"{by_measure(denominator)} AS Denominator",
    )
    return with_limits(measured.drop("active"), "Rate" if together else studies[0].measure, per, alpha)


def _roles(study: Study) -> list[tuple[str, str, str]]:
    """What each kind of change means: name of the total, column summed, condition on the cell."""
    person, event = "Condition IS NULL", "Condition IS NOT NULL"
    if study.measure == INCIDENCE:
        # events shorten the time at risk, and each is a case in its own period
        at_risk, on, off = "true", f"{event} AND kind = '{COUNT}'", f"{event} AND kind = '{COUNT}'"
    else:
        at_risk, on, off = person, f"{event} AND kind = '{ON}'", f"{event} AND kind = '{OFF}'"
    return [
        ("persons", "amount", f"{person} AND kind = '{COUNT}'"),
        ("enter", "amount", f"{at_risk} AND kind = '{ON}'"),
        ("leave", "amount", f"{at_risk} AND kind = '{OFF}'"),
        ("idle_days", "days", "true"),
        ("case_on", "amount", on),
        ("case_off", "amount", off),
    ]


def _breakdown_labels(sets, lists, key_of) -> str:
    """SQL for ``Group`` and ``Subgroup``: one pair, or more if lists differ only in their order."""
    branches = []
    for i, chosen in enumerate(sets):
        pairs = [
            f"named_struct('Group', {text(', '.join(item))}, "
            f"'Subgroup', concat_ws(', ', {', '.join(key_of[n] for n in item)}))"
            for item in lists
            if chosen and {key_of[n] for n in item} == set(chosen)
        ] or [f"named_struct('Group', '{OVERALL}', 'Subgroup', '')"]
        branches.append(f"WHEN {i} THEN array({', '.join(pairs)})")
    return f"CASE breakdown {' '.join(branches)} END"


def with_limits(counted: DataFrame, measure: str, per: float = PER_PERSONS, alpha: float = 0.05) -> DataFrame:
    """Rate and Byar limits per ``per`` persons; all null where the denominator is zero."""
    bottom = "nullif(double(Denominator), 0D)"
    return counted.withColumns(
        {
            measure: F.expr(f"double(Numerator) / {bottom}") * per,
            "Lower_CI": byar_lower("Numerator", alpha) / F.expr(bottom) * per,
            "Upper_CI": byar_upper("Numerator", alpha) / F.expr(bottom) * per,
        }
    )


def analyse(
    cohort: DataFrame,
    conditions: Sequence[str],
    strata: StrataSpec,
    study: Study,
    overall: bool = True,
    **options,
) -> DataFrame:
    """Crude rates of one study straight from a cohort."""
    dates = {k: options.pop(k) for k in ("index_date", "end_date") if k in options}
    cells = rate_cells(cohort, conditions, strata, [study], **dates)
    return crude_rates(cells, study, conditions, strata, overall, **options)
