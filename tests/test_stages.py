"""All stages from two extracts on disk to the published tables."""

import random
from datetime import date, timedelta

import pytest

from cohortrates.plans import stages
from cohortrates.sources.tables import scan_csv

AGES = ["0-16", "17-30", "31-40", "41-50", "51-60", "61-70", "71-80", "81+"]
HEADER = "PATIENT_ID,PRACTICE_ID,PRACTICE_PATIENT_ID,INDEX_DATE,END_DATE,BD_MEDI:one:4,BD_MEDI:two:17,extra,SEX,AGE_CATEGORY,area"


def extract(path, count, practices, seed):
    draw = random.Random(seed)
    lines = [HEADER]

    def shown(day):
        return f"{day.day}-{day.month}-{day.year}"

    for n in range(count):
        entry = date(1995, 1, 1) + timedelta(days=draw.randrange(3000))
        leave = entry + timedelta(days=draw.randrange(4000))
        events = [
            shown(entry + timedelta(days=draw.randrange(4000))) if draw.random() < 0.5 else "" for _ in range(3)
        ]
        practice = draw.choice(practices)
        lines.append(
            f"{seed}{n},{practice},{practice}_{n},{shown(entry)},{shown(leave)},{','.join(events)},"
            f"{draw.choice(['M', 'F', 'F', 'I'])},{draw.choice(AGES)},{draw.choice(['North', 'Mid Land', 'South', ''])}"
        )
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("study")
    extract(root / "a.csv", 900, ["p1", "p2", "p3"], 1)
    extract(root / "b.csv", 900, ["p11", "p12"], 2)
    (root / "map.txt").write_text("a\tname\tb\n1\tx\t11\n2\tx\t99\n")
    (root / "imd.csv").write_text("pracid,imd\n2,1*\n11,5\n")
    (root / "pop.csv").write_text(
        "Age,Sex,Count\n"
        + "".join(f"{'90+' if age == 90 else age},{sex},{1000 + age}\n" for age in range(91) for sex in ("Female", "Male"))
        + "Total,Male,1\n"
    )
    demography = ["area", ["AGE_CATEGORY", "SEX"], ["AGE_CATEGORY", "SEX", "area"], ["AGE_CATEGORY", "SEX", "area", "IMD_pracid"]]
    config = {
        "dir_data": f"{root}/",
        "dir_out": f"{root}/out/",
        "date_fmt": "%d-%m-%Y",
        "processing": {
            "filename": None, "filename_gold": "a.csv", "filename_aurum": "b.csv",
            "map_file_AtoB": "map.txt", "map_delim_AtoB": "\t", "path_hes": None,
            "mergeCols_AtoB": {"BD_any": ["BD_MEDI:one", "extra"]}, "rm_old_cols": False,
            "combineLevels": {"area": {"Rest": ["South", "Mid Land"]}},
            "link_imd": True, "imd_map_file": "imd.csv",
        },
        "incprev": {
            "filename": "dat_processed.parquet", "col_end_date": "END_DATE", "col_index_date": "INDEX_DATE",
            "start_date": {"inc": {"year": 1999, "month": 1, "day": 1}, "prev": {"year": 1999, "month": 7, "day": 1}},
            "end_date": {"inc": {"year": 2001, "month": 12, "day": 31}, "prev": {"year": 2001, "month": 12, "day": 31}},
            "BD_LIST": None, "INCREMENT_BY_MONTH": 12, "DEMOGRAPHY": demography,
        },
        "strd": {
            "reference_population": "pop.csv", "age_bins": [0, 16, 30, 40, 50, 60, 70, 80, 115], "age_group_labels": AGES,
            "standard_breakdowns": {"Overall": "AGE_CATEGORY, SEX", "area": "AGE_CATEGORY, SEX, area"},
        },
        "censor": {"n": 10, "strd": True},
        "report": {
            "table1": True, "table1_catgs": ["SEX", "area"], "table1_nums": [],
            "crude": True, "catgs_crude": ["Overall", "area"], "strd": True, "catgs_strd": ["Overall", "area"],
        },
    }
    stages.run(spark, config)
    return root, config


def read(spark, study, name):
    return spark.read.parquet(f"{study[0]}/out/{name}.parquet")


def test_processed_cohort(spark, study):
    cohort = spark.read.parquet(f"{study[0]}/dat_processed.parquet")
    assert set(cohort.columns) >= {"BD_MEDI:one", "BD_MEDI:two", "BD_any", "extra", "IMD_pracid"}
    practices = {r[0] for r in cohort.select("PRACTICE_ID").distinct().collect()}
    assert practices == {"p2", "p3", "p11", "p12"}
    assert {r[0] for r in cohort.select("area").distinct().collect()} == {"North", "Rest", None}
    assert {r[0] for r in cohort.where("PRACTICE_ID = 'p2'").select("IMD_pracid").distinct().collect()} == {"1"}
    stats = scan_csv(spark, f"{study[0]}/LINK_STATS.csv").first()
    assert stats["n_inA_inB"] == "1" and stats["n_inA_notB"] == "1"


def test_crude_results(spark, study):
    crude = read(spark, study, "prev_crude")
    rows = crude.where("Group = 'Overall' AND Condition = 'BD_any'").orderBy("Date").collect()
    assert [str(r["Date"]) for r in rows] == ["1999-07-01", "2000-07-01", "2001-07-01"]
    cohort = spark.read.parquet(f"{study[0]}/dat_processed.parquet").selectExpr(
        "to_date(INDEX_DATE, 'd-M-yyyy') AS i", "to_date(END_DATE, 'd-M-yyyy') AS x", "BD_any AS e"
    )
    for r in rows:
        here = cohort.where(f"i <= date'{r['Date']}' AND x >= date'{r['Date']}'")
        assert here.count() == r["Denominator"]
        assert here.where(f"e <= date'{r['Date']}'").count() == r["Numerator"]
    assert {r[0] for r in crude.select("Condition").distinct().collect()} == {"BD_any", "BD_MEDI:one", "BD_MEDI:two"}
    csv = scan_csv(spark, f"{study[0]}/out/prev_crude.csv")
    assert csv.columns == ["Condition", "Group", "Subgroup", "Date", "Numerator", "Denominator", "Prevalence", "Lower_CI", "Upper_CI"]
    assert csv.count() == crude.count()


def test_cells_sum_to_their_stratum(spark, study):
    """Cases over age and sex add up to those of the area alone, where intersex persons are counted."""
    for short in ("inc", "prev"):
        crude = read(spark, study, f"{short}_crude")
        cells = crude.where("Group = 'AGE_CATEGORY, SEX, area'").groupBy("Condition", "area", "Date").sum("Numerator")
        alone = crude.where("Group = 'area'").select("Condition", "area", "Date", "Numerator")
        joined = alone.join(cells, ["Condition", "area", "Date"]).collect()
        assert len(joined) == alone.count() == cells.count() > 0
        assert all(r["Numerator"] == r["sum(Numerator)"] for r in joined)


def test_published_results_hold_no_small_count(spark, study):
    for short, measure in (("inc", "Incidence"), ("prev", "Prevalence")):
        crude = read(spark, study, f"Publish/{short}_crude")
        assert crude.where("Numerator <= 10 OR Denominator <= 10").count() == 0
        assert crude.where(f"{measure} IS NOT NULL AND (Numerator IS NULL OR Denominator IS NULL)").count() == 0
        assert {r[0] for r in crude.select("Condition").distinct().collect()} == {"BDany", "one", "two"}
        dsr, kept = read(spark, study, f"{short}_DSR"), read(spark, study, f"Publish/{short}_DSR")
        assert dsr.count() == kept.count() > 0
        assert {r[0] for r in dsr.select("Subgroup").distinct().collect()} == {"Overall", "North", "Rest", "null"}
        assert kept.where(f"Subgroup = 'Overall' AND {measure} IS NOT NULL").count() > 0


def test_reports(spark, study):
    out = f"{study[0]}/out"
    table = scan_csv(spark, f"{out}/table1.csv")
    assert table.columns == ["line", "Group", "Subgroup", "Missing", "Count"]
    assert table.count() == 5
    for root in (out, f"{out}/Publish"):
        for name in ("inc_crude", "prev_crude", "inc_DSR", "prev_DSR"):
            points = scan_csv(spark, f"{root}/report/{name}_series.csv")
            assert points.count() > 0
            assert scan_csv(spark, f"{root}/report/{name}_limits.csv").count() > 0
            assert scan_csv(spark, f"{root}/report/{name}_error_bars.csv").count() > 0
