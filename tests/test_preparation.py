from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortrates.operators import cleaning, linkage
from cohortrates.sources import keyed, maps, tables


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def test_csv_is_read_as_text_and_written_back(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text('id,when,group\n1,1-2-2001,x\n2,,\n3,11-12-2002,"a, b"\n')
    df = tables.scan(spark, str(source))
    assert {t for _, t in df.dtypes} == {"string"}
    parsed = tables.ingest_dates(df, ["when"], "%d-%m-%Y")
    assert rows(parsed) == [
        ("1", date(2001, 2, 1), "x"),
        ("2", None, None),
        ("3", date(2002, 12, 11), "a, b"),
    ]
    assert rows(tables.ingest_dates(parsed, ["when"], "%d-%m-%Y")) == rows(parsed)
    out = str(tmp_path / "out.parquet")
    tables.write_parquet(parsed, out)
    assert rows(tables.scan(spark, out, ["id", "when"])) == [r[:2] for r in rows(parsed)]
    tables.parquet_to_csv(spark, out, str(tmp_path / "back.csv"))
    assert rows(tables.scan(spark, str(tmp_path / "back.csv"))) == [
        ("1", "2001-02-01", "x"),
        ("2", None, None),
        ("3", "2002-12-11", "a, b"),
    ]
    with pytest.raises(ValueError):
        tables.scan(spark, "table.xlsx")


def test_empty_fields_are_read_as_null(spark, tmp_path):
    df = spark.createDataFrame([("", 1), (None, 2)], "label string, n int")
    tables.write_csv(df, str(tmp_path / "x.csv"))
    assert rows(tables.scan(spark, str(tmp_path / "x.csv"))) == [(None, "1"), (None, "2")]


def test_conditions_are_found_by_prefix(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`BD_a` int, `x` int, `BD_MEDI:b` int")
    assert tables.discover_conditions(df) == ["BD_a", "BD_MEDI:b"]


def test_code_list_numbers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`BD_MEDI:a:12` int, `BD_x:1` int, `BD_MEDI:b` int")
    assert cleaning.strip_codelist_suffix(df).columns == ["BD_MEDI:a", "BD_x:1", "BD_MEDI:b"]
    with pytest.raises(ValueError):
        cleaning.strip_codelist_suffix(df.withColumnRenamed("BD_x:1", "BD_MEDI:a:13"))


def test_merged_dates(spark):
    df = spark.createDataFrame(
        [("1-2-2001", date(2000, 1, 1), "5-5-1999", 1), (None, None, None, 2), (None, date(2003, 1, 1), None, 3)],
        "a string, b date, c string, id int",
    )
    merged = cleaning.merge_condition_dates(df, {"ab": ["a", "b"], "only": ["c"], "abc": ["ab", "a"]}, "%d-%m-%Y")
    assert merged.columns == ["c", "id", "abc"]
    assert rows(merged.select("id", "abc")) == [(1, date(2000, 1, 1)), (2, None), (3, date(2003, 1, 1))]
    kept = cleaning.merge_condition_dates(df, {"ab": ["a", "b"]}, "%d-%m-%Y", drop_sources=False)
    assert kept.columns == ["a", "b", "c", "id", "ab"]


def test_levels_are_recoded_in_order(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "v string")
    merged = cleaning.combine_levels(df, {"v": {"y": ["x"], "end": ["y"]}})
    assert rows(merged) == [("end",), ("end",), ("z",), (None,)]


def test_missing_words_and_names(spark):
    df = spark.createDataFrame([("", "none"), ("MISSING", "x"), ("a", "")], "p string, q string")
    assert rows(cleaning.sentinels_to_null(df)) == [("a", None), (None, "x"), (None, None)]
    assert rows(cleaning.sentinels_to_null(df, ["q"])) == [("", None), ("MISSING", "x"), ("a", None)]
    assert rows(cleaning.empty_to_null(df)) == [("MISSING", "x"), ("a", None), (None, "none")]
    names = spark.createDataFrame([("BD_MEDI:heart_x:1",)], "Condition string")
    assert rows(cleaning.clean_condition_names(names)) == [("heartx1",)]


def test_map_files(spark, tmp_path):
    path = tmp_path / "map.txt"
    path.write_text("old\tname\tnew\n1\ta\t11\n2\tb\t12\n1\tc\t13\n3\td\t\n")
    assert rows(maps.read_practice_map(spark, str(path))) == [("p1", "p13"), ("p2", "p12"), ("p3", "p")]
    path = tmp_path / "imd.csv"
    path.write_text("pracid,imd\n1,4*\n2, 5\n1,3é!\n")
    assert rows(maps.read_deprivation_map(spark, str(path))) == [("p1", "3é"), ("p2", "5")]
    path.write_text("patid,imd\n1,4*\n")
    assert rows(maps.read_deprivation_map(spark, str(path))) == [("1", "4*")]
    path.write_text("postcode,imd\n1,4\n")
    with pytest.raises(ValueError):
        maps.read_deprivation_map(spark, str(path))


def test_reference_weights(spark, tmp_path):
    path = tmp_path / "pop.csv"
    path.write_text("Age,Sex,Count\n0,Female,1\n15,Female,2\n16,Female,4\n90+,Male,8\n120,Male,16\nTotal,Male,99\n")
    weights = maps.read_reference(spark, str(path), [0, 16, 80, 115], ["0-16", "17-80", "81+"])
    assert rows(weights) == [("0-16, F", 3), ("17-80, F", 4), ("81+, M", 8)]


@pytest.fixture
def practices(spark):
    pairs = [("pa", "p1"), ("pb", "p2"), ("pc", "p3"), ("pd", "p4")]
    mapped = spark.createDataFrame(pairs, "id_a string, id_b string")
    a = spark.createDataFrame([(1, "pa"), (2, "pb"), (3, "px"), (4, None), (5, "pa")], "n int, PRACTICE_ID string")
    b = spark.createDataFrame([("6", "p1", True), ("7", "p3", False)], "n string, PRACTICE_ID string, more boolean")
    return mapped, a, b


def test_moved_practices_leave_a(practices):
    _, a, b = practices
    matched = linkage.match_practices(*practices)
    linked = linkage.link_practices(matched, a, b)
    assert linked.columns == ["n", "PRACTICE_ID", "more"]
    assert rows(linked) == [("2", "pb", None), ("3", "px", None), ("6", "p1", True), ("7", "p3", False)]
    stats = linkage.link_stats(matched).first().asDict()
    assert stats == {
        "n_pracMap_inA": 2, "n_pracMap_inB": 2,
        "n_inA_inB": 1, "n_inA_notB": 1, "n_notA_inB": 1, "n_notA_notB": 1,
    }


def test_nothing_to_remove(practices, spark):
    mapped, a, _ = practices
    b = spark.createDataFrame([("6", "p9", True)], "n string, PRACTICE_ID string, more boolean")
    assert linkage.link_practices(linkage.match_practices(mapped, a, b), a, b).count() == 5


def test_one_to_one(spark):
    cohort = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (None, "w")], "id int, v string")
    records = spark.createDataFrame([("1", "r", date(2001, 1, 2)), ("9", "q", None)], "key string, v string, d date")
    linked = linkage.link_one_to_one(cohort, records, "id", "key", dates_as_text=True)
    assert linked.columns == ["id", "v", "v_right", "d"]
    assert rows(linked) == [
        (1, "x", "r", "2001-01-02"), (2, "y", None, None), (None, "w", None, None), (None, "z", None, None)
    ]
    assert rows(linkage.link_one_to_one(cohort, records.select("key"), "id", "key")) == rows(cohort)
    with pytest.raises(Exception, match="records: key 1 occurs 2 times"):
        linkage.link_one_to_one(cohort, records.where("key = '1'").union(records), "id", "key").collect()
    with pytest.raises(Exception, match="cohort: key 1 occurs 2 times"):
        linkage.link_one_to_one(cohort.where("id = 1").union(cohort), records, "id", "key").collect()


def test_columns_go_by_the_header_of_their_file(spark, tmp_path):
    folder = tmp_path / "many files"
    folder.mkdir()
    (folder / "1.csv").write_text("x,y\n1,2\n3,\n")
    (folder / "2.csv").write_text('y,x\n20,10\n"4,0",30\n')
    (folder / "3.csv").write_text("")
    found = tables.read_csv(spark, str(folder))
    assert found.rows.columns == ["x", "y"] and found.malformed.count() == 0
    assert rows(found.rows) == rows(tables.scan_csv(spark, str(folder))) == [("1", "2"), ("10", "20"), ("3", None), ("30", "4,0")]
    assert rows(tables.scan_csv(spark, str(folder), ["y"])) == [("2",), ("20",), ("4,0",), (None,)]
    (folder / "4.csv").write_text("x,z\n1,2\n")
    with pytest.raises(ValueError, match="other files have"):
        tables.read_csv(spark, str(folder))


def test_malformed_rows_are_put_aside_or_fail(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text("x,y,z\n1,2,3\n4,5\n6,7,8,9\n10,11,12\n")
    found = tables.read_csv(spark, str(source))
    assert rows(found.rows) == [("1", "2", "3"), ("10", "11", "12")]
    assert [r.row for r in found.malformed.orderBy("row").collect()] == ["4,5", "6,7,8,9"]
    assert found.malformed.select("file").distinct().first()[0].endswith("in.csv")
    assert rows(found.rows.select("x")) == [("1",), ("10",)] and found.rows.count() == 2
    for columns in (None, ["x"]):
        with pytest.raises(Exception, match="malformed row in .*in.csv"):
            tables.scan_csv(spark, str(source), columns).collect()


def test_a_result_is_one_file_in_order(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 7 AS a", "concat('x, ', id) AS b", "if(id % 2 = 0, null, '') AS c").repartition(5)
    path = tmp_path / "out dir" / "result.csv"
    tables.write_csv(df, str(path), ["a", "b"])
    lines = path.read_text().splitlines()
    assert lines[0] == "a,b,c" and len(lines) == 1001 and path.is_file()
    assert lines[1:] == [f'{a},"{b}",' + ('""' if c == "" else "") for a, b, c in sorted((r.a, r.b, r.c) for r in df.collect())]
    assert [p.name for p in path.parent.iterdir() if not p.name.endswith(".crc")] == ["result.csv"]
    with pytest.raises(Exception, match="no such thing"):
        tables.write_csv(df.selectExpr("a", "string(raise_error('no such thing')) AS b"), str(path))
    assert path.read_text().splitlines() == lines  # the older file is left, and nothing beside it
    assert [p.name for p in path.parent.iterdir() if not p.name.endswith(".crc")] == ["result.csv"]
    tables.write_csv(df.limit(0), str(path))
    assert path.read_text() == "a,b,c\n"
    (tmp_path / "folder.csv").mkdir()
    with pytest.raises(FileExistsError):
        tables.write_csv(df, str(tmp_path / "folder.csv"))


def ran(df) -> str:
    """The plan that ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_tables_kept_by_key_are_linked_where_they_lie(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    people = spark.range(3000).select(
        F.when(F.col("id") % 10 != 0, F.col("id")).alias("person id"), (F.col("id") * 2).alias("v"), F.col("id").cast("string").alias("x`y")
    )
    records = spark.range(500, 9000).select((F.col("id") * 3).cast("string").alias("key"), F.col("id").alias("v"))
    kept = keyed.write_keyed(people, "person id", str(tmp_path / "people"), 5)
    found = keyed.write_keyed(records, "key", str(tmp_path / "it's records"), 5, kind=T.LongType())
    assert rows(kept.rows) == rows(people) and kept.keyless.count() == 300
    again = keyed.read_keyed(spark, str(tmp_path / "people"))
    assert (again.key, again.buckets) == ("person id", 5)
    for setting in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
        linked = linkage.link_kept(again, found)
        assert rows(linked.rows) == rows(linkage.link_one_to_one(people, records, "person id", "key"))
        # neither the count of keys, nor the join, nor one more link deals rows out
        assert "Exchange hashpartitioning" not in ran(linked.keyed)
        assert "Exchange hashpartitioning" not in ran(linkage.link_kept(linked, found).keyed)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" in ran(linkage.link_one_to_one(people, records, "person id", "key"))
    twice = keyed.write_keyed(records.union(records.limit(1)), "key", str(tmp_path / "twice"), 5, kind=T.LongType())
    with pytest.raises(Exception, match="records: key .* occurs 2 times"):
        linkage.link_kept(again, twice).keyed.collect()
    with pytest.raises(Exception, match="cohort: key .* occurs 2 times"):
        linkage.link_kept(twice, again).keyed.collect()
    with pytest.raises(ValueError, match="buckets"):
        linkage.link_kept(again, keyed.write_keyed(records, "key", str(tmp_path / "text"), 5))


def test_files_of_a_kept_table_are_one_per_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    keyed.write_keyed(spark.range(1000).repartition(7), "id", str(tmp_path / "kept"), 4)
    assert len(list((tmp_path / "kept" / "keyed").glob("part-*"))) == 4


def test_deprivation(spark):
    cohort = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, None)], "PATIENT_ID int, PRACTICE_ID string")
    by_practice = spark.createDataFrame([("p1", "4")], "pracid string, value string")
    assert rows(linkage.link_deprivation(cohort, by_practice)) == [(1, "p1", "4"), (2, "p2", None), (3, None, None)]
    by_person = spark.createDataFrame([("2", "4")], "patid string, value string")
    linked = linkage.link_deprivation(cohort, by_person)
    assert linked.columns[-1] == "IMD_patid"
    assert rows(linked) == [(1, "p1", None), (2, "p2", "4"), (3, None, None)]
    with pytest.raises(ValueError):
        linkage.link_deprivation(cohort, by_person.withColumnRenamed("patid", "x"))
    with pytest.raises(Exception, match="deprivation: key p1 occurs 2 times"):
        linkage.link_deprivation(cohort, by_practice.union(by_practice)).collect()
