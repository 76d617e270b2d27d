"""Cohort-shaped inputs derived from the driver's tables, for Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AGE_BANDS = ("0-16", "17-30", "31-40", "41-50", "51-60", "61-70", "71-80", "81+")


#: Columns of the driver's tables; given to the reader so that it need not open files to plan.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _practice(key: str) -> Column:
    return F.concat(F.lit("p"), F.col(key).cast("string"))


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with orders. Orders are reduced to one row per customer before the
    join, so a customer with many orders does not become a hot join key."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    large = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000)
    spells = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("INDEX_DATE"),
        F.max("o_orderdate").cast("date").alias("END_DATE"),
        F.min(F.when(urgent, F.col("o_orderdate"))).cast("date").alias("condition_a"),
        F.min(F.when(large, F.col("o_orderdate"))).cast("date").alias("condition_b"),
    )
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("c_custkey")
    band = F.get(F.array(*[F.lit(a) for a in AGE_BANDS]), ((key % 11) % 8).cast("int"))
    return (
        table(spark, sf_dir, "customer")
        .join(spells, key == F.col("o_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("PATIENT_ID"),
            _practice("c_nationkey").alias("PRACTICE_ID"),
            F.concat(_practice("c_nationkey"), F.lit("_"), key.cast("string")).alias("PRACTICE_PATIENT_ID"),
            "INDEX_DATE",
            "END_DATE",
            "condition_a",
            "condition_b",
            F.when(key % 50 == 0, "I").when(key % 2 == 0, "F").otherwise("M").alias("SEX"),
            band.alias("AGE_CATEGORY"),
            F.when(key % 37 != 0, F.col("c_mktsegment")).alias("pat_catg_a"),
            F.col("r_name").alias("pat_catg_b"),
            F.col("c_acctbal").alias("balance"),
            F.when(F.datediff("END_DATE", "INDEX_DATE") < 365, "under 1 year")
            .when(F.datediff("END_DATE", "INDEX_DATE") < 1460, "1 to 3 years")
            .otherwise("4 years or more")
            .alias("FOLLOW_UP"),
            F.when(key % 41 != 0, F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") < 5000, "low").otherwise("high")).alias("BALANCE_BAND"),
        )
    )


def reference_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        ((F.col("p_size") - 1) * 2).alias("Age"),
        F.when(F.col("p_partkey") % 2 == 0, "Female").otherwise("Male").alias("Sex"),
        (1000 + F.col("p_partkey") % 100).alias("Count"),
    )


def practice_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").where("n_regionkey <> 2").select(
        _practice("n_nationkey").alias("id_a"), F.concat(F.lit("p"), ((F.col("n_nationkey") + 7) % 25).cast("string")).alias("id_b")
    )


def hospital(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("items"), F.min("l_shipdate").alias("first_ship")
    )
    return (
        table(spark, sf_dir, "orders")
        .join(items, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("patid"))
        .agg(F.sum("items").alias("n_items"), F.min("first_ship").cast("date").alias("first_item"))
    )


def deprivation(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").where(nation % 7 != 0).select(
        _practice("n_nationkey").alias("pracid"),
        F.concat((nation % 10 + 1).cast("string"), F.when(nation % 3 == 0, "*").otherwise("")).alias("imd"),
    )


V_COHORT = """
select c_custkey as PATIENT_ID,
       concat('p', cast(c_nationkey as varchar(9))) as PRACTICE_ID,
       concat('p', cast(c_nationkey as varchar(9)), '_', cast(c_custkey as varchar(19))) as PRACTICE_PATIENT_ID,
       cast(min(o_orderdate) as date) as INDEX_DATE,
       cast(max(o_orderdate) as date) as END_DATE,
       cast(min(case when o_orderpriority = '1-URGENT' then o_orderdate end) as date) as condition_a,
       cast(min(case when o_orderstatus = 'F' and o_totalprice > 300000 then o_orderdate end) as date) as condition_b,
       case when c_custkey % 50 = 0 then 'I' when c_custkey % 2 = 0 then 'F' else 'M' end as SEX,
       case (c_custkey % 11) % 8 when 0 then '0-16' when 1 then '17-30' when 2 then '31-40' when 3 then '41-50'
            when 4 then '51-60' when 5 then '61-70' when 6 then '71-80' else '81+' end as AGE_CATEGORY,
       case when c_custkey % 37 = 0 then null else c_mktsegment end as pat_catg_a,
       r_name as pat_catg_b,
       c_acctbal as balance,
       case when cast(max(o_orderdate) as date) - cast(min(o_orderdate) as date) < 365 then 'under 1 year'
            when cast(max(o_orderdate) as date) - cast(min(o_orderdate) as date) < 1460 then '1 to 3 years' else '4 years or more' end as FOLLOW_UP,
       case when c_custkey % 41 = 0 then null when c_acctbal < 0 then 'debt' when c_acctbal < 5000 then 'low' else 'high' end as BALANCE_BAND
from customer join orders on o_custkey = c_custkey
     join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
group by c_custkey, c_nationkey, c_mktsegment, r_name, c_acctbal
"""

V_REFPOP = """
select cast((p_size - 1) * 2 as int) as Age,
       case when p_partkey % 2 = 0 then 'Female' else 'Male' end as Sex,
       1000 + p_partkey % 100 as Count
from part
"""

V_PRACTICE_MAP = """
select concat('p', cast(n_nationkey as varchar(9))) as id_a,
       concat('p', cast((n_nationkey + 7) % 25 as varchar(9))) as id_b
from nation where n_regionkey <> 2
"""

V_HOSPITAL = """
select o_custkey as patid, count(*) as n_items, cast(min(l_shipdate) as date) as first_item
from orders join lineitem on l_orderkey = o_orderkey
group by o_custkey
"""

V_DEPRIVATION = """
select concat('p', cast(n_nationkey as varchar(9))) as pracid,
       concat(cast(n_nationkey % 10 + 1 as varchar(9)), case when n_nationkey % 3 = 0 then '*' else '' end) as imd
from nation where n_nationkey % 7 <> 0
"""
