"""Posting-shaped frames derived from the star-schema test tables.

Orders stand for job postings: a line item is a posting, its part the role and skill, its customer
the place, its supplier the company. Nulls, unparsable salaries and companies without a record are
spread over the keys so that every default and fallback occurs.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.universe import Allowlist
from ..settings import RunSettings

ROLES = Allowlist(
    "role",
    (("Economy", "economy role"), ("Large", "large role"), ("Promo", "promo role")),
)
SKILLS = Allowlist("skill", (("brand#12", "Brand#12"), ("brand#7", "Brand#7")))
NO_ROLES = Allowlist("role")
NO_SKILLS = Allowlist("skill")

SETTINGS = RunSettings(
    run_id="run_standin",
    run_timestamp=datetime(2026, 4, 1),
    extract_start=date(1995, 1, 1),
    extract_end=date(2001, 12, 31),
)


# Stated types save a footer read per table and query. Only the columns used here.
TABLES = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz",
    "part": "p_partkey long, p_brand string, p_type string",
    "orders": "o_orderkey long, o_custkey long",
    "customer": "c_custkey long, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


# Source column by expression over the joined tables; the keys decide where values are missing.
POSTING_COLUMNS = {
    "job_id": "l_orderkey * 8 + l_linenumber",
    "rcid": "if(l_partkey % 50 = 0, null, l_suppkey)",
    "country": "if(l_orderkey % 2 = 0, null, concat('Country ', r_regionkey))",
    "state": "if(l_orderkey % 3 = 0, null, r_name)",
    "metro_area": "if(l_orderkey % 5 = 0, null, c_mktsegment)",
    "role_k1500_v2": "if(l_orderkey % 101 = 0, null, concat(lower(p_type), ' role'))",
    "role_k17000_v3": "if(l_orderkey % 101 = 0, null,"
    " concat(upper(left(p_type, 1)), lower(substring(p_type, 2))))",
    "salary": "case l_partkey % 40 when 1 then 'n/a' when 2 then '0' when 3 then '-5'"
    " when 4 then null else cast(cast(l_extendedprice as decimal(12, 2)) as string) end",
    "post_date": "if(l_orderkey % 97 = 0, null, cast(l_shipdate as date))",
    "remove_date": "if(l_orderkey % 97 = 0, null,"
    " date_add(cast(l_shipdate as date), cast(l_quantity as int)))",
    "skill_id": "if(l_linenumber = 7, null, lower(p_brand))",
    "skill_name": "if(l_linenumber = 7, null, p_brand)",
}


def postings(spark: SparkSession, folder: str) -> DataFrame:
    lineitem, part, orders, customer, nation, region = (
        table(spark, folder, name)
        for name in ("lineitem", "part", "orders", "customer", "nation", "region")
    )
    # Places are joined to orders first, which are fewer than line items.
    places = (
        orders.join(customer, F.expr("o_custkey = c_custkey"))
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .join(region, F.expr("n_regionkey = r_regionkey"))
        .select("o_orderkey", "c_mktsegment", "r_regionkey", "r_name")
    )
    rows = lineitem.join(part, F.expr("l_partkey = p_partkey")).join(
        places, F.expr("l_orderkey = o_orderkey")
    )
    return rows.selectExpr(*[f"{value} as {name}" for name, value in POSTING_COLUMNS.items()])


def company_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier keys ending in zero have no record, so unmatched postings occur."""
    supplier, nation, region = (
        table(spark, folder, name) for name in ("supplier", "nation", "region")
    )
    located = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return located.where(F.col("s_suppkey") % 10 != 0).select(
        F.col("s_suppkey").alias("rcid"),
        F.col("s_name").alias("company"),
        F.col("r_name").alias("rics_k200"),
        F.concat(F.lit("Group "), "r_regionkey").alias("rics_k50"),
    )


def regions(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "region")
        .select(
            F.concat(F.lit("Country "), "r_regionkey").alias("country"),
            F.col("r_name").alias("region"),
        )
        .distinct()
    )
