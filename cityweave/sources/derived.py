"""Crime, inspection and business tables derived from the benchmark tables.

The real tables are large public downloads; these derived ones have the same columns, include
malformed dates, NULLs, time 2400, (0, 0) points, many categories of falling frequency, a location shared by a seventh of
all crimes and a dense downtown, and grow with the benchmark tables. Each expression is kept
once, as text with slots for the few spots where the two SQL dialects differ.

They are plain projections: filters and column choices of a query reach the scan of the benchmark tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _skewed(label: str, key: str, modulus: int, kinds: int, power: int) -> str:
    """One of ``kinds`` values, the first the most frequent: a power of an evenly spread remainder."""
    share = "*".join([f"(({key})%{modulus})"] * power)
    return f"concat('{label}-', cast(({share}*{kinds}) {{div}} {modulus**power} as {{text}}))"


CRIME_COLUMNS = {
    "dr_no": "o_orderkey",
    "date_rptd": "case when o_orderkey%19=0 then 'unknown' else {stamp} end",
    "date_occ": "case when o_orderkey%43=0 then 'unknown' else {stamp} end",
    "crm_cd_1": "case when o_orderkey%41=0 then null else cast(o_custkey%50 as int) end",
    "time_occ": "cast(case when o_orderkey%101=0 then 2400 else ((o_orderkey*37)%24)*100 + o_orderkey%60 end as int)",
    "area_name": "n_name",
    "crm_cd_desc": _skewed("Crime", "o_orderkey*7919", 1009, 44, 3),
    "vict_age": "cast(o_custkey%100 as int)",
    "vict_sex": "case when o_orderkey%11=0 then null else o_orderstatus end",
    "vict_descent": "case when o_orderkey%13=0 then null else c_mktsegment end",
    "premis_desc": "case when o_orderkey%17=0 then null else o_orderstatus end",
    "lat": "case when o_orderkey%97=0 then null when o_orderkey%89=0 then 0e0 when o_orderkey%7=0 then 34.0407e0 "
    "when o_orderkey%5=0 then 34.0522 + ((o_orderkey*7919)%4001)/1e6 "
    "else 34.0522 + ((o_orderkey*7919)%100000 - 50000)/1e5*0.6 end",
    "lon": "case when o_orderkey%97=0 then null when o_orderkey%89=0 then 0e0 when o_orderkey%7=0 then -118.2468e0 "
    "when o_orderkey%5=0 then -118.2437 + ((o_orderkey*104729)%3989)/1e6 "
    "else -118.2437 + ((o_orderkey*104729)%100003 - 50000)/1e5*0.8 end",
}

INSPECTION_COLUMNS = {
    "permit": "l_orderkey*10 + l_linenumber",
    "permit_status": "case when l_orderkey%10<6 then 'Issued' when l_orderkey%10<9 then 'CofO Issued' else 'Permit Finaled' end",
    "inspection_type": _skewed("Type", "l_orderkey*7 + l_linenumber*13", 101, 12, 2),
    "inspection_result": _skewed("Result", "l_orderkey*31 + l_linenumber*17", 997, 24, 2),
    "inspection_date": "case when l_orderkey%31=0 then 'n/a' else {format}(l_shipdate,'{date}') end",
    "latitude_longitude": "case when l_orderkey%23=0 then null when l_orderkey%29=0 then '(34, -118)' "
    "when l_orderkey%10=1 then {printf}('(%.6f, %.6f)', 34.0522 + ((l_orderkey*6151 + l_linenumber*389)%4001)/1e6, "
    "-118.2437 + ((l_orderkey*3571 + l_linenumber*7717)%3989)/1e6) "
    "else {printf}('(%.6f, %.6f)', "
    "34.0522 + ((l_orderkey*6151 + l_linenumber*389 + l_partkey*53)%100000 - 50000)/1e5*0.6, "
    "-118.2437 + ((l_orderkey*3571 + l_linenumber*7717 + l_suppkey*101)%100003 - 50000)/1e5*0.8) end",
}

BUSINESS_COLUMNS = {
    "account_no": "p_partkey",
    "primary_naics_description": "case when p_partkey%7=0 then null else " + _skewed("Trade", "p_partkey*71", 199, 30, 2) + " end",
    "location_start_date": "{format}(cast(date '1995-01-01' + cast(p_partkey*4517%9000 as int) as timestamp),'{date}')",
}

SPARK_SLOTS = {
    "stamp": "date_format(timestampadd(MINUTE, cast(o_orderkey*61%1440 as int), o_orderdate), 'MM/dd/yyyy hh:mm:ss a')",
    "format": "date_format",
    "date": "MM/dd/yyyy",
    "printf": "format_string",
    "text": "string",
    "div": "div",
}

DUCKDB_SLOTS = {
    "stamp": "strftime(o_orderdate + to_minutes(cast(o_orderkey*61%1440 as int)), '%m/%d/%Y %I:%M:%S %p')",
    "format": "strftime",
    "date": "%m/%d/%Y",
    "printf": "printf",
    "text": "varchar",
    "div": "//",
}


def column_list(columns: dict[str, str], slots: dict[str, str]) -> list[str]:
    return [f"{expression.format(**slots)} as {name}" for name, expression in columns.items()]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def crime_raw(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer, nation = (_table(spark, folder, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    return joined.selectExpr(*column_list(CRIME_COLUMNS, SPARK_SLOTS))


def inspection_raw(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "lineitem").selectExpr(*column_list(INSPECTION_COLUMNS, SPARK_SLOTS))


def business_raw(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").selectExpr(*column_list(BUSINESS_COLUMNS, SPARK_SLOTS))


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three tables for ``folder``; nothing is read or written before a query needs it."""
    makers = {"crime": crime_raw, "inspection": inspection_raw, "business": business_raw}
    return {name: make(spark, folder) for name, make in makers.items()}


def duckdb_views() -> dict[str, str]:
    """The same three tables as DuckDB SELECT statements."""

    def select(columns: dict[str, str], source: str) -> str:
        return f"select {', '.join(column_list(columns, DUCKDB_SLOTS))} from {source}"

    return {
        "crime_raw": select(
            CRIME_COLUMNS, "orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey"
        ),
        "inspection_raw": select(INSPECTION_COLUMNS, "lineitem"),
        "business_raw": select(BUSINESS_COLUMNS, "part"),
    }
