"""Inputs derived from the given tables, as SQL that both engines run.

``FMT(x)`` stands for two decimals with thousands separators; the two engines spell it
differently. Gaps and dirty text are planted by key, since the given tables have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Dirty prices; o_orderkey is unique.
PRICES = """
select o_orderkey,
  case when o_orderkey % 11 = 0 then 'N/A'
       when o_orderkey % 7 = 0 then null
       when o_orderkey % 2 = 0 then concat(' $', FMT(o_totalprice))
       else concat('₹', FMT(o_totalprice)) end as actual_price,
  case when o_orderkey % 19 = 0 then ''
       else concat('$', FMT(floor(o_totalprice * cast(0.9 as double)) * cast(1 as double))) end
    as selling_price,
  case when o_orderkey % 23 = 0 then 'unrated'
       else concat(cast(1 + o_orderkey % 5 as varchar(20)), '.5 ') end as average_rating,
  o_orderpriority
from orders
"""

# Mixed columns with gaps; o_orderkey is unique.
MIXED = """
select o_orderkey,
  case when o_orderkey % 13 = 0 then null else concat('  ', o_orderstatus, ' ') end as status,
  case when o_orderkey % 17 = 0 then null else o_orderpriority end as priority,
  case when o_orderkey % 9 = 0 then 'n/a' else concat('$', FMT(o_totalprice)) end as amount_text,
  case when o_orderkey % 5 = 0 then cast(o_orderkey as varchar(20))
       else concat('Ref, ', cast(o_orderkey as varchar(20))) end as code_text,
  case when o_orderkey % 2 = 0 then cast(o_orderkey as varchar(20)) else 'odd' end as half_text,
  case when o_orderkey % 10 = 0 then null else o_totalprice end as balance,
  case when o_orderkey % 8 = 0 then 'unknown'
       else cast(cast(o_orderdate as date) as varchar(20)) end as order_date_text
from orders
"""

# Numbers with gaps and one constant column.
MEASURES = """
select case when l_partkey % 7 = 0 then null else l_quantity end as quantity,
  case when l_partkey % 5 = 0 then null else l_extendedprice end as extendedprice,
  l_discount as discount, l_tax as tax,
  cast(1 as double) as constant_col
from lineitem
"""

# Whole numbers that a double cannot tell apart, and some that no bigint holds.
LONG_IDS = """
select cast(1000000000000000000 + o_orderkey as varchar(20)) as long_id,
  cast(9000000000000000000 as varchar(20)) || cast(o_orderkey as varchar(20)) as huge_id,
  cast(o_orderkey as varchar(20)) as short_id
from orders
"""

# Values far away in rows where the other columns are missing, and one column far from zero.
FAR_VALUES = """
select case when l_linenumber = 1 and l_orderkey % 50 = 1 then 1e12 else l_quantity end as quantity,
  case when l_linenumber = 1 and l_orderkey % 50 = 1 then null else l_extendedprice end as extendedprice,
  case when l_linenumber = 1 and l_orderkey % 50 = 1 then null else 1000000 + l_quantity * l_discount end as lifted,
  l_tax as tax
from lineitem
"""

# Forty columns of numbers, some with gaps.
WIDE = "select " + ", ".join(
    f"case when l_orderkey % {13 + k} = 0 then null else cast((l_partkey * {k + 3} + l_suppkey) % {89 + k} as double) end as c{k}"
    for k in range(40)
) + " from lineitem"

# A real category named like the remainder row.
RESERVED = """
select p_partkey, case when p_brand = 'Brand#4' then 'Other' else p_brand end as p_brand
from part
"""

TABLES = {"PRICES": "orders", "MIXED": "orders", "MEASURES": "lineitem", "RESERVED": "part", "LONG_IDS": "orders",
          "FAR_VALUES": "lineitem", "WIDE": "lineitem"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the derived inputs as a DataFrame."""
    source = TABLES[name]
    sql = globals()[name].replace("FMT(o_totalprice)", "format_number(o_totalprice, 2)")
    sql = sql.replace(
        "FMT(floor(o_totalprice * cast(0.9 as double)) * cast(1 as double))",
        "format_number(floor(o_totalprice * cast(0.9 as double)) * cast(1 as double), 2)",
    )
    return spark.sql(
        sql.replace(f"from {source}", "from {source}"), source=table(spark, sf_dir, source)
    )


def duck(name: str) -> str:
    """The same input as DuckDB SQL."""
    return globals()[name].replace("FMT(", "format('{:,.2f}', ").strip()
