"""Stand-in relations derived from the synthetic test tables.

The source job reads nine relations of an HR system that are not available
here. FIXTURES.md part B maps each onto the TPC-H-like test tables; this
module is that mapping, once as DataFrames (what the job runs on) and once
as SQL (what the DuckDB oracle runs on). All derivations are scans,
projections and equi-joins, so their work grows with the tables.

Every part is a position, every supplier a firm, every line a staff row and a
pay row, so all keys grow with the tables. The stand-ins deliberately contain
NULL names (one city, one firm) and a second territory per firm, so the
NULL-safe merges and the fan-outs of the job are exercised; ties (pay periods
are months) and rows without a partner come from the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
RELATIONS = (
    "cities",
    "territories",
    "firms",
    "firm_territories",
    "positions",
    "salary_register",
    "approvals",
    "approval_lines",
    "actual_staff",
)

# Fixed values of the stand-in mapping (FIXTURES.md part B).
NULL_CITY_NAME = "NATION_15"
NULL_FIRM_NAME = "Supplier#000000003"
POOLED_POSITION = "red widget"
OPEN_STATUS = "O"


def base_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    sf_dir = sf_dir.rstrip("/")
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in BASE_TABLES}


def position_name() -> Column:
    """Every part is a position with a name of its own, except the parts of
    one common name, which share it (so several keys have one name)."""
    return F.when(F.col("p_name") == POOLED_POSITION, F.col("p_name")).otherwise(
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string"))
    )


def standin_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine relations of the job, as lazy DataFrames over ``sf_dir``."""
    t = base_tables(spark, sf_dir)
    nation, region, supplier, part = t["nation"], t["region"], t["supplier"], t["part"]
    orders, lineitem, customer = t["orders"], t["lineitem"], t["customer"]

    cities = nation.select(
        F.col("n_nationkey").alias("city_ref"),
        F.nullif(F.col("n_name"), F.lit(NULL_CITY_NAME)).alias("city"),
        F.col("n_nationkey").alias("city_code"),
    )
    territories = region.select(
        F.col("r_regionkey").alias("territory_ref"),
        F.col("r_name").alias("territory"),
    )
    firms = supplier.select(
        F.col("s_suppkey").alias("firm_ref"),
        F.col("s_suppkey").alias("firm_code"),
        F.nullif(F.col("s_name"), F.lit(NULL_FIRM_NAME)).alias("firm"),
        F.col("s_nationkey").alias("city_ref"),
    )
    sn = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    firm_territories = sn.select(
        F.col("s_suppkey").alias("firm_ref"),
        F.lit(3).cast(T.IntegerType()).alias("depth"),
        ((F.col("n_regionkey") + F.col("s_suppkey") % 2) % 5).cast(T.IntegerType()).alias("territory_ref"),
    ).unionByName(
        sn.select(
            F.col("s_suppkey").alias("firm_ref"),
            F.lit(2).cast(T.IntegerType()).alias("depth"),
            ((F.col("n_regionkey") + 1) % 5).cast(T.IntegerType()).alias("territory_ref"),
        )
    )
    positions = part.select(
        F.col("p_partkey").alias("position_ref"),
        position_name().alias("position"),
        F.col("p_size").alias("leader_level"),
        F.col("p_type").alias("prefix"),
    )
    salary_register = (
        lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .select(
            F.col("c_nationkey").alias("city_ref"),
            F.col("l_partkey").alias("position_ref"),
            F.col("l_linenumber").alias("level"),
            F.col("l_extendedprice").alias("salary"),
            # Months, so that pay rows of one group tie on the latest period.
            F.date_trunc("month", F.col("o_orderdate")).cast(orders.schema["o_orderdate"].dataType).alias("period"),
        )
    )
    # The firm of a document is the first supplier of its lines.
    issuers = lineitem.groupBy(F.col("l_orderkey").alias("i_orderkey")).agg(F.min("l_suppkey").alias("firm_ref"))
    approvals = orders.join(issuers, F.col("o_orderkey") == F.col("i_orderkey"), "left").select(
        F.col("o_orderkey").alias("doc_ref"),
        "firm_ref",
        F.col("o_orderdate").alias("doc_ts"),
    )
    approval_lines = lineitem.select(
        F.col("l_orderkey").alias("doc_ref"),
        F.col("l_partkey").alias("position_ref"),
        F.col("l_quantity").alias("rate"),
    )
    li = lineitem.select(
        "l_suppkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    f = firms.select("firm_ref", "firm", F.col("city_ref").alias("f_city_ref"))
    c = cities.select(F.col("city_ref").alias("c_city_ref"), F.col("city").alias("firm_city"))
    p = positions.select(F.col("position_ref").alias("p_ref"), "position")
    actual_staff = (
        li.join(f, F.col("l_suppkey") == F.col("firm_ref"))
        .join(c, F.col("f_city_ref") == F.col("c_city_ref"))
        .join(p, F.col("l_partkey") == F.col("p_ref"))
        .select(
            F.col("position"),
            F.col("l_linenumber").alias("pay_level"),
            F.col("l_returnflag").alias("current_branch"),
            F.year("l_shipdate").alias("refreshed"),
            F.when(F.col("l_linestatus") == OPEN_STATUS, F.lit(None).cast(T.StringType()))
            .otherwise(F.col("firm_city"))
            .alias("city"),
            F.col("firm").alias("branch"),
            F.col("l_linestatus").alias("rrs"),
        )
    )
    return {
        "cities": cities,
        "territories": territories,
        "firms": firms,
        "firm_territories": firm_territories,
        "positions": positions,
        "salary_register": salary_register,
        "approvals": approvals,
        "approval_lines": approval_lines,
        "actual_staff": actual_staff,
    }


# The same relations in SQL over the base tables, for the DuckDB oracle.
POSITION_NAME_SQL = f"CASE WHEN p_name = '{POOLED_POSITION}' THEN p_name ELSE p_name || ' #' || p_partkey END"
STANDIN_SQL = {
    "cities": f"""
        SELECT n_nationkey AS city_ref, nullif(n_name, '{NULL_CITY_NAME}') AS city,
               n_nationkey AS city_code
        FROM nation""",
    "territories": """
        SELECT r_regionkey AS territory_ref, r_name AS territory FROM region""",
    "firms": f"""
        SELECT s_suppkey AS firm_ref, s_suppkey AS firm_code,
               nullif(s_name, '{NULL_FIRM_NAME}') AS firm, s_nationkey AS city_ref
        FROM supplier""",
    "firm_territories": """
        SELECT s_suppkey AS firm_ref, CAST(3 AS INTEGER) AS depth,
               CAST((n_regionkey + s_suppkey % 2) % 5 AS INTEGER) AS territory_ref
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        UNION ALL
        SELECT s_suppkey, CAST(2 AS INTEGER), CAST((n_regionkey + 1) % 5 AS INTEGER)
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "positions": f"""
        SELECT p_partkey AS position_ref, {POSITION_NAME_SQL} AS position, p_size AS leader_level,
               p_type AS prefix
        FROM part""",
    "salary_register": """
        SELECT c_nationkey AS city_ref, l_partkey AS position_ref, l_linenumber AS level,
               l_extendedprice AS salary, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS period
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey""",
    "approvals": """
        SELECT o_orderkey AS doc_ref,
               (SELECT min(l_suppkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS firm_ref,
               o_orderdate AS doc_ts
        FROM orders""",
    "approval_lines": """
        SELECT l_orderkey AS doc_ref, l_partkey AS position_ref, l_quantity AS rate
        FROM lineitem""",
    "actual_staff": f"""
        SELECT {POSITION_NAME_SQL} AS position, l.l_linenumber AS pay_level,
               l.l_returnflag AS current_branch, CAST(year(l.l_shipdate) AS INTEGER) AS refreshed,
               CASE WHEN l.l_linestatus = '{OPEN_STATUS}' THEN NULL
                    ELSE nullif(n.n_name, '{NULL_CITY_NAME}') END AS city,
               nullif(s.s_name, '{NULL_FIRM_NAME}') AS branch, l.l_linestatus AS rrs
        FROM lineitem l
        JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN part p ON l.l_partkey = p.p_partkey""",
}


def standin_ctes() -> str:
    """``name AS (...)`` for every stand-in, to put after ``WITH``."""
    return ",\n".join(f"{name} AS ({sql}\n)" for name, sql in STANDIN_SQL.items())
