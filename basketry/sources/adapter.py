"""The retail tables derived from order-processing tables.

Orders play the part of sales: suppliers are stores, parts are items, order lines
are sales. A tenth of the suppliers and a hundredth of the parts have no store or
item row, so that their sales are orphans; this is part of the definition of the
derived tables (see FIXTURES.md), not a sample of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.tables import RetailTables

#: First day without known sales: order lines from here on form ``test``.
CUTOFF = "2001-08-16"
YEARS = tuple(range(1995, 2002))
_CUTOFF_TS = f"TIMESTAMP_NTZ '{CUTOFF} 00:00:00'"

_SALE_KEYS = (
    "l_orderkey * 8 + l_linenumber AS id",
    "CAST(l_shipdate AS DATE) AS date",
    "CAST(l_suppkey AS INT) AS store_nbr",
    "CAST(l_partkey AS INT) AS item_nbr",
)


def adapt(spark: SparkSession, folder: str) -> RetailTables:
    def source(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    lines = source("lineitem")
    sold = lines.where(f"l_shipdate < {_CUTOFF_TS}")
    places = source("nation").join(source("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return RetailTables(
        stores=_stores(source("supplier"), places),
        items=_items(source("part")),
        transactions=_transactions(sold),
        oil=_oil(source("orders")),
        holidays_events=_holidays(source("orders"), source("customer"), places),
        train=_train(sold),
        test=_test(lines.where(f"l_shipdate >= {_CUTOFF_TS}")),
    )


def _train(sold: DataFrame) -> DataFrame:
    return sold.selectExpr(
        *_SALE_KEYS,
        """CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_quantity
                     WHEN l_linenumber = 2 THEN l_quantity / 8
                     ELSE l_quantity END AS DECIMAL(12, 5)) AS unit_sales""",
        """CASE WHEN l_shipdate < TIMESTAMP_NTZ '1996-04-01 00:00:00' THEN NULL
                ELSE l_discount >= 0.07 END AS onpromotion""",
    )


def _test(lines: DataFrame) -> DataFrame:
    return lines.selectExpr(*_SALE_KEYS, "l_discount >= 0.07 AS onpromotion")


def _stores(suppliers: DataFrame, places: DataFrame) -> DataFrame:
    located = suppliers.join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    return located.where("s_suppkey % 10 <> 9").selectExpr(
        "CAST(s_suppkey AS INT) AS store_nbr",
        "n_name AS city",
        "r_name AS state",
        "substr('ABCDE', CAST(s_suppkey % 5 AS INT) + 1, 1) AS type",
        "CAST(s_suppkey % 17 + 1 AS INT) AS cluster",
    )


def _items(parts: DataFrame) -> DataFrame:
    return parts.where("p_partkey % 100 <> 99").selectExpr(
        "CAST(p_partkey AS INT) AS item_nbr",
        "p_brand AS family",
        "p_size AS class",
        "CAST(CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END AS SMALLINT) AS perishable",
    )


def _transactions(sold: DataFrame) -> DataFrame:
    visits = sold.selectExpr("l_orderkey", *_SALE_KEYS[1:3])
    return visits.groupBy("date", "store_nbr").agg(
        F.count_distinct("l_orderkey").cast("int").alias("transactions")
    )


def _oil(orders: DataFrame) -> DataFrame:
    traded = orders.selectExpr("CAST(o_orderdate AS DATE) AS date", "o_totalprice")
    lowest = (
        traded.where("weekday(date) < 5").groupBy("date").agg(F.min("o_totalprice").alias("low"))
    )
    return lowest.selectExpr(
        "date",
        """CASE WHEN dayofmonth(date) % 13 = 0 OR date <= DATE '1995-01-06' THEN NULL
                ELSE CAST(FLOOR(low / 10) / 100 AS DECIMAL(10, 2)) END AS dcoilwtico""",
    )


def _holidays(orders: DataFrame, customers: DataFrame, places: DataFrame) -> DataFrame:
    marked = orders.where("dayofmonth(CAST(o_orderdate AS DATE)) <= 8")
    placed = marked.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return placed.selectExpr(
        "CAST(o_orderdate AS DATE) AS date",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'Holiday' WHEN '2-HIGH' THEN 'Event'
                WHEN '3-MEDIUM' THEN 'Additional' WHEN '5-LOW' THEN 'Work Day'
                ELSE 'Transfer' END AS type""",
        """CASE c_mktsegment WHEN 'BUILDING' THEN 'National' WHEN 'AUTOMOBILE' THEN 'Regional'
                ELSE 'Local' END AS locale""",
        """CASE c_mktsegment WHEN 'BUILDING' THEN 'Country' WHEN 'AUTOMOBILE' THEN r_name
                ELSE n_name END AS locale_name""",
        "concat('Event ', CAST(o_orderkey % 7 AS STRING)) AS description",
        "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus = 'P' END AS transferred",
    )
