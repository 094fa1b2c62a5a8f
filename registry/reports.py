"""Profit and loss reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from registry.base import BASIC, Registry, sql_with
from tallywright.operators import filters, reports
from tallywright.sources import bindings

REGISTRY = Registry()

_SUMS = "COUNT(*) AS n, SUM(sales) AS rev, SUM(profit) AS net"
_SHOWN = "n AS order_count, CAST(rev AS DOUBLE) AS revenue, CAST(net AS DOUBLE) AS net_profit"
_MARGIN = "round_even(CAST(net AS DOUBLE) / CAST(rev AS DOUBLE) * 100, 2) AS margin_pct"
_MONTHS = f"""SELECT strftime(order_date, '%Y-%m') AS month, {_SUMS} FROM so
              WHERE order_status NOT IN {BASIC} AND order_date IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 6"""


@REGISTRY.query(sql_with("so", body=f"SELECT month, {_SHOWN}, {_MARGIN} FROM ({_MONTHS})"))
def pnl_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return reports.monthly_pnl(bindings.sales_orders(spark, folder, customer=False))


@REGISTRY.query(
    sql_with("so", body=f"""
        SELECT COALESCE(month, 'TOTAL') AS month, {_SHOWN}, {_MARGIN}
        FROM (SELECT month, CAST(SUM(n) AS BIGINT) AS n, SUM(rev) AS rev, SUM(net) AS net FROM ({_MONTHS}) GROUP BY ROLLUP (month))""")
)
def pnl_total(spark: SparkSession, folder: str) -> DataFrame:
    return reports.pnl_total(bindings.sales_orders(spark, folder, customer=False))


@REGISTRY.query(
    sql_with("so", body=f"""
        SELECT region, {_SHOWN}, {_MARGIN}
        FROM (SELECT customer_country AS region, {_SUMS} FROM so
              WHERE order_status NOT IN {BASIC} AND customer_country IS NOT NULL AND customer_country <> ''
              GROUP BY 1 ORDER BY net DESC, region LIMIT 10)""")
)
def profit_by_region(spark: SparkSession, folder: str) -> DataFrame:
    return reports.regional_profit(bindings.sales_orders(spark, folder))


@REGISTRY.query(
    sql_with("so", body=f"""
        SELECT order_status, {_SHOWN}
        FROM (SELECT order_status, {_SUMS} FROM so
              WHERE order_status NOT IN {BASIC} AND year(order_date) = 1998 AND month(order_date) = 3 GROUP BY 1)""")
)
def period_close(spark: SparkSession, folder: str) -> DataFrame:
    return reports.period_close(bindings.sales_orders(spark, folder, customer=False), 1998, 3)


@REGISTRY.query(
    sql_with("so", body="""
        SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, CAST(sales AS DOUBLE) AS sales, order_status FROM so
        WHERE order_date BETWEEN DATE '1999-12-15' AND DATE '2000-01-15'""")
)
def date_range(spark: SparkSession, folder: str) -> DataFrame:
    orders = bindings.sales_orders(spark, folder, customer=False, profit=False)
    return filters.date_range(orders, "1999-12-15", "2000-01-15").select("order_id", "order_date", "sales", "order_status")


@REGISTRY.query(
    sql_with("so", body="""
        SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, CAST(sales AS DOUBLE) AS sales, order_status
        FROM so ORDER BY so.order_date DESC, order_id LIMIT 10""")
)
def newest_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = bindings.sales_orders(spark, folder, customer=False, profit=False)
    return reports.newest_orders(orders.select("order_id", "order_date", "sales", "order_status"))
