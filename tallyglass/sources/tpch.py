"""The engine's entities over the star-schema tables, so that every operator can be checked with SQL.

Suppliers are tickers, ship dates are trading days, order lines are trades,
customers are owners. Money is summed as decimals, so sums do not depend on
the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyglass.functions.scalars import rnd


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money():
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return price, price * (F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ticker, d, close, adj, vol``: a row for each supplier and ship date."""
    price, net = _money()
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("ticker"), F.col("l_shipdate").cast("date").alias("d"))
        .agg(F.sum(price).cast("double").alias("p"), F.sum(net).cast("double").alias("a"), F.sum("l_quantity").alias("vol"))
        .select("ticker", "d", rnd(F.col("p") / F.col("vol")).alias("close"), rnd(F.col("a") / F.col("vol")).alias("adj"), "vol")
    )


def numbered(b: DataFrame) -> DataFrame:
    """Bars with ``i``, the place of a bar in its series, from 0."""
    return b.withColumn("i", F.row_number().over(Window.partitionBy("ticker").orderBy("d")) - 1)


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``d, adj``: the quantity-weighted price of all suppliers on a day."""
    _, net = _money()
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("d"))
        .agg(F.sum(net).cast("double").alias("a"), F.sum("l_quantity").alias("v"))
        .select("d", rnd(F.col("a") / F.col("v")).alias("adj"))
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trades: R are purchases, N are sales, A is neither and left out."""
    lines, orders, part = (table(spark, sf_dir, n) for n in ("lineitem", "orders", "part"))
    return (
        lines.where("l_returnflag in ('R', 'N')")
        .join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("acc"),
            F.col("l_linenumber").alias("line"),
            F.col("l_suppkey").alias("ticker"),
            F.col("o_custkey").alias("owner"),
            F.col("l_shipdate").cast("date").alias("fdate"),
            F.date_sub(F.col("l_shipdate").cast("date"), F.col("l_linenumber")).alias("tdate"),
            F.when(F.col("l_returnflag") == "R", "P").otherwise("S").alias("code"),
            F.when(F.col("l_linestatus") == "F", "4").otherwise("4/A").alias("form"),
            F.col("l_quantity").alias("sh"),
            F.col("l_extendedprice").alias("val"),
            rnd(F.col("l_extendedprice") / F.col("l_quantity")).alias("px"),
            F.col("p_type").alias("sec"),
        )
    )


#: The same entities as DuckDB common table expressions.
SQL_BARS = """
bars AS (
  SELECT ticker, d, floor(p / vol * 1e4 + 0.5) / 1e4 AS close, floor(a / vol * 1e4 + 0.5) / 1e4 AS adj, vol,
    row_number() OVER (PARTITION BY ticker ORDER BY d) - 1 AS i
  FROM (
    SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS d, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS p,
      CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2)))) AS DOUBLE) AS a, sum(l_quantity) AS vol
    FROM lineitem GROUP BY ALL))"""
SQL_BENCH = """
bench AS (
  SELECT d, floor(a / v * 1e4 + 0.5) / 1e4 AS adj FROM (
    SELECT CAST(l_shipdate AS DATE) AS d,
      CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2)))) AS DOUBLE) AS a, sum(l_quantity) AS v
    FROM lineitem GROUP BY ALL))"""
SQL_TRADES = """
trades AS (
  SELECT l_orderkey AS acc, l_linenumber AS line, l_suppkey AS ticker, o_custkey AS owner, CAST(l_shipdate AS DATE) AS fdate,
    CAST(l_shipdate AS DATE) - l_linenumber AS tdate, CASE WHEN l_returnflag = 'R' THEN 'P' ELSE 'S' END AS code,
    CASE WHEN l_linestatus = 'F' THEN '4' ELSE '4/A' END AS form, l_quantity AS sh, l_extendedprice AS val,
    floor(l_extendedprice / l_quantity * 1e4 + 0.5) / 1e4 AS px, p_type AS sec
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_returnflag IN ('R', 'N'))"""
