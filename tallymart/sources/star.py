"""A wide retail fact over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.contract import MONEY
from tallymart.operators.quality import good_rows

PART_DIMS = {"category": "p_type", "sub_category": "p_brand"}
CUSTOMER_DIMS = {"customer_name": "c_name", "segment": "c_mktsegment"}
PLACE_DIMS = {"country": "n_name", "region": "r_name"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact(amount: Column) -> Column:
    """A double with at most four decimals as money.

    Counting ten-thousandths first avoids the double's text form, through which
    a direct cast to decimal goes for every row.
    """
    units = F.rint(amount * 10_000).cast("bigint").cast("decimal(18,0)")
    return (units * F.lit("0.0001").cast("decimal(4,4)")).cast(MONEY)


def _renamed(dims: dict[str, str], wanted: set[str]) -> list:
    return [F.col(source).alias(name) for name, source in dims.items() if name in wanted]


def _order_side(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    """Orders with the customer's attributes.

    Joined before the lines: orders are the smaller table, so the attributes
    travel to the lines instead of the lines to each dimension.
    """
    side = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )
    places = _renamed(PLACE_DIMS, wanted)
    attributes = _renamed(CUSTOMER_DIMS, wanted)
    if not places and not attributes:
        return side
    customers = table(spark, sf_dir, "customer")
    if places:
        nations = table(spark, sf_dir, "nation")
        if "region" in wanted:
            regions = table(spark, sf_dir, "region")
            nations = nations.join(regions, nations.n_regionkey == regions.r_regionkey, "left")
        customers = customers.join(
            nations, customers.c_nationkey == nations.n_nationkey, "left"
        )
    customers = customers.select("c_custkey", *attributes, *places)
    return side.join(customers, side.customer_id == customers.c_custkey, "left").drop("c_custkey")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_linenumber").alias("line_number"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_quantity").cast("int").alias("quantity_clean"),
        exact(discount).alias("discount_clean"),
        exact(price * (1 - discount)).alias("sales_clean"),
        exact(price * (0.05 - discount)).alias("profit_clean"),
    )


def retail_fact(spark: SparkSession, sf_dir: str, *dims: str) -> DataFrame:
    """One row per order line, with the named dimensions.

    Only the tables the named dimensions come from are joined.  No side carries
    a broadcast hint: customers and parts grow with the data, so the choice is
    left to the size statistics and to AQE, which also splits skewed keys.
    """
    wanted = set(dims)
    unknown = wanted - PART_DIMS.keys() - CUSTOMER_DIMS.keys() - PLACE_DIMS.keys()
    if unknown:
        raise ValueError(f"unknown dimensions {sorted(unknown)}")
    lines = _lines(spark, sf_dir)
    of_part = _renamed(PART_DIMS, wanted)
    if of_part:
        parts = table(spark, sf_dir, "part").select("p_partkey", *of_part)
        lines = lines.join(parts, lines.l_partkey == parts.p_partkey, "left").drop("p_partkey")
    orders = _order_side(spark, sf_dir, wanted)
    return (
        lines.join(orders, lines.l_orderkey == orders.order_id)
        .drop("l_orderkey", "l_partkey")
        .withColumns({"year": F.year("order_date"), "month": F.month("order_date")})
    )


def order_fact(spark: SparkSession, sf_dir: str, *dims: str) -> DataFrame:
    """One row per order with a good line: the fact summed to what customer marts need.

    Lines are summed per order before the join, in each task first, so an order
    that holds much of the lines never meets in one task.
    """
    wanted = set(dims)
    unknown = wanted - CUSTOMER_DIMS.keys() - PLACE_DIMS.keys()
    if unknown:
        raise ValueError(f"not dimensions of an order: {sorted(unknown)}")
    per_order = (
        _lines(spark, sf_dir)
        .where(F.col("sales_clean") > 0)
        .groupBy("l_orderkey")
        .agg(F.sum("sales_clean").alias("sales_clean"), F.sum("profit_clean").alias("profit_clean"))
    )
    orders = _order_side(spark, sf_dir, wanted).where(F.col("order_date").isNotNull())
    return per_order.join(orders, per_order.l_orderkey == orders.order_id).drop("l_orderkey")


def good_fact(spark: SparkSession, sf_dir: str, *dims: str) -> DataFrame:
    return good_rows(retail_fact(spark, sf_dir, *dims))
