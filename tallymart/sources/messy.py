"""Raw-looking order text made from the fact, with known faults.

Headers, money, quantities, dates and categories are written the way real
files carry them.  About one row in a hundred is broken by a rule on its keys,
so that the result of cleaning can be stated from the clean columns alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.sources.star import retail_fact

# One line in FAULT_CYCLE has each of the first four faults.
FAULT_CYCLE = 388
FAULTS = ("blank_sales", "junk_sales", "bad_date", "zero_sales")


def fault_number() -> Column:
    return (F.col("order_id") + F.col("line_number")) % FAULT_CYCLE


def _pick(selector: Column, *choices: Column) -> Column:
    chosen = choices[-1]
    for k, choice in list(enumerate(choices))[-2::-1]:
        chosen = F.when(selector % len(choices) == k, choice).otherwise(chosen)
    return chosen


def us_date(date: Column) -> Column:
    """As ``M/d/yyyy``, without a formatter for every row."""
    slash = F.lit("/")
    return F.concat(F.month(date), slash, F.day(date), slash, F.year(date))


def grouped(amount: Column) -> Column:
    """As ``format_number(amount, 4)``; only amounts from a million on need that function."""
    text = amount.cast("string")
    thousands = F.concat(
        text.substr(F.lit(1), F.length(text) - 8), F.lit(","), text.substr(F.length(text) - 7, F.lit(8))
    )
    size = F.abs(amount)
    return F.when(size < 1000, text).when(size < 1_000_000, thousands).otherwise(F.format_number(amount, 4))


def messy_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = retail_fact(spark, sf_dir, "category", "country")
    line, fault = F.col("line_number"), fault_number()
    amount = grouped(F.col("sales_clean"))
    money = _pick(
        line,
        F.concat(F.lit(" $"), amount, F.lit(" ")),
        F.concat(F.lit("₹"), amount),
        F.concat(F.lit("€ "), amount),
        F.concat(amount, F.lit(" £")),
    )
    sales = (
        F.when(fault == 0, F.lit("  "))
        .when(fault == 1, F.lit("n/a"))
        .when(fault == 3, F.lit("$0.00"))
        .otherwise(money)
    )
    iso_date = F.col("order_date").cast("string")
    order_date = F.when(fault == 2, F.lit("not a date")).otherwise(_pick(line, us_date(F.col("order_date")), iso_date))
    whole = F.col("quantity_clean").cast("string")
    quantity = _pick(line, whole, F.concat(F.lit(" "), whole, F.lit(" ")), F.concat(whole, F.lit(".0")))
    category = _pick(
        line,
        F.col("category"),
        F.concat(F.lit("  "), F.col("category")),
        F.concat(F.initcap("category"), F.lit(" ")),
    )
    return fact.select(
        F.col("order_id").cast("string").alias(" Order ID"),
        line.cast("string").alias("Line.Number"),
        order_date.alias("Order Date"),
        us_date(F.col("ship_date")).alias("Ship-Date"),
        sales.alias("Sales"),
        F.concat(F.lit("$"), grouped(F.col("profit_clean"))).alias("Profit"),
        F.col("discount_clean").cast("string").alias("Discount "),
        quantity.alias("[Quantity]"),
        category.alias("Category"),
        F.col("country").alias("Country/Market"),
        F.year("order_date").cast("string").alias("Year"),
    )
