"""Customer marts: lifetime value, churn and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.measures import ratio


def lifetime_value(
    df: DataFrame,
    customer: str = "customer_id",
    amount: str = "sales_clean",
    order_grain: bool = False,
) -> DataFrame:
    """Revenue, orders, tenure in days and average order value per customer.

    ``order_grain`` says that ``df`` has one row per order, which saves the
    distinct count's extra aggregate.
    """
    revenue = F.sum(amount)
    orders = F.count("order_id") if order_grain else F.count_distinct("order_id")
    first, last = F.min("order_date"), F.max("order_date")
    return df.groupBy(customer).agg(
        revenue.alias("revenue"),
        orders.alias("orders"),
        first.alias("first_order"),
        last.alias("last_order"),
        F.datediff(last, first).alias("tenure_days"),
        ratio(revenue, orders).alias("avg_order_value"),
    )


def last_orders(df: DataFrame, customer: str = "customer_id") -> DataFrame:
    return df.groupBy(customer).agg(F.max("order_date").alias("last_order"))


def churn(last: DataFrame, inactive_days: int = 180, as_of: str | None = None) -> DataFrame:
    """Days since each last order; churned above ``inactive_days``.

    ``last`` is a ``last_orders`` table.  The cut-off is ``as_of``; without it
    the table is read once more for its last date, so pass a stored one.
    """
    cut = F.to_date(F.lit(as_of)) if as_of else last.select(F.max("last_order")).scalar()
    recency = F.datediff(cut, F.col("last_order"))
    return last.withColumns({"recency_days": recency, "churned": recency > inactive_days})


def retention(df: DataFrame, customer: str = "customer_id") -> DataFrame:
    """Per month: active customers and how many of them bought the month after."""
    month = F.trunc("order_date", "month").alias("date")
    active = df.select(customer, month).distinct()
    following = F.lead("date").over(Window.partitionBy(customer).orderBy("date"))
    stays = following == F.add_months("date", 1)
    flagged = active.select("date", stays.alias("_stays"))
    rows, kept = F.count(F.lit(1)), F.count_if("_stays")
    return flagged.groupBy("date").agg(
        rows.alias("active"), kept.alias("retained"), ratio(kept, rows).alias("retention")
    )
