"""The order contract: which columns a bronze file must and may carry."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)

# Accepted header names per contract column, first match wins.
ORDER_CANDIDATES: dict[str, tuple[str, ...]] = {
    "order_date": ("order_date", "orderdate", "order_date_"),
    "sales": ("sales", "revenue", "amount"),
    "profit": ("profit",),
    "discount": ("discount",),
    "quantity": ("quantity", "qty"),
    "category": ("category",),
}

# Fixed value: largest share of rejected rows a run may have.
MAX_BAD_FRACTION = 0.05


@dataclass(frozen=True)
class OrderContract:
    """Roles of the bronze columns.

    Dates are read in an ISO form and in ``date_formats``, in that order if
    ``iso_first``.  A row dated outside ``date_range`` (both ends included) is a
    reject and goes to quarantine.

    ``date_columns`` beyond ``order_date``, ``dimensions`` and the optional
    measures are used where the file has them.
    """

    candidates: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: dict(ORDER_CANDIDATES)
    )
    required: tuple[str, ...] = ("order_date", "sales")
    money: tuple[str, ...] = ("sales", "profit", "discount")
    quantities: tuple[str, ...] = ("quantity",)
    date_columns: tuple[str, ...] = ("order_date", "ship_date")
    dimensions: tuple[str, ...] = ("category",)
    date_formats: tuple[str, ...] = ("M/d/yyyy",)
    iso_first: bool = True
    date_range: tuple[date, date] | None = None


# Column names of the wide order file after normalisation.
ORDER_FILE_COLUMNS = (
    "category", "city", "country", "customer_id", "customer_name", "discount",
    "market", "记录数", "order_date", "order_id", "order_priority", "product_id",
    "product_name", "profit", "quantity", "region", "row_id", "sales", "segment",
    "ship_date", "ship_mode", "shipping_cost", "state", "sub_category", "year",
    "market2", "weeknum",
)

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("row_in", T.LongType(), False),
        T.StructField("row_good", T.LongType(), False),
        T.StructField("row_bad", T.LongType(), False),
        T.StructField("bad_fraction", T.DoubleType(), False),
    ]
)

AUDIT_SCHEMA = T.StructType(
    METRICS_SCHEMA.fields
    + [
        T.StructField("job_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("finished_at", T.TimestampType(), False),
        T.StructField("row_duplicate", T.LongType(), True),
    ]
)


def gold_schema(dims: tuple[str, ...] = ()) -> T.StructType:
    """Schema of a gold table: period, dimensions, summed sales."""
    return T.StructType(
        [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]
        + [T.StructField(d, T.StringType()) for d in dims]
        + [T.StructField("total_sales", T.DecimalType(38, 4))]
    )
