"""Bronze text -> typed columns beside the raw ones, then silver columns."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.contract import OrderContract
from tallymart.functions import values as V
from tallymart.functions.naming import normalize_columns
from tallymart.operators.schema import canonical


def clean_money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({f"{c}_clean": V.money(F.col(c)) for c in columns})


def clean_quantity(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({f"{c}_clean": V.quantity(F.col(c)) for c in columns})


def parse_dates(
    df: DataFrame, *columns: str, formats: tuple[str, ...] = V.DATE_FORMATS
) -> DataFrame:
    return df.withColumns({c: V.parse_date(F.col(c), formats) for c in columns})


def standardize_dimensions(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: V.dimension(F.col(c)) for c in columns})


def clean_orders(
    df: DataFrame, contract: OrderContract = OrderContract(), names: str = "snake"
) -> DataFrame:
    """Names, contract columns, dates, amounts and quantities in one projection.

    The raw text of dates is replaced; that of amounts and quantities stays.
    Dimensions are left as they came so that rejects show the source's value.
    """
    df = canonical(normalize_columns(df, names), contract)
    present = set(df.columns)

    def among(columns: tuple[str, ...]) -> list[str]:
        return [c for c in columns if c in present]

    typed = {c: V.parse_date(F.col(c), contract.date_formats, contract.iso_first) for c in among(contract.date_columns)}
    typed |= {f"{c}_clean": V.money(F.col(c)) for c in among(contract.money)}
    typed |= {f"{c}_clean": V.quantity(F.col(c)) for c in among(contract.quantities)}
    return df.withColumns(typed)


def late_measures(
    contract: OrderContract, columns: Collection[str], needed: Collection[str] = ()
) -> dict[str, Column]:
    """Of the ``_clean`` columns those that can be read from their text again, whenever they are wanted.

    Rules and orders must not need them: those in ``needed`` and those of dimensions are left out.
    """
    texts = {c: V.money for c in contract.money} | {c: V.quantity for c in contract.quantities}
    taken = {*needed, *contract.dimensions, *[f"{c}_clean" for c in contract.dimensions]}
    return {f"{c}_clean": read(F.col(c)) for c, read in texts.items() if f"{c}_clean" in set(columns) - taken}


def with_period(df: DataFrame) -> DataFrame:
    return df.withColumns({"year": F.year("order_date"), "month": F.month("order_date")})


def silver_columns(df: DataFrame, contract: OrderContract = OrderContract()) -> DataFrame:
    """Standard dimensions and the period columns.

    A source column named ``year`` or ``month`` is kept as ``src_year`` or
    ``src_month``.
    """
    for period in ("year", "month"):
        if period in df.columns:
            df = df.withColumnRenamed(period, f"src_{period}")
    return with_period(df.withColumns({c: V.dimension(F.col(c)) for c in contract.dimensions if c in df.columns}))
