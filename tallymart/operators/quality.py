"""Row classification, rejects, run metrics and the quality gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.contract import MAX_BAD_FRACTION
from tallymart.sources.readers import CORRUPT

REASONS = "reject_reasons"


class QualityGateError(RuntimeError):
    """Too many rejected rows; the run must not publish."""


def _kept(date: str, amount: str) -> Column:
    return F.col(date).isNotNull() & F.col(amount).isNotNull() & (F.col(amount) > 0)


def is_good(date: str = "order_date", amount: str = "sales_clean") -> Column:
    """A dated row with a positive amount.  Never NULL, so it can be negated."""
    return F.coalesce(_kept(date, amount), F.lit(False))


def good_rows(df: DataFrame, date: str = "order_date", amount: str = "sales_clean") -> DataFrame:
    return df.where(_kept(date, amount))


def rejected_rows(
    df: DataFrame, date: str = "order_date", amount: str = "sales_clean"
) -> DataFrame:
    """Every row ``good_rows`` leaves out, duplicates included.

    The same multiset as ``df EXCEPT ALL good``, without comparing whole rows.
    """
    return df.where(~is_good(date, amount))


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Multiset difference of two tables of the same shape."""
    return left.exceptAll(right)


def reject_reasons(
    columns: list[str],
    date: str = "order_date",
    amount: str = "sales_clean",
    date_range: tuple | None = None,
    keys: tuple[str, ...] = (),
) -> Column:
    """Names of the rules a row breaks; empty for a good row.  No column of ``keys`` may be NULL."""
    rules = {
        "missing_order_date": F.col(date).isNull(),
        "missing_sales": F.col(amount).isNull(),
        "non_positive_sales": F.col(amount) <= 0,
    }
    if date_range is not None:
        first, last = map(F.lit, date_range)
        rules["order_date_out_of_range"] = ~F.col(date).between(first, last)
    rules.update({f"missing_{key}": F.col(key).isNull() for key in keys if f"missing_{key}" not in rules})
    if CORRUPT in columns:
        rules["corrupt_record"] = F.col(CORRUPT).isNotNull()
    # no function over the elements: that would take the whole projection out of generated code
    return F.array_remove(F.array(*[F.when(broken, name).otherwise("") for name, broken in rules.items()]), "")


def classify(
    df: DataFrame,
    date: str = "order_date",
    amount: str = "sales_clean",
    date_range: tuple | None = None,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """``df`` with the rules each row breaks.  A row of the wrong width is a reject."""
    return df.withColumn(REASONS, reject_reasons(df.columns, date, amount, date_range, keys))


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.size(REASONS) == 0).drop(REASONS, CORRUPT)


def quarantined(classified: DataFrame) -> DataFrame:
    return classified.where(F.size(REASONS) > 0)


@dataclass(frozen=True)
class RunMetrics:
    row_in: int
    row_good: int

    @property
    def row_bad(self) -> int:
        return self.row_in - self.row_good

    @property
    def bad_fraction(self) -> float:
        return self.row_bad / max(self.row_in, 1)


def quality_metrics(df: DataFrame, good: Column) -> DataFrame:
    """Rows in, good, bad and the bad share, in one aggregate."""
    rows = F.count(F.lit(1))
    bad = F.count_if(~good)
    return df.agg(
        rows.alias("row_in"),
        F.count_if(good).alias("row_good"),
        bad.alias("row_bad"),
        (bad / F.greatest(rows, F.lit(1))).alias("bad_fraction"),
    )


def collect_metrics(classified: DataFrame) -> RunMetrics:
    """The one row the driver needs for the gate."""
    row = quality_metrics(classified, F.size(REASONS) == 0).first()
    return RunMetrics(row["row_in"], row["row_good"])


def reason_counts(classified: DataFrame) -> DataFrame:
    """Rows per broken rule; a row that breaks two rules counts in both."""
    return (
        quarantined(classified)
        .select(F.explode(REASONS).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def check_gate(metrics: RunMetrics, limit: float = MAX_BAD_FRACTION) -> None:
    """Raise if the bad share is above ``limit``; exactly ``limit`` passes."""
    if metrics.bad_fraction > limit:
        raise QualityGateError(
            f"bad row fraction {metrics.bad_fraction:.2%} is above {limit:.2%}; "
            "see the quarantine of this run"
        )
