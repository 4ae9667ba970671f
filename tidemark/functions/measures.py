"""Column helpers whose results do not depend on the order of addition."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def money(c: str | Column) -> Column:
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


def money_sum(c: str | Column) -> Column:
    """Exact sum of cents, handed back as a double."""
    return F.sum(money(c)).cast("double")


def money_avg(c: str | Column) -> Column:
    return F.sum(money(c)).cast("double") / F.count(money(c))


def count_where(pred: Column) -> Column:
    """Rows where ``pred`` is true; null counts as not true."""
    return F.count_if(F.coalesce(pred, F.lit(False)))


def pct(part: Column, whole: Column) -> Column:
    """Share in percent, null when there is no whole."""
    return F.when(whole != 0, part * F.lit(100.0) / whole)


def revenue() -> Column:
    """Line revenue with four exact decimals."""
    return money("l_extendedprice") * (F.lit(1).cast("decimal(18,2)") - money("l_discount"))
