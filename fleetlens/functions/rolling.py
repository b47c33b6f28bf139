"""Rolling indicators over rows or days."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from fleetlens.functions.scalars import ratio


def frame(partition: list[str], day: str, size: int, by: str):
    """The current and the size - 1 preceding rows, or days."""
    if by == "rows":
        return Window.partitionBy(*partition).orderBy(day).rowsBetween(1 - size, 0)
    if by == "days":
        return Window.partitionBy(*partition).orderBy(F.unix_date(F.col(day))).rangeBetween(1 - size, 0)
    raise ValueError("a frame goes by rows or days")


def rolling_mean(x: str, partition: list[str], day: str = "service_date", size: int = 28, by: str = "rows") -> Column:
    return F.avg(x).over(frame(partition, day, size, by))


def rolling_stddev(x: str, partition: list[str], day: str = "service_date", size: int = 28, by: str = "rows") -> Column:
    return F.stddev_samp(x).over(frame(partition, day, size, by))


def change_from(x: str, mean: str) -> Column:
    return ratio(F.col(x) - F.col(mean), F.col(mean))


def z_score(x: str, mean: str, deviation: str) -> Column:
    return ratio(F.col(x) - F.col(mean), F.col(deviation))
