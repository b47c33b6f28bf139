"""The row before or after a row of a long series, without sorting the whole series.

Rows are sorted within a series and day. A table of each day's first and last row, one for a series and day, carries over
from one day to the next; it is small, can be kept between runs, and is all that a new day needs of earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = "__day"


def ends(df: DataFrame, series: str, time: str, tie: str, fields: Sequence[str]) -> DataFrame:
    """(series, day, first_row, last_row): the first and last row of each series and day, as structs of fields."""
    order, row = F.struct(time, tie), F.struct(*fields)
    return df.groupBy(series, F.to_date(time).alias(DAY)).agg(F.min_by(row, order).alias("first_row"), F.max_by(row, order).alias("last_row"))


def neighbour(
    df: DataFrame, series: str, time: str, tie: str, fields: Sequence[str], name: str, after: bool = False, known: DataFrame | None = None
) -> DataFrame:
    """df with a struct of the fields of the row before, or after, in its series by time and tie; null at the series' end,
    and for rows without a series or a time. The join goes by the keys that the rows are dealt out by already.

    known holds ends() of days that df lacks, as a run over a new day has them from the run before.
    """
    dated = df.withColumn(DAY, F.to_date(time))
    own = Window.partitionBy(series, DAY).orderBy(time, tie)
    step: Column = F.lead(F.struct(*fields)).over(own) if after else F.lag(F.struct(*fields)).over(own)
    within = dated.withColumn("__near", step)
    each = ends(df, series, time, tie, fields)
    if known is not None:
        each = each.unionByName(known)
    days = Window.partitionBy(series).orderBy(DAY)  # a row a day
    carried = F.lead("first_row").over(days) if after else F.lag("last_row").over(days)
    other = each.select(F.col(series).alias("__series"), F.col(DAY).alias("__of"), carried.alias("__carried"))
    met = within.join(other, (F.col(series) == F.col("__series")) & (F.col(DAY) == F.col("__of")), "left")
    near = F.when(F.col(series).isNotNull() & F.col(time).isNotNull(), F.coalesce("__near", "__carried"))
    return met.withColumn(name, near).drop("__near", "__carried", "__series", "__of", DAY)
