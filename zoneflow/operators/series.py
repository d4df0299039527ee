"""Windows over long time series without one task per series.

`Window.partitionBy("zone")` puts a whole zone into one task. Here a series is cut into
buckets of about `rows_per_bucket` consecutive rows, and each bucket also receives copies of
the neighbouring rows its window frames reach (a halo). Windows then run per
(zone, bucket) and the copies are dropped afterwards. The result is the same, for row
offsets as well as for time ranges, with gaps or without.

What each bucket needs is read from a day index: rows per (zone, day). It is a small table,
bounded by zones x calendar days. It is joined without a hint, so Spark broadcasts it when
its size is known to be small. Key and time are required columns: never NULL.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000
ROWS_PER_BUCKET = 8192

_DAY, _HOME, _FIRST, _LAST, _BUCKET = "_day", "_home", "_first", "_last", "_bucket"


def _day_of(time_col: str) -> Column:
    return F.floor(F.unix_micros(time_col) / F.lit(24 * HOUR_US)).cast("int")


def day_index(df: DataFrame, key: str, time_col: str = "time") -> DataFrame:
    """Rows per (key, day); counted before the shuffle."""
    return df.groupBy(key, _day_of(time_col).alias(_DAY)).agg(F.count("*").alias("n"))


def _reach(
    index: DataFrame, key: str, rows_back: int, rows_ahead: int, hours_back: int, rows_per_bucket: int
) -> DataFrame:
    """Per (key, day): its own bucket, and the first and last bucket that need its rows."""
    by_day = Window.partitionBy(key).orderBy(_DAY)
    upto = F.sum("n").over(by_day.rowsBetween(Window.unboundedPreceding, 0))
    days = index.withColumn("upto", upto).withColumn("start", F.col("upto") - F.col("n"))
    days = days.withColumn(_HOME, F.floor(F.col("start") / rows_per_bucket).cast("int"))
    days = days.withColumns(
        {
            "_next": F.coalesce(F.lead(_HOME).over(by_day), F.col(_HOME)),
            "_prev": F.coalesce(F.lag(_HOME).over(by_day), F.col(_HOME)),
        }
    )
    last, first = [F.col(_HOME)], [F.col(_HOME)]
    if rows_back:
        # a later day starts at row `upto` of the day before it: the last such day that is
        # fewer than rows_back rows away
        near = Window.partitionBy(key).orderBy("upto").rangeBetween(0, rows_back - 1)
        last.append(F.max("_next").over(near))
    if rows_ahead:
        near = Window.partitionBy(key).orderBy("start").rangeBetween(1 - rows_ahead, 0)
        first.append(F.min("_prev").over(near))
    if hours_back:
        near = Window.partitionBy(key).orderBy(_DAY).rangeBetween(0, math.ceil(hours_back / 24))
        last.append(F.max(_HOME).over(near))
    return days.select(
        key,
        _DAY,
        _HOME,
        (F.least(*first) if len(first) > 1 else first[0]).alias(_FIRST),
        (F.greatest(*last) if len(last) > 1 else last[0]).alias(_LAST),
    )


def series_window(
    df: DataFrame,
    columns: Callable[[SeriesFrames], dict[str, Column]],
    key: str = "zone",
    time_col: str = "time",
    rows_back: int = 0,
    rows_ahead: int = 0,
    hours_back: int = 0,
    index: DataFrame | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add window columns per series.

    `columns` builds them from the frames it is given; `rows_back`, `rows_ahead` and
    `hours_back` say how far they reach. Pass `index` (a written `day_index`) to let Spark
    see its size; otherwise it is derived from `df`.
    """
    index = day_index(df, key, time_col) if index is None else index
    reach = _reach(index, key, rows_back, rows_ahead, hours_back, rows_per_bucket)
    copies = (
        df.withColumn(_DAY, _day_of(time_col))
        .join(reach, [key, _DAY])
        .withColumn(_BUCKET, F.explode(F.sequence(_FIRST, _LAST)))
    )
    added = columns(SeriesFrames([key, _BUCKET], time_col))
    out = copies.withColumns(added).filter(F.col(_BUCKET) == F.col(_HOME))
    return out.select(*df.columns, *added)


class SeriesFrames:
    """Window frames of one series. All share one partitioning and one order, so Spark
    plans a single sort and a single window node for them."""

    def __init__(self, partition: list[str], time_col: str):
        self._ordered = Window.partitionBy(*partition).orderBy(F.unix_micros(time_col))

    def lag(self, c: str, rows: int) -> Column:
        return F.lag(c, rows).over(self._ordered)

    def lead(self, c: str, rows: int) -> Column:
        return F.lead(c, rows).over(self._ordered)

    def avg_between(self, c: str, hours_from: int, hours_to: int) -> Column:
        """Mean over the rows `hours_from` to `hours_to` hours back, both ends included."""
        frame = self._ordered.rangeBetween(-hours_from * HOUR_US, -hours_to * HOUR_US)
        return F.avg(c).over(frame)
