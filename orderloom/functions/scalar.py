"""Column expressions shared by the operators. All of them are ANSI-safe."""

from __future__ import annotations

from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

MONEY = "decimal(18,2)"


def blank_to_null(c: Column) -> Column:
    """Trimmed text; empty text is NULL."""
    trimmed = F.trim(c)
    return F.when(trimmed != "", trimmed)


def try_timestamp(c: Column) -> Column:
    """Zone-free timestamp; unparseable text is NULL."""
    return c.try_cast("timestamp_ntz")


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def safe_ratio(num: Column, den: Column, otherwise: Column | None = None) -> Column:
    """``num / den`` where ``den`` is positive, else ``otherwise`` (NULL by default)."""
    ratio = F.when(den > 0, num.cast("double") / den.cast("double"))
    return ratio if otherwise is None else F.coalesce(ratio, otherwise)


def clip(c: Column, lo: Column | float, hi: Column | float) -> Column:
    """Clamp, keeping NULL as NULL (``least``/``greatest`` alone would drop it)."""
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(c.isNotNull(), F.greatest(lo, F.least(hi, c)))


def min_max_scale(c: Column, lo: Column, hi: Column) -> Column:
    """Scale to [0, 1]; a constant column becomes 0."""
    return F.when(hi == lo, F.lit(0.0)).otherwise(
        (c - lo).cast("double") / F.nullif(hi - lo, F.lit(0)).cast("double")
    )


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def any_null(names: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(n).isNull() for n in names))


def month_index(d: Column) -> Column:
    """Months since year 0; consecutive for consecutive calendar months."""
    return F.year(d) * 12 + F.month(d) - 1


def month_index_ceil(d: Column) -> Column:
    """Index of the first month start on or after ``d``."""
    return month_index(d) + F.when(F.dayofmonth(d) > 1, 1).otherwise(0)


def month_start(index: Column) -> Column:
    return F.make_date(F.floor(index / 12).cast("int"), (index % 12 + 1).cast("int"), F.lit(1))


def sorted_report(df: DataFrame, *order: Column | str) -> DataFrame:
    """Order a report of bounded size (days, months, bins): one small partition, sorted,
    which spares the sampling pass of a range sort."""
    return df.repartition(1).sortWithinPartitions(*order)


def stamp(run_ts: datetime | None) -> Column:
    """The run's zone-free timestamp; the wall clock when none is given. Passed as text,
    so that no time zone setting moves it."""
    if run_ts is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if run_ts.tzinfo:
        run_ts = run_ts.astimezone(UTC).replace(tzinfo=None)
    return F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
