"""Event-time functions. All work on TIMESTAMP and TIMESTAMP_NTZ alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from listenhouse.schemas import FOREVER, type_of


def from_epoch_millis(c: str) -> Column:
    return F.timestamp_millis(F.col(c))


def time_parts(c: str = "ts", clock: bool = False) -> dict[str, Column]:
    """year, month, day, hour and, with ``clock``, minute and second."""
    parts = {
        "year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c), "hour": F.hour(c),
    }
    if clock:
        parts |= {"minute": F.minute(c), "second": F.second(c)}
    return parts


def hour_start(c: str | Column) -> Column:
    """Start of the hour, in the type of ``c`` (date_trunc would return
    TIMESTAMP for TIMESTAMP_NTZ)."""
    ts = F.col(c) if isinstance(c, str) else c
    past = F.make_dt_interval(F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts))
    return ts - past


def gap_seconds(start: Column, end: Column) -> Column:
    """Difference of whole seconds (each side floored first)."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)).cast("bigint")


def date_key_string(c: str = "ts") -> Column:
    """'yyyyMMddHH' built from the parts."""
    two = lambda part: F.lpad(part.cast("string"), 2, "0")
    p = time_parts(c)
    return F.concat_ws("", p["year"], two(p["month"]), two(p["day"]), two(p["hour"]))


def date_key(c: str = "ts") -> Column:
    """yyyyMMddHH as a bigint."""
    p = time_parts(c)
    return (
        p["year"] * 1_000_000 + p["month"] * 10_000 + p["day"] * 100 + p["hour"]
    ).cast("bigint")


def forever(df: DataFrame, column: str) -> Column:
    """The open end of a validity interval, in the type of ``column``."""
    return F.lit(FOREVER).cast(type_of(df, column))
