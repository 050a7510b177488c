"""Timestamps, run ids and cursors."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
RUN_FORMAT = "yyyyMMdd_HHmm"


def utc(moment: datetime) -> datetime:
    """A naive datetime is taken as UTC."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def stamp(moment: datetime) -> Column:
    """One fixed TIMESTAMP literal, independent of session and machine time zone."""
    return F.timestamp_micros(F.lit((utc(moment) - EPOCH) // timedelta(microseconds=1)))


def moment(micros: int | None) -> datetime | None:
    """Microseconds since the epoch as an aware datetime: a stamp that leaves Spark this
    way does not depend on session or machine time zone."""
    return None if micros is None else EPOCH + timedelta(microseconds=micros)


def stamp_like(df: DataFrame, column: str, moment: datetime | Column) -> Column:
    """``moment`` in the type of ``df[column]``, so the comparison needs no cast of
    the column and is pushed to the scan."""
    if isinstance(moment, Column):
        return moment
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        text = utc(moment).replace(tzinfo=None).isoformat(sep=" ")
        return F.lit(text).cast(T.TimestampNTZType())
    return stamp(moment)


def run_id(moment: datetime) -> str:
    """Run name of a logical date, to the minute; sorts in time order."""
    return moment.strftime("%Y%m%d_%H%M")


def run_id_of(column: Column | str) -> Column:
    return F.date_format(column, RUN_FORMAT)
