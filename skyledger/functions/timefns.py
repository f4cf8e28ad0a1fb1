"""Time columns: fixed-offset rendering, run months, epoch buckets, log time formats."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_OFFSET_HOURS = 8  # fixed value: notices are rendered at UTC+08:00


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def local_stamp(ts: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm:ss+0800`` of a UTC timestamp."""
    return F.concat(F.date_format(_shift(ts), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(f"+{LOCAL_OFFSET_HOURS:02d}00"))


def local_clock(ts: Column | str) -> Column:
    """``HH:mm:ss`` part of the local time."""
    return F.date_format(_shift(ts), "HH:mm:ss")


def _shift(ts: Column | str) -> Column:
    return _col(ts).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(LOCAL_OFFSET_HOURS))


def in_quiet_window(clock: Column | str, start: str = "08:00", end: str = "23:00") -> Column:
    """Text comparison on ``HH:mm:ss``: true from ``start`` up to, not including, ``end``."""
    return (_col(clock) >= start) & (_col(clock) < end)


def rfc1123(text: Column | str) -> Column:
    """``Mon, 26 Jul 2021 12:00:00 GMT`` without the weekday, which the parser does not take."""
    day_on = F.regexp_extract(_col(text), r"^[A-Za-z]{3}, *(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2})", 1)
    return F.try_to_timestamp(day_on, F.lit("d MMM yyyy HH:mm:ss"))


def warehouse_time(text: Column | str) -> Column:
    """``Thu, 24 Jun 2021 01:46:05:123`` (milliseconds after a colon)."""
    day_on = F.regexp_extract(_col(text), r"^ *[A-Za-z]{3}, *(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}:\d{1,6})", 1)
    return F.try_to_timestamp(day_on, F.lit("d MMM yyyy HH:mm:ss:[SSSSSS][SSSSS][SSSS][SSS][SS][S]"))


def epoch_millis(ts: Column | str) -> Column:
    return F.unix_millis(_col(ts).cast("timestamp"))


def epoch_seconds(ts: Column | str) -> Column:
    return F.unix_seconds(_col(ts).cast("timestamp"))


def floor_epoch(seconds: Column | str, period: int | Column) -> Column:
    """Epoch-aligned start of the period that holds ``seconds``."""
    s = _col(seconds).cast("long")
    width = (F.lit(period) if isinstance(period, int) else period).cast("long")
    return s - F.pmod(s, width)


def usage_day(ts: Column | str) -> Column:
    """A daily sample taken at the end of a day belongs to the day before."""
    return F.to_date(_col(ts).cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(1)))


def previous_month(as_of: Column | str) -> tuple[Column, Column]:
    """Year and un-padded month, as text, of the calendar month before ``as_of``."""
    before = F.add_months(_col(as_of).cast("date"), -1)
    return F.year(before).cast("string"), F.month(before).cast("string")


def run_month(time: str | None = None, as_of: date | None = None) -> tuple[str, str]:
    """(year, month) of a run: from ``YYYY-MM…`` text, else the month two days before this month began."""
    if time:
        year, month = time.split("T")[0].split("-")[:2]
        return year, month
    day = (as_of or date.today()).replace(day=1) - timedelta(days=2)
    return f"{day.year:04d}", f"{day.month:02d}"
