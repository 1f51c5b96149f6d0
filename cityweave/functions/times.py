"""Date and time expressions.

The source text carries no zone, so every parsed value is a ``timestamp_ntz``. Parsing is tolerant:
text that does not fit gives NULL. ``parse_strict`` is the variant that fails the job instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms of the source files.
TIMESTAMP_FORM = r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2} [AP]M$"
DATE_FORM = r"^\d{2}/\d{2}/\d{4}$"
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(text: Column | str) -> Column:
    """``MM/dd/yyyy hh:mm:ss AM|PM`` text as ``timestamp_ntz``, NULL where it does not parse.

    The parts are assembled directly as a zone-free value; going through a zoned timestamp would move
    local times that fall into a daylight-saving gap of the session zone.
    """
    text = _col(text)

    def part(start: int, length: int) -> Column:
        return F.substring(text, start, length).try_cast("int")

    twelve, second = part(12, 2), part(18, 2)
    hour = twelve % 12 + F.when(F.substring(text, 21, 1) == "P", 12).otherwise(0)
    value = F.try_make_timestamp_ntz(part(7, 4), part(1, 2), part(4, 2), hour, part(15, 2), second)
    return F.when(text.rlike(TIMESTAMP_FORM) & twelve.between(1, 12) & (second < 60), value)


def parse_date(text: Column | str) -> Column:
    """``MM/dd/yyyy`` text as ``timestamp_ntz`` at midnight, NULL where it does not parse."""
    text = _col(text)
    return F.when(text.rlike(DATE_FORM), F.try_to_date(text, "MM/dd/yyyy").cast("timestamp_ntz"))


def parse_strict(text: Column | str, parsed: Column) -> Column:
    """``parsed``, but text that is present and did not parse fails the job."""
    text = _col(text)
    complaint = F.raise_error(F.concat(F.lit("cannot parse date text: "), text)).cast("timestamp_ntz")
    return F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(complaint)


def weekday_name(ts: Column | str) -> Column:
    """English weekday name, NULL for NULL."""
    return F.date_format(_col(ts), "EEEE")


def weekday_rank(day: Column | str) -> Column:
    """1 for Monday up to 7 for Sunday, for a weekday name."""
    return F.array_position(F.array(*[F.lit(d) for d in DAYS]), _col(day)).cast("int")


def military_hour(hhmm: Column | str) -> Column:
    """Hour of an HHMM integer such as 2130."""
    return (_col(hhmm) / 100).cast("int")


def month_start(year: Column | str, month: Column | str) -> Column:
    """First day of a month as a date."""
    return F.make_date(_col(year), _col(month), F.lit(1))
