"""Expressions over raw text and over the signal map of a reading."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reading times are "day month year hour:minute". One-letter fields accept one or two
# digits, so "01 02 2018 00:00" and "1 2 2018 0:00" are the same instant.
TIME_PATTERN = "d M yyyy H:mm"
DATE_PATTERN = "d M yyyy"
LEADING_TIME = r"^[0-9]{1,2} [0-9]{1,2} [0-9]{4} [0-9]{1,2}:[0-9]{2}(?![0-9])"


def quoted(name: str) -> str:
    """Name usable inside ``col`` whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def reading_time(text: Column) -> Column:
    """Timestamp of a reading, NULL for bad text; anything after the minutes is ignored."""
    leading = F.regexp_extract(text, LEADING_TIME, 0)
    return F.try_to_timestamp(F.when(leading != "", leading), F.lit(TIME_PATTERN))


def reading_date(text: Column) -> Column:
    """Date of a reading. A reading with a good day but a broken time of day keeps its day: only for
    such text the first three fields are parsed on their own."""
    day_only = F.try_to_timestamp(F.substring_index(text, " ", 3), F.lit(DATE_PATTERN))
    return F.to_date(F.coalesce(reading_time(text), day_only))


def signal_map(values: Mapping[str, Column]) -> Column:
    """``map<string,string>`` from signal key to value."""
    entries: list[Column] = []
    for key, value in values.items():
        entries += [F.lit(key), value.cast("string")]
    return F.create_map(*entries)


def signal_text(key: str, signals: str = "signals") -> Column:
    """Value of one signal as text; NULL when the reading has no such key."""
    return F.col(signals).getItem(key)


def signal_value(key: str, kind: str = "float", signals: str = "signals") -> Column:
    """Value of one signal as a number; NULL when absent or not numeric.

    The default is the 32-bit float: it is what averages are defined over, and the difference to
    ``double`` is visible in the eighth digit.
    """
    return signal_text(key, signals).try_cast(kind)
