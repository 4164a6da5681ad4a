"""Column builders: predicates, text, dates, numbers, JSON and lists.

Every builder returns a built-in Spark expression, so it stays inside generated code.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes that mean the same in every regex dialect used here.
WORD = r"[\p{L}\p{N}_]"
# Letters whose capital takes more than one letter.
_LONG_CAPITALS = "".join(ch for ch in map(chr, range(0x10000)) if len(ch.title()) > 1)
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def instant(value: dt.datetime) -> Column:
    """A constant without a time zone; as text, so that no zone of the session shifts it."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


# --------------------------------------------------------------------------- predicates


def equals_ignoring_case(c: Column, value: str) -> Column:
    return F.lower(c) == value.lower()


def differs_or_null(c: Column, value) -> Column:
    """``c <> value`` that keeps NULLs."""
    return ~c.eqNullSafe(F.lit(value))


def equals_sql_null(c: Column) -> Column:
    """``c = NULL``: never true."""
    return c == F.lit(None)


def later_than_day(c: Column, day: dt.date) -> Column:
    """The calendar day of ``c`` lies after ``day``; written as a range so that it is pushed down."""
    return c >= instant(dt.datetime.combine(day + dt.timedelta(days=1), dt.time()))


def in_range(c: Column, low: dt.datetime, high: dt.datetime) -> Column:
    """Half-open time range."""
    return (c >= instant(low)) & (c < instant(high))


# --------------------------------------------------------------------------- text


def collapse_spaces(c: Column) -> Column:
    return F.regexp_replace(c, SPACE + "+", " ")


def strip_spaces(c: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def title_words(c: Column) -> Column:
    """Upper-case the first letter of each run of letters and digits, lower-case the rest.

    A first letter whose capital takes more than one letter stays as it is.
    """
    runs = F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))

    def written(run: Column) -> Column:
        first = F.left(run, F.lit(1))
        kept = F.when(first.rlike(f"[{_LONG_CAPITALS}]"), first).otherwise(F.upper(first))
        return F.concat(kept, F.lower(F.substring(run, F.lit(2), F.char_length(run))))

    return F.array_join(F.transform(runs, written), "")


def clean_name(c: Column) -> Column:
    return title_words(F.trim(collapse_spaces(c)))


def clock_label(hour: Column, minute: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), F.lpad(minute.cast("string"), 2, "0"))


def first_chars(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


# --------------------------------------------------------------------------- dates


def day_of_week(c: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(c) - 1


def date_key(c: Column) -> Column:
    """``20240315`` for 2024-03-15."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def quarter_hour_key(c: Column) -> Column:
    """``1430`` for any time from 14:30 up to 14:45."""
    return F.hour(c) * 100 + F.floor(F.minute(c) / 15).cast("int") * 15


def seconds_between(start: Column, end: Column) -> Column:
    """Exact decimal seconds.  Subtraction needs no time zone, unlike ``timestamp_diff``."""
    passed = end - start

    def field(name: str) -> Column:
        return F.extract(F.lit(name), passed)

    minutes = (field("DAY") * 24 + field("HOUR")) * 60 + field("MINUTE")
    return minutes.cast("decimal(18,0)") * 60 + field("SECOND")


def minutes_between(start: Column, end: Column, digits: int | None = None, half_even: bool = False) -> Column:
    minutes = seconds_between(start, end) / F.lit(60).cast("decimal(2,0)")
    if digits is None:
        return minutes
    return F.bround(minutes, digits) if half_even else F.round(minutes, digits)


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


# The first months of each tenure, and the label of longer ones.
TENURES = [(6, "0-6 months"), (12, "6-12 months"), (24, "1-2 years")]
LONGEST_TENURE = "2+ years"

# First and last hour of the parts of a day, the label of other hours, and the rush hours.
DAY_PARTS = [(6, 11, "Morning"), (12, 16, "Afternoon"), (17, 20, "Evening")]
OTHER_HOURS = "Night"
RUSH_HOURS = [(7, 8), (17, 19)]


def tenure_bucket(joined: Column, as_of: Column) -> Column:
    """How long ago ``joined`` lies before ``as_of``; a missing date counts as the longest tenure."""

    label = F.lit(LONGEST_TENURE)
    for months, name in reversed(TENURES):
        label = F.when(joined >= as_of - F.make_ym_interval(F.lit(0), F.lit(months)), name).otherwise(label)
    return label


def time_of_day(hour: Column) -> Column:
    label = F.lit(OTHER_HOURS)
    for first, last, name in DAY_PARTS:
        label = F.when(hour.between(first, last), name).otherwise(label)
    return label


def is_rush_hour(hour: Column) -> Column:
    return reduce(lambda a, b: a | b, [hour.between(first, last) for first, last in RUSH_HOURS])


def now(as_of: dt.datetime | None = None) -> Column:
    """The given instant, or the current one."""
    if as_of is None:
        return F.localtimestamp()
    return instant(as_of)


# --------------------------------------------------------------------------- numbers


def percent_of(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` of ``whole`` in percent, NULL when ``whole`` is zero."""
    return F.round(F.try_divide(part.cast("decimal(20,0)") * 100, whole.cast("decimal(20,0)")), digits)


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def bucket(rules: list[tuple[Column, str]], default: str) -> Column:
    """First rule that holds names the bucket."""
    out = F.when(*rules[0])
    for condition, label in rules[1:]:
        out = out.when(condition, label)
    return out.otherwise(default)


# --------------------------------------------------------------------------- lists and JSON


def first_listed(c: Column) -> Column:
    return F.get(F.split(c, ", "), 0)


def pick(items: Column, field: str, value: str) -> Column:
    """First struct of an array whose ``field`` equals ``value``, else NULL."""
    return F.get(F.filter(items, lambda s: s[field] == value), 0)


def record_json(*cols: str | Column) -> Column:
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


# --------------------------------------------------------------------------- numbers written as text


def known(c: Column) -> Column:
    """``N/A`` means missing."""
    return F.nullif(c, F.lit("N/A"))


def shaped_number(c: Column, shape: str, type_: str) -> Column:
    """The number that group 1 of ``shape`` finds, commas left out; NULL for text of another shape."""
    found = F.regexp_extract(known(c), f"^{shape}$", 1)
    return F.replace(found, F.lit(","), F.lit("")).try_cast(type_)


def plain_number(c: Column, type_: str = "bigint") -> Column:
    """``74`` or ``8.8``."""
    return shaped_number(c, r"(-?[0-9]+(?:\.[0-9]+)?)", type_)


def minutes_text(c: Column) -> Column:
    """``148 min``."""
    return shaped_number(c, "([0-9]+) min", "int")


def comma_number(c: Column) -> Column:
    """``2,345,678``."""
    return shaped_number(c, "(-?(?:[0-9]+|[0-9]{1,3}(?:,[0-9]{3})+))", "bigint")


def dollars(c: Column) -> Column:
    """``$28,341,469``."""
    return shaped_number(c, r"\$?((?:[0-9]+|[0-9]{1,3}(?:,[0-9]{3})+)(?:\.[0-9]+)?)", "decimal(15,2)")


def percent_text(c: Column) -> Column:
    """``87%``."""
    return shaped_number(c, "([0-9]+)%", "int")
