"""Column expressions for untyped source text.

Source columns stay text.  Every function here returns a Column built from
Spark's own functions, so rules that use them stay inside one projection.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000
UNBOUNDED_US = 9_223_372_036_854_775_807

# Fixed value: the absolute tolerance of every decimal comparison.
TOLERANCE = "0.000001"

_PLAIN_STAMP = r"^(?!0000)\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}$"
_OFFSET_STAMP = r"^(?!0000)\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:Z|[+-]\d{2}:\d{2})$"
_STAMP = (
    r"(?s)^(?!0000)(?:\d{4}-\d{2}-\d{2}|\d{8})"
    r"(?:.(?:\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{4}(?:\d{2}(?:[.,]\d+)?)?)"
    r"(?:Z|[+-]\d{2}(?::\d{2}(?::\d{2})?|\d{2}(?:\d{2})?)?)?)?$"
)
_FIELDS = r"(?s)^(\d{4})-?(\d{2})-?(\d{2})(?:.(\d{2})(?::?(\d{2}))?(?::?(\d{2}))?)?"


def missing(value: Column) -> Column:
    """Null or the exact empty text.  Blanks are values; nothing is trimmed."""
    return value.isNull() | (value == "")


def present(value: Column) -> Column:
    return value.isNotNull() & (value != "")


def one_of(value: Column, allowed: Iterable[str]) -> Column:
    """Exact membership; a null is outside every domain."""
    return F.coalesce(value.isin(*allowed), F.lit(False))


def quoted(value: Column) -> Column:
    """Text in the quoting style of the rule messages: 'x', or "x" when x holds a '."""
    escaped = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), escaped, F.lit('"'))
    return F.when(value.contains("'") & ~value.contains('"'), double).otherwise(single)


def iso_date(value: Column) -> Column:
    """``YYYY-MM-DD`` or ``YYYYMMDD`` as DATE; anything else is null."""
    extended = F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}$"), value).when(
        value.rlike(r"^\d{8}$"), F.regexp_replace(value, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    )
    return F.when(~value.startswith("0000"), extended.try_cast("date"))


def _spelled_out(value: Column) -> Column:
    """Any accepted ISO spelling as ``YYYY-MM-DD HH:MM:SS[.f][offset]``; else null."""
    parts = F.regexp_replace(value, _FIELDS, "$1-$2-$3 $4:$5:$6")
    filled = F.replace(F.replace(parts, F.lit(" :"), F.lit(" 00:")), F.lit("::"), F.lit(":00:"))
    whole = F.translate(F.regexp_replace(filled, r":(?=$|[Z+-])", ":00"), ",", ".")
    return F.when(value.rlike(_PLAIN_STAMP), value).when(value.rlike(_STAMP), whole)


def _moment(text: Column) -> Column:
    clock = F.substr(text, F.lit(11))
    wall = F.concat(F.substring(text, 1, 10), F.regexp_replace(clock, r"[Z+-].*$", ""), F.lit("Z"))
    wall_us = F.unix_micros(wall.try_cast("timestamp"))
    aware = clock.rlike("[Z+-]")
    at_us = F.when(aware, F.unix_micros(text.try_cast("timestamp"))).otherwise(wall_us)
    return F.when(
        at_us.isNotNull(),
        F.struct(wall_us.alias("wall_us"), at_us.alias("at_us"), aware.alias("aware")),
    )


def iso_timestamp(value: Column) -> Column:
    """ISO text as ``struct<wall_us, at_us, aware>``; null when malformed.

    ``wall_us`` is the wall clock in microseconds, ``at_us`` the same moved to
    UTC by the written offset, ``aware`` tells whether an offset was written.
    Plain integers keep the result free of the session time zone and cheap to
    sort and compare.

    The usual spellings are read by small compiled branches.  The rare ones sit
    behind a one-element ``transform``, which keeps them out of the generated
    method: it would otherwise grow too large to be compiled to machine code.
    """

    def micros(text: Column) -> Column:
        return F.unix_micros(text.try_cast("timestamp"))

    def moment(wall: Column, at: Column, aware: bool) -> Column:
        fields = F.struct(wall.alias("wall_us"), at.alias("at_us"), F.lit(aware).alias("aware"))
        return F.when(at.isNotNull(), fields)

    plain = micros(F.concat(value, F.lit("Z")))
    local = micros(F.concat(F.substring(value, 1, 19), F.lit("Z")))
    other = F.transform(F.array(_spelled_out(value)), _moment)[0]
    return (
        F.when(value.rlike(_PLAIN_STAMP), moment(plain, plain, False))
        .when(value.rlike(_OFFSET_STAMP), moment(local, micros(value), True))
        .when(value.rlike(_STAMP), other)
    )


def interval_end_us(end_text: Column, end: Column) -> Column:
    """End of a half-open interval: a missing text means unbounded."""
    return F.when(missing(end_text), F.lit(UNBOUNDED_US)).otherwise(end["at_us"])


def finite_decimal(value: Column) -> Column:
    """Finite decimal text as DECIMAL(38,10); NaN, infinities and other text are null."""
    return value.try_cast("decimal(38,10)")


def within_tolerance(left: Column, right: Column) -> Column:
    """|left - right| <= 0.000001 on decimals; null when either side is null."""
    return F.abs(left - right) <= F.lit(TOLERANCE).cast("decimal(7,6)")
