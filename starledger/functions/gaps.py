"""Time gaps between sales, in whole microseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_SECOND = 1_000_000


def micros(instant: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, whatever the session zone."""
    whole_seconds = (
        F.unix_date(instant.cast("date")).cast("long") * 86_400
        + F.hour(instant) * 3_600
        + F.minute(instant) * 60
    )
    seconds = F.extract(F.lit("SECOND"), instant)
    return whole_seconds * MICROS_PER_SECOND + (seconds * MICROS_PER_SECOND).cast("long")


def whole_div(numerator: Column, denominator: Column | int) -> Column:
    """Whole-number division, no detour through floating point."""
    denominator = denominator if isinstance(denominator, Column) else F.lit(denominator)
    return F.call_function("div", numerator, denominator)


def mean_gap(total: Column, gaps: Column) -> Column:
    """Mean rounded half up to a microsecond; NULL when there is no gap."""
    return F.when(gaps > 0, whole_div(total * 2 + gaps, gaps * 2))


def format_gap(gap: Column) -> Column:
    """Hours, minutes, rounded seconds and hundredths (labelled milliseconds) as one text.

    Seconds are rounded, not cut, and the last part is hundredths of a second: both are
    kept as the report defines them. Missing parts print as nothing.
    """
    second_micros = gap % (60 * MICROS_PER_SECOND)
    # The labels of the report line.
    return F.concat_ws(
        "",
        F.lit('"Hours": '),
        whole_div(gap, 3600 * MICROS_PER_SECOND) % 24,
        F.lit(', "minutes" :'),
        whole_div(gap, 60 * MICROS_PER_SECOND) % 60,
        F.lit(', "seconds" :'),
        whole_div(second_micros + 500_000, MICROS_PER_SECOND),
        F.lit(', "milliseconds" :'),
        whole_div(second_micros % MICROS_PER_SECOND + 5_000, 10_000),
    )
