"""Mixed-format date text."""

from __future__ import annotations

import calendar

from pyspark.sql import Column, functions as F

# The recognised layouts. A text that fits one is rewritten as year-month-day,
# in this order. Year first with a two-digit day takes full month names only. Numeric dates
# are month first unless only day first fits.
ISO = r"^\d{4}-\d{2}-\d{2}$"
NUMERIC_REWRITES = [
    (r"^(\d{4})-(\d{2})-(\d{2})[ T](?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?$", "$1-$2-$3"),
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "$1-$2-$3"),
    (r"^(1[3-9]|2\d|3[01])[/-](\d{1,2})[/-](\d{4})$", "$3-$2-$1"),
    (r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})$", "$3-$1-$2"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
]
NAMED_REWRITES = [
    (r"^(\d{4}) ([a-z]{4,}|may) (\d{2})$", "$1-$2-$3"),
    (r"^(\d{4}) ([a-z]{3,}) (\d)$", "$1-$2-$3"),
    (r"^([a-z]{3,}) (\d{4}) (\d{1,2})$", "$2-$1-$3"),
    (r"^(\d{1,2}) ([a-z]{3,}) (\d{4})$", "$3-$2-$1"),
    (r"^([a-z]{3,}) (\d{1,2}),? (\d{4})$", "$3-$1-$2"),
    (
        "-(?:(jan)uary|(feb)ruary|(mar)ch|(apr)il|(jun)e|(jul)y|(aug)ust|(sep)tember"
        "|(oct)ober|(nov)ember|(dec)ember)-",
        "-$1$2$3$4$5$6$7$8$9$10$11-",
    ),
]


# Texts that start like this have a format of their own, and are no dates where they do not fit it.
FIXED_LAYOUT = r"^(?:NULL$|\d{4}/\d{1,2}/\d{1,2}|\d{4} [a-zA-Z]{3,} \d{2})"

#: Years of two digits lie within 50 years of this one.
TWO_DIGIT_YEARS_AROUND = 2025

# Words that a date may hold beside its parts.
FILLERS = ["at", "on", "and", "ad", "m", "t", "of"]
# A time of day, with its zone, behind a date or before it; and an hour alone.
_TIME = (
    r"(?:(?<=\d)t|\b)(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?(?:\s*[ap]m\b)?(?:\s*(?:z\b|[+-]\d{2}:?\d{2}\b))?(?![\w:])"
    r"|(?<=^\d{8})t\d{4}(?:\d{2})?$|\b(?:0?[1-9]|1[0-2])\s*[ap]m\b"
)
# Dates that a count of nanoseconds can hold.
EARLIEST, LATEST = "1677-09-22", "2262-04-10"


def _names(full: list[str], *others: str) -> list[tuple[str, int]]:
    """Names and their first three letters, with their numbers."""
    return [(form, n) for n, name in enumerate(full) if name for form in sorted({name.lower(), name[:3].lower()})] + [
        (other, next(n for n, name in enumerate(full) if name.lower().startswith(other[:3]))) for other in others
    ]


def _listed(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


_MONTHS = ", ".join(f"'{name}', {n}" for name, n in _names(list(calendar.month_name), "sept"))
_WEEKDAYS = [name for name, _ in _names(list(calendar.day_name))]

# The grammar as SQL, since a tree of this size is built faster from a text. ``let(a, b)`` below is b with a under a name.
_READABLE = r"""regexp_replace(regexp_replace(trim(lower(text)), r"{time}", ' '), r"(?<=\d)(?:st|nd|rd|th)\b", '')"""
# A token's parts: numbers of eight or six digits are three, words are a month or have no value.
_PARTS = """CASE
    WHEN t IN ({idle}) THEN CAST(array() AS ARRAY<STRUCT<value: INT, month: BOOLEAN, digits: INT>>)
    WHEN NOT t RLIKE '^[0-9]' THEN array({month})
    WHEN length(t) = 8 THEN array({eight})
    WHEN length(t) = 6 THEN array({six})
    ELSE array({number}) END"""
# Year, month and day of the parts p by their places; ``first`` stands for the first day or month.
_ORDER = """CASE
    WHEN size(p) = 3 AND p[0].month AND p[1].value > 31 THEN array(p[1], p[0], p[2])
    WHEN size(p) = 3 AND p[0].month THEN array(p[2], p[0], p[1])
    WHEN size(p) = 3 AND p[1].month AND p[0].value > 31 THEN array(p[0], p[1], p[2])
    WHEN size(p) = 3 AND p[1].month THEN array(p[2], p[1], p[0])
    WHEN size(p) = 3 AND p[2].month AND p[1].value > 31 THEN array(p[1], p[2], p[0])
    WHEN size(p) = 3 AND p[2].month THEN array(p[0], p[2], p[1])
    WHEN size(p) = 3 AND (p[0].value > 31 OR p[0].digits > 2) THEN array(p[0], p[1], p[2])
    WHEN size(p) = 3 AND p[0].value > 12 THEN array(p[2], p[1], p[0])
    WHEN size(p) = 3 THEN array(p[2], p[0], p[1])
    WHEN exists(tokens, t -> t IN ({weekdays})) THEN NULL
    WHEN size(p) = 2 AND p[0].value > 31 AND NOT p[0].month THEN array(p[0], p[1], {first})
    WHEN size(p) = 2 AND p[1].value > 31 AND NOT p[1].month THEN array(p[1], p[0], {first})
    WHEN size(p) = 1 AND p[0].digits = 4 AND NOT p[0].month THEN array(p[0], {first}, {first}) END"""
_WHOLE = "size(filter(p, x -> x.month)) <= 1 AND NOT exists(p, x -> x.value IS NULL)"
_YEAR = """CASE
    WHEN o[0].digits > 2 THEN o[0].value
    WHEN o[0].value + {century} >= {around} + 50 THEN o[0].value + {century} - 100
    WHEN o[0].value + {century} < {around} - 50 THEN o[0].value + {century} + 100
    ELSE o[0].value + {century} END"""


def _part(value: str, month: str, digits: str | int) -> str:
    return f"struct({value} AS value, {month} AS month, {digits} AS digits)"


def _cuts(*places: tuple[int, int]) -> str:
    return ", ".join(_part(f"try_cast(substring(t, {start}, {n}) AS INT)", "false", n) for start, n in places)


def _let(name: str, value: str, use: str) -> str:
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def _lenient_sql(around: int) -> str:
    parts = _PARTS.format(
        idle=_listed([*FILLERS, *_WEEKDAYS]), month=_part(f"try_element_at(map({_MONTHS}), t)", "true", 0),
        eight=_cuts((1, 4), (5, 2), (7, 2)), six=_cuts((1, 2), (3, 2), (5, 2)),
        number=_part("try_cast(t AS INT)", "false", "length(t)"),
    )
    order = _ORDER.format(weekdays=_listed(_WEEKDAYS), first=_part("1", "false", 1))
    year = _YEAR.format(around=around, century=around // 100 * 100)
    written = f"try_to_date(concat_ws('-', lpad(CAST({year} AS STRING), 4, '0'), o[1].value, o[2].value), 'yyyy-M-d')"
    day = _let("d", written, f"CASE WHEN d BETWEEN DATE '{EARLIEST}' AND DATE '{LATEST}' THEN d END")
    ordered = f"CASE WHEN {_WHOLE} THEN {_let('o', order, f'CASE WHEN o IS NOT NULL THEN {day} END')} END"
    assembled = _let("p", f"flatten(transform(tokens, t -> {parts}))", ordered)
    found = _let("tokens", "regexp_extract_all(date, '[a-z]+|[0-9]+', 0)", assembled)
    readable = "date RLIKE r\"^[a-z0-9\\s.,;/'-]{4,60}$\" AND date RLIKE r'\\d'"
    return _let("date", _READABLE.format(time=_TIME), f"CASE WHEN {readable} THEN {found} END")


def clean_dates_lenient(text: Column, around: int = TWO_DIGIT_YEARS_AROUND) -> Column:
    """Date of a text in words and numbers, read by a grammar of tokens; NULL where they make no date.

    The text, without its time of day, is cut into words and numbers. A word is a month, a weekday or a filler; a number of
    eight or six digits is three numbers, others are one. The parts that are left, three at most and one month
    name at most, are year, month and day by their places:

    * with a month name, a number above 31 is the year; if none is, the last number is the year, or the first
      one where the month comes last;
    * without, a first number above 31 is the year, then month and day; one above 12 is the day, then month and year;
      otherwise the month is first, then day and year;
    * two parts are a year and its month, one of four digits a year: they mean the first day.

    Weekdays are not checked and are no days; a month and day without a year are no date. A year of two digits is the one within
    50 years of ``around``.
    """
    return F.get(F.call_function("transform", F.array(text), F.expr(f"text -> {_lenient_sql(around)}")), F.lit(0))


def _rewritten(text: Column, rewrites: list[tuple[str, str]], result: str) -> Column:
    """Text after all rewrites, or NULL unless it ends up as ``result``."""
    for shape, parts in rewrites:
        text = F.regexp_replace(text, shape, parts)
    return F.get(F.regexp_extract_all(text, F.lit(result), F.lit(0)), F.lit(0))


def clean_dates(text: Column, around: int = TWO_DIGIT_YEARS_AROUND) -> Column:
    """Date of a mixed-format text; 'NULL', NULL and unreadable text give NULL.

    Texts of a known shape are rewritten and parsed; what is left is read token by token
    (``clean_dates_lenient``), but for texts that start like a layout with a format of its own and do not fit it. A
    text of a known shape that is no date ('2001-13-45') is a reject like any other.
    """
    lenient = F.when(~text.rlike(FIXED_LAYOUT), clean_dates_lenient(text, around))
    return F.coalesce(_of_known_shape(text), lenient)


def _of_known_shape(text: Column) -> Column:
    """Only texts of a known shape reach a date parser. Each step names its input once, which keeps the generated code of a
    stage small.
    """
    named = _rewritten(F.lower(text), NAMED_REWRITES, r"^\d{4}-[a-z]{3}-\d{1,2}$")
    numeric = _rewritten(text, NUMERIC_REWRITES, r"^\d{4}-\d{1,2}-\d{1,2}$")
    return (
        F.when(text.rlike(ISO), F.try_to_date(text, "yyyy-MM-dd"))
        .when(
            text.rlike("[a-zA-Z]{3}"),
            F.try_to_date(F.initcap(F.replace(named, F.lit("-"), F.lit(" "))), "yyyy MMM d"),
        )
        .otherwise(F.try_to_date(numeric, "yyyy-M-d"))
    )


def parse_date_uniform(text: Column, layout: str = "yyyy-MM-dd") -> Column:
    """One layout for the whole column; anything else is NULL."""
    return F.try_to_date(text, layout)


def make_full_date(year: Column, month: Column, day: Column) -> Column:
    """'YYYY-MM-DD' text of three numbers; NULL where they are no date."""
    parts = F.concat_ws("-", year.cast("string"), month.cast("string"), day.cast("string"))
    return F.date_format(F.try_to_date(parts, "yyyy-M-d"), "yyyy-MM-dd")


def sale_instant(year: Column, month: Column, day: Column, time_of_day: Column) -> Column:
    """Zone-free timestamp of three numbers and an 'HH:mm:ss' text; NULL where they are none.

    A missing time of day is midnight. No text is made on the way.
    """
    parts = F.split(time_of_day, ":")
    whole = time_of_day.rlike(r"^\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,6})?)?$")
    hour, minute, second = (F.get(parts, F.lit(n)) for n in range(3))
    exact = F.try_make_timestamp_ntz(
        year, month, day, hour.try_cast("int"), minute.try_cast("int"), F.coalesce(second, F.lit("0")).try_cast("decimal(16,6)")
    )
    midnight = F.try_make_timestamp_ntz(year, month, day, F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"))
    return F.when(time_of_day.isNull(), midnight).when(whole, exact)
