"""Personal data in texts, found with column expressions only.

Regular expressions propose spans, validators confirm them (Luhn for cards, mod-97 for account numbers,
ranges and digit counts for the others), and words near a span adjust its score. A span counts
from a score of ``ACCEPT``. The base kinds (email, ip, card, phone) count as soon as
their validator agrees; the further kinds are

* ``iban``: international account numbers whose mod-97 checksum is right,
* ``ssn``: nine digits in groups of 3, 2 and 4, only near words that speak of an identity number,
* ``tel``: ten digits written like a phone number without country code, only near words that speak of a phone.

A span of a further kind that overlaps a base span is not reported. Positions come from the lengths of what
``split`` leaves between the matches, so a text is passed over once per kind and not once per span.
The patterns use possessive groups and look-behinds where the plain form would recurse or scan a long
run of digits or letters again from each of its characters; they match the same spans.

Defined cases: a null text has no spans (and stays null when masked); an empty text has none; repeated
rows are judged row by row; an empty table gives an empty result; other columns, whatever
their names, pass through ``masked`` and are ignored by ``found``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Code points on each side of a span in which context words count.
REACH = 40
ACCEPT = 0.5
CONTEXT_BONUS = 0.3
_BLOCK = 256
#: So many matches at most are in reach: a match has two code points or more.
_NEIGHBOURS = REACH // 2


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _always(value: Column) -> Column:
    return F.lit(True)


def _ip(value: Column) -> Column:
    def part(text: Column) -> Column:
        number = F.ltrim(text, F.lit("0"))
        return (F.length(number) < 3) | ((F.length(number) == 3) & (number <= "255"))

    return F.forall(F.split(value, r"\."), part)


def _card(value: Column) -> Column:
    return F.length(_digits(value)).between(13, 19) & F.coalesce(F.call_function("luhn_check", _digits(value)), F.lit(False))


def _phone(value: Column) -> Column:
    return F.length(_digits(value)).between(9, 15)


def _iban(value: Column) -> Column:
    compact = F.replace(value, F.lit(" "))
    turned = F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(4)))
    # A letter stands for two digits, A for 10.
    number = F.transform(F.split(turned, ""), lambda c: F.ascii(c))
    rest = F.aggregate(
        number,
        F.lit(0),
        lambda total, c: F.when(c >= 65, (total * 100 + c - 55) % 97).otherwise((total * 10 + c - 48) % 97),
    )
    return F.length(compact).between(15, 34) & (rest == 1)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    base: bool = False


# The base kinds, in the order in which they are listed.
BASE_KINDS = [
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        _always, 0.7, r"(?i)\b(e-?mail|mail|contact|write)\b", True,
    ),
    Kind(
        "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        _ip, 0.6, r"(?i)\b(ip|address|host|server|login)\b", True,
    ),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", _card, 0.7, r"(?i)\b(card|visa|credit|debit|payment)\b", True),
    Kind(
        "phone", r"\+[0-9][ ().0-9-]+[0-9]", _phone, 0.6, r"(?i)\b(phone|tel|call|mobile|fax)\b", True,
    ),
]
FURTHER_KINDS = [
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
        _iban, 0.7, r"(?i)\b(iban|account|bank)\b",
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        _always, 0.3, r"(?i)\b(ssn|social security|tax id|identity number)\b",
    ),
    Kind(
        "tel", r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
        _always, 0.3, r"(?i)\b(phone|tel|call|mobile|fax)\b",
    ),
]
KINDS = [*BASE_KINDS, *FURTHER_KINDS]


def _running(values: Column) -> Column:
    """Running totals of an array, by blocks, so that long arrays do not take time by the square.

    A one-element array around an expression binds it once for all uses in the lambda.
    """

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def numbers(n: Column) -> Column:
        return F.sequence(F.lit(0), n)

    def with_values(v: Column) -> Column:
        last = F.floor((F.size(v) - 1) / _BLOCK).cast("int")
        sums = F.transform(numbers(last), lambda b: total(F.slice(v, b * _BLOCK + 1, _BLOCK)))

        def with_sums(s: Column) -> Column:
            before = F.transform(numbers(F.size(s) - 1), lambda b: total(F.slice(s, F.lit(1), b)))
            return F.flatten(
                F.transform(
                    before,
                    lambda start, b: F.transform(
                        F.slice(v, b * _BLOCK + 1, _BLOCK),
                        lambda _, i: start + total(F.slice(v, b * _BLOCK + 1, i + 1)),
                    ),
                )
            )

        return F.transform(F.array(sums), with_sums)[0]

    return F.transform(F.array(values), with_values)[0]


def _surroundings(pair: Column) -> Column:
    """Array of (before, after) of the matches: ``REACH`` code points of the text on each side, neighbouring matches included.

    They are put together from the ends of the pieces and matches around a match, so that a text with many
    matches does not take time by the square.
    """
    n = F.size(pair["m"])
    lefts, rights = F.slice(pair["p"], F.lit(1), n), F.slice(pair["p"], F.lit(2), n)
    ends = F.struct(
        lefts.alias("lefts"), rights.alias("rights"),
        F.zip_with(lefts, pair["m"], lambda p, m: F.right(F.concat(p, m), F.lit(REACH))).alias("until"),
        F.zip_with(pair["m"], rights, lambda m, p: F.left(F.concat(m, p), F.lit(REACH))).alias("since"),
    )

    def near(x: Column) -> Column:
        def sides(left: Column, i: Column) -> Column:
            right = x["rights"][i]
            nearest = F.least(i, F.lit(_NEIGHBOURS))
            earlier = F.when(F.length(left) < REACH, F.array_join(F.slice(x["until"], i - nearest + 1, nearest), "")).otherwise("")
            later = F.when(F.length(right) < REACH, F.array_join(F.slice(x["since"], i + 2, F.lit(_NEIGHBOURS)), "")).otherwise("")
            return F.struct(
                F.right(F.concat(earlier, left), F.lit(REACH)).alias("before"),
                F.left(F.concat(right, later), F.lit(REACH)).alias("after"),
            )

        return F.transform(x["lefts"], sides)

    return F.transform(F.array(ends), near)[0]


def _proposals(text: Column, kind: Kind) -> Column:
    """Array of (start, end, value, before, after), null where the pattern does not occur."""
    pieces = F.split(text, kind.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))

    def located(pair: Column) -> Column:
        n = F.size(pair["m"])
        ends = _running(F.zip_with(F.slice(pair["p"], F.lit(1), n), pair["m"], lambda p, m: F.length(p) + F.length(m)))
        zipped = F.arrays_zip(ends.alias("end"), pair["m"].alias("value"), _surroundings(pair).alias("near"))
        return F.transform(
            zipped,
            lambda x: F.struct(
                (x["end"] - F.length(x["value"])).alias("start"),
                x["end"].alias("end"),
                x["value"].alias("value"),
                x["near"]["before"].alias("before"),
                x["near"]["after"].alias("after"),
            ),
        )

    both = F.array(F.struct(pieces.alias("p"), matches.alias("m")))
    return F.when(text.rlike(kind.pattern), F.transform(both, located)[0])


def _confirmed(proposals: Column, kind: Kind) -> Column:
    """Array of (kind, start, end, value, score) of the proposals that count."""
    scored = F.transform(
        F.filter(proposals, lambda s: kind.valid(s["value"])),
        lambda s: F.struct(
            F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
            (
                F.lit(kind.score)
                + F.when(F.concat_ws(" ", s["before"], s["after"]).rlike(kind.context), CONTEXT_BONUS).otherwise(0.0)
            ).alias("score"),
        ),
    )
    spans = F.filter(scored, lambda s: s["score"] >= ACCEPT)
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,value:string,score:double>>")
    return F.coalesce(spans, empty)


def found(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``doc_id``, ``base`` and ``spans``: the base spans and all spans.

    Both are arrays of (kind, start, end, value, score), by kind in the order of ``KINDS`` and
    then by start; positions are code points and the end is exclusive.
    """
    df = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    df = df.select("doc_id", *[_proposals(F.col("text"), k).alias(k.name) for k in KINDS])
    df = df.select("doc_id", *[_confirmed(F.col(k.name), k).alias(k.name) for k in KINDS])
    df = df.withColumn("base", F.concat(*[F.col(k.name) for k in BASE_KINDS]))

    def apart(s: Column) -> Column:
        return ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    return df.select(
        "doc_id", "base",
        F.concat("base", *[F.filter(k.name, apart) for k in FURTHER_KINDS]).alias("spans"),
    )


def _masked_once(text: Column, kind: Kind) -> Column:
    pieces = F.split(text, kind.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    label = f"[{kind.name.upper()}]"

    def joined(pair: Column) -> Column:
        n = F.size(pair["m"])
        columns = [pair["m"].alias("value"), F.slice(pair["p"], F.lit(1), n).alias("left")]
        if kind.score < ACCEPT:
            columns.append(_surroundings(pair).alias("near"))
        zipped = F.arrays_zip(*columns)

        def shown(x: Column) -> Column:
            counts = kind.valid(x["value"])
            if kind.score < ACCEPT:
                counts &= F.concat_ws(" ", x["near"]["before"], x["near"]["after"]).rlike(kind.context)
            return F.concat(x["left"], F.when(counts, label).otherwise(x["value"]))

        return F.concat(F.array_join(F.transform(zipped, shown), ""), F.element_at(pair["p"], -1))

    both = F.array(F.struct(pieces.alias("p"), matches.alias("m")))
    return F.when(text.rlike(kind.pattern), F.transform(both, joined)[0]).otherwise(text)


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span that counts replaced by its kind, such as ``[EMAIL]``; other columns as they are."""
    return reduce(lambda df, kind: df.withColumn(text, _masked_once(F.col(f"`{text}`"), kind)), KINDS, docs)


def digest(spans: str | Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")
