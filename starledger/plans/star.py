"""The star schema that views and queries read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from starledger.operators import skew
from starledger.operators.joins import key_lookup, lookup_scalar, store_lookup, the_store_key
from starledger.operators.skew import KeyProfile


@dataclass(frozen=True)
class Star:
    """Fact and dimensions. A plan reads only the columns it names, whatever else is here."""

    orders: DataFrame
    product: DataFrame | None = None
    store: DataFrame | None = None
    users: DataFrame | None = None
    card: DataFrame | None = None
    date_times: DataFrame | None = None
    currency: DataFrame | None = None
    currency_conversion: DataFrame | None = None


@dataclass(frozen=True)
class _Lookup:
    """What a natural key of the fact leads to: ``frame`` has a row per key, ``found`` what is read off it once joined."""

    natural: str
    frame: DataFrame
    found: dict[str, Column]
    small: bool


def _lookups(star: Star) -> list[_Lookup]:
    """Those of the five dimensions with natural keys, in the order of the joins, each weighed once."""

    def by_key(dim: DataFrame, natural: str, surrogate: str) -> _Lookup:
        pairs = dim.select(natural, surrogate)
        frame = key_lookup(pairs, natural, surrogate).withColumnRenamed(surrogate, "_key")
        return _Lookup(natural, frame, {f"_found_{surrogate}": F.col("_key")}, skew.measured_small(pairs))

    stores = _Lookup(
        "store_code",
        store_lookup(star.store),
        {"_found_store_key": the_store_key(), "_found_country_code": F.col("_country")},
        skew.measured_small(star.store.select("store_code", "store_key", "country_code")),
    )
    return [
        by_key(star.card, "card_number", "card_key"),
        by_key(star.date_times, "date_uuid", "date_key"),
        by_key(star.product, "product_code", "product_key"),
        stores,
        by_key(star.users, "user_uuid", "user_key"),
    ]


#: So many large dimensions are joined to whole sales; with more, sales are numbered and the keys brought back to them.
MOST_WHOLE = 2


def resolve_keys(star: Star, row: str, parts: Sequence[DataFrame] | None = None) -> list[DataFrame]:
    """The fact with all its surrogate keys, in ``parts`` of ``star.orders`` that add up to it, by default one.

    ``row`` names a column of the fact that tells its rows apart, and has to be the same at every read; it is left out.
    Small dimensions are broadcast. Where more than ``MOST_WHOLE`` are large, whole sales are shuffled once, by ``row``;
    the lookups shuffle (row, natural key) and give (row, key) back, so no text goes along to the lookup of another.
    Heavy natural keys are counted on the fact as it came, in one pass. Sales without a match keep the key they had,
    and lose their country. The country comes before the currency, which is looked up by it, and with the store.
    """
    lookups = _lookups(star)
    profile = KeyProfile(star.orders, *[lookup.natural for lookup in lookups])
    numbered = sum(not lookup.small for lookup in lookups) > MOST_WHOLE
    return [_resolved(part, star, row, lookups, profile, numbered) for part in parts or [star.orders]]


def _resolved(
    part: DataFrame, star: Star, row: str, lookups: Sequence[_Lookup], profile: KeyProfile, numbered: bool
) -> DataFrame:
    fact = part
    for lookup in lookups:
        natural, frame = lookup.natural, lookup.frame
        if numbered and not lookup.small:
            asked = part.select(row, natural).where(F.col(natural).isNotNull())
            answers = skew.salted_join(asked, frame, natural, "inner", profile)
            fact = fact.join(answers.select(row, *[c.alias(name) for name, c in lookup.found.items()]), row, "left")
            continue
        if lookup.small:
            joined = fact.join(F.broadcast(frame), natural, "left")
        else:
            joined = skew.salted_join(fact, frame, natural, "left", profile)
        fact = joined.select(*fact.columns, *[c.alias(name) for name, c in lookup.found.items()])
    keys = [f"{name}_key" for name in ("card", "date", "product", "store", "user")]
    resolved = fact.withColumns(
        {k: F.coalesce(f"_found_{k}", k) for k in keys} | {"country_code": F.col("_found_country_code")}
    )
    columns = [c for c in part.columns if c != row]
    return lookup_scalar(resolved.select(*columns), star.currency, "country_code", "currency_key").select(*columns)
