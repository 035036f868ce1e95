"""Key resolution and frame merging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starledger.operators.skew import KeyProfile, attach, salted_join


def key_lookup(dim: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """One surrogate key per natural key: the lowest."""
    return (
        dim.where(F.col(natural).isNotNull())
        .groupBy(natural)
        .agg(F.min(surrogate).alias(surrogate))
    )


def resolve_fk(
    fact: DataFrame,
    dim: DataFrame,
    natural: str,
    surrogate: str,
    dim_natural: str | None = None,
    profile: KeyProfile | None = None,
) -> DataFrame:
    """Fill ``surrogate`` from the dimension row with the same natural key.

    Never multiplies fact rows. Facts without a match keep the key they had (NULL if
    the column is new).
    """
    found = f"_found_{surrogate}"
    pairs = dim.select(F.col(dim_natural or natural).alias(natural), surrogate)
    lookup = key_lookup(pairs, natural, surrogate).withColumnRenamed(surrogate, found)
    joined = attach(fact, lookup, natural, "left", profile, bound=pairs)
    if surrogate in fact.columns:
        value = F.coalesce(F.col(found), F.col(surrogate))
        order = fact.columns
    else:
        value = F.col(found)
        order = [*fact.columns, surrogate]
    return joined.withColumn(surrogate, value).select(*order)


def lookup_scalar(
    fact: DataFrame, dim: DataFrame, key: str, value: str, profile: KeyProfile | None = None
) -> DataFrame:
    """Set ``value`` to that of the one dimension row with this key, NULL without one.

    Two dimension rows for a key that a fact uses fail the job.
    """
    lookup = (
        dim.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(value).alias("_value"), F.count(F.lit(1)).alias("_matches"))
    )
    order = [c for c in fact.columns if c != value] + [value]
    ambiguous = F.raise_error(F.concat(F.lit(f"more than one {value} for {key} "), F.col(key).cast("string")))
    return (
        attach(fact.drop(value), lookup, key, "left", profile, bound=dim.select(key, value))
        .withColumn(value, F.when(F.col("_matches") > 1, ambiguous).otherwise(F.col("_value")))
        .select(*order)
    )


def store_lookup(store: DataFrame) -> DataFrame:
    """(store_code, _key, _country, _matches): one row per store code, and how many stores have it."""
    code = "store_code"
    return (
        store.where(F.col(code).isNotNull())
        .groupBy(code)
        .agg(
            F.min("store_key").alias("_key"), F.min("country_code").alias("_country"),
            F.count(F.lit(1)).alias("_matches"),
        )
    )


def the_store_key() -> Column:
    """The key found in ``store_lookup``; two stores with a code that a sale uses fail the job."""
    ambiguous = F.raise_error(F.concat(F.lit("more than one store for store_code "), F.col("store_code").cast("string")))
    return F.when(F.col("_matches") > 1, ambiguous).otherwise(F.col("_key"))


def link_currency_rate(currency: DataFrame, conversion: DataFrame) -> DataFrame:
    """Rate key of every currency by its code; currencies without a rate keep theirs."""
    return resolve_fk(currency, conversion, "currency_code", "currency_conversion_key")


def fill_unknown_keys(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Missing keys point to the 'Unknown' member.

    A NULL key can exist in no dimension, so no join is needed to know it is unmatched.
    """
    return fact.withColumns({k: F.coalesce(F.col(k), F.lit(0).cast("long")) for k in keys})


def merge_frames(how: str, first: DataFrame, second: DataFrame) -> DataFrame:
    """Join on all common columns; missing values match each other.

    ``how`` is left, right, inner or outer. Columns of the first frame come first. A right
    join is a left join with the sides exchanged, an outer one adds the unmatched rows of
    the second frame; so every form splits the heavy keys of the side it keeps.
    """
    common = [c for c in first.columns if c in second.columns]
    if not common:
        raise ValueError("no common columns to merge on")
    order = [*first.columns, *[c for c in second.columns if c not in common]]
    if how in ("left", "inner"):
        return salted_join(first, second, common, how, null_safe=True).select(*order)
    if how == "right":
        return salted_join(second, first, common, "left", null_safe=True).select(*order)
    if how == "outer":
        matched = salted_join(first, second, common, "left", null_safe=True).select(*order)
        known = first.select(*[F.col(c).alias(f"_first_{c}") for c in common]).distinct()
        same = reduce(
            lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_first_{c}")) for c in common]
        )
        # One row per key on both sides of the anti join; the rows of a key follow by a salted join.
        lone = second.select(*common).distinct().join(known, same, "left_anti")
        unmatched = salted_join(second, lone, common, "inner", null_safe=True)
        return matched.unionByName(unmatched, allowMissingColumns=True)
    raise ValueError(f"merge_frames does not do {how!r}")
