"""Semi-joins by a Bloom filter of fixed size: rows that cannot be wanted stay out of a shuffle.

The filter has ``BITS`` bits whatever the number of keys, so what is collected and sent to the tasks is
bounded; with very many keys it lets more rows through, and never holds back a wanted one. It
only thins the input of an exact join that follows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

BITS = 1 << 26


def key_filter(keys: DataFrame, key: Column) -> np.ndarray:
    """The filter over a long ``key``, two bits each, as 64-bit words."""
    places = F.transform(F.array(key, F.shiftright(key, 32)), lambda p: p.bitwiseAND(F.lit(BITS - 1)))
    words = (
        keys.select(F.explode(places).alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        .toArrow()
    )
    found = np.zeros(BITS // 64, dtype=np.int64)
    found[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return found


def passes(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    hit = np.ones(len(keys), dtype=bool)
    for place in (keys & (BITS - 1), (keys >> 32) & (BITS - 1)):
        hit &= (filter_[place >> 6] >> (place & 63)) & 1 == 1
    return hit


def thinned(df: DataFrame, key: Column, filter_: np.ndarray) -> DataFrame:
    """``df`` without rows whose ``key`` the filter rules out."""
    names = df.columns

    def run(batches):
        for batch in batches:
            rows = np.flatnonzero(passes(filter_, batch.column(0).to_numpy()))
            yield batch.select(names).take(rows)

    return df.select(key.alias("_bloom_key"), *names).mapInArrow(run, df.schema)
