"""A bit table of values: a filter of bounded size that misses none of them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a table for each value, and in all (powers of two).
BITS_PER_VALUE, LEAST_BITS, MOST_BITS = 16, 1 << 21, 1 << 27


def slots(v: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of non-negative values in a bit table."""
    return v % bits, v // bits % bits


def bit_table(values: DataFrame, bits: int) -> np.ndarray:
    """A table of fixed size (``bits``, a power of two) with two bits set for
    each value of the one long column (not negative): goes along with a scan
    that is to hand on only rows a later join may need. At most bits / 64 rows
    reach the driver, whatever the number of values."""
    v = F.col(values.columns[0])
    places = F.array(v % bits, F.shiftright(v, bits.bit_length() - 1) % bits)
    words = (values.select(F.explode(places).alias("s")).groupBy(F.floor(F.col("s") / 64).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("b")).toArrow())
    table = np.zeros(bits // 64, np.int64)
    table[words["w"].to_numpy()] = words["b"].to_numpy()
    return table


def in_table(table: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Which values may be in the table; none that is in it is missed."""
    one, two = slots(v, table.size * 64)
    has = lambda s: (table[s >> 6] >> (s & 63)) & 1
    return (has(one) & has(two)).astype(bool)


def sized_table(values: DataFrame) -> np.ndarray:
    """A bit table of the one column, sized by its rows up to ``MOST_BITS``."""
    bits = 1 << (BITS_PER_VALUE * values.count()).bit_length()
    return bit_table(values, min(MOST_BITS, max(LEAST_BITS, bits)))


def key_value(*keys: str) -> Column:
    """A key as a value of a bit table; nulls count like any other."""
    return F.xxhash64(*keys).bitwiseAND(F.lit((1 << 62) - 1))


def may_be_in(table: np.ndarray) -> Callable[[Column], Column]:
    """Tells of a value whether it may be in the table, as a column."""
    @F.arrow_udf("boolean")
    def maybe(v: pa.Array) -> pa.Array:
        return pa.array(in_table(table, v.to_numpy()))
    return maybe
