"""A filter of fixed size for the keys of a table: rows that can't match need not be shuffled."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter, whatever the table holds, and those that a key sets.
BITS, KEY_BITS = 1 << 24, 3
#: Bits in one row on the way to the driver.
_ROW = 1 << 14


def may_be_among(keys: DataFrame, key: str) -> "callable":
    """A function of a long column that tells whether its value may be among the keys: never false of one that is.

    The filter has BITS bits (2 MB) at every size. With very many keys it lets all rows through, and a join after
    it shuffles them all: results don't depend on it.
    """
    at = F.explode(F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BITS)) for i in range(KEY_BITS)]))
    bits = keys.select(at.alias("p")).groupBy(F.floor(F.col("p") / 64).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("x"))
    table = np.zeros(BITS // 64, dtype=np.int64)
    found = bits.toArrow()
    table[found["w"].to_numpy()] = found["x"].to_numpy()
    held = keys.sparkSession.sparkContext.broadcast(table.view(np.uint8))

    @F.pandas_udf("boolean")
    def test(*places: pd.Series) -> pd.Series:
        table, out = held.value, True
        for p in places:
            p = p.to_numpy()
            out = out & ((table[p >> 3] >> (p & 7)) & 1).astype(bool)
        return pd.Series(out)

    def apply(column: Column) -> Column:
        return test(*[F.pmod(F.xxhash64(column, F.lit(i)), F.lit(BITS)) for i in range(KEY_BITS)])

    return apply
