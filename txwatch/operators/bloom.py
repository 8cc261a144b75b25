"""A Bloom filter as an expression: rows that cannot match go before their shuffle.

The filter is an array of 64-bit words made by one aggregation (``bit_or`` per word) and used
as a scalar subquery, so it never passes through the driver's code and the plan stays lazy.
Its size is fixed: what is sent to the tasks does not grow with the data.  With more keys
than it has room for it lets more rows pass and is still right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a filter (1 MB, good for about 800,000 keys) and hash functions.
WORDS, HASHES = 1 << 17, 4


def _places(keys: list[str], words: int) -> list[Column]:
    """Bit numbers of a key: two hashes give all of them."""
    own = [F.col(k) for k in keys]
    a, b = F.xxhash64(*own), F.xxhash64(*own, F.lit(1))
    # halves of the hashes, so that no sum overflows
    a, b = F.shiftrightunsigned(a, 2), F.shiftrightunsigned(b, 8)
    return [F.pmod(a + F.lit(i) * b, F.lit(64 * words)) for i in range(HASHES)]


def filter_of(keys: DataFrame, words: int = WORDS) -> DataFrame:
    """One row, one column: the filter's words, over all columns of ``keys``."""
    bit = F.explode(F.array(*_places(keys.columns, words)))
    own = keys.select(bit.alias("bit")).select(
        F.shiftright("bit", 6).alias("word"),
        F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("bits"))
    none = keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    each = own.unionByName(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return each.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("words"))


def may_hold(bloom: DataFrame, keys: list[str], words: int = WORDS) -> Column:
    """False for keys that are certainly not in the filter."""
    table, held = bloom.scalar(), F.lit(True)
    for bit in _places(keys, words):
        word = F.get(table, F.shiftright(bit, 6).cast("int"))
        own = F.call_function("shiftrightunsigned", word, (bit % 64).cast("int"))
        held = held & (own.bitwiseAND(F.lit(1).cast("bigint")) == 1)
    return held
