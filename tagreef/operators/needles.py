"""Match many needles against many rows without comparing all pairs.

A needle can only match a row that holds all of the needle's *keys* (characters
of a keyword, content-defined pieces of a payload). Each needle is filed under
the one key that the fewest rows hold; rows meet needles by an equi-join on that
key, and the real predicate runs on those candidates only. Nothing is dropped:
any single key is a necessary condition, so every match is among the candidates.

Rows are never shuffled. Needles are broadcast in slices of a checked size; a
set of any size is answered exactly, with one scan per slice. A key that a third
of the rows hold only means more candidates in each scan task, not a hot task.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagreef.operators.sizes import BROADCAST_BYTES, broadcast_if_small, table_bytes
from tagreef.shared import saved

SLICE_BYTES = BROADCAST_BYTES


def _slices_needed(table: DataFrame, slice_bytes: int) -> int:
    return -(-table_bytes(table) // slice_bytes)


def _slices(table: DataFrame, by: str, n: int) -> list[DataFrame]:
    if n <= 1:
        return [table] * n
    return [table.filter(F.pmod(F.xxhash64(by), F.lit(n)) == i) for i in range(n)]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def match_needles(
    rows: DataFrame,
    needles: DataFrame,
    row_keys: Column,
    needle_keys: Column,
    verify: Column,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame | None:
    """All ``(row columns, needle columns, needle_id)`` for which ``verify`` holds.

    ``needles`` has distinct rows identified by the string column ``needle``, and
    column names other than those of ``rows``; it is read several times. A needle
    is known by its SHA-256, ``needle_id``, until the last step: it may be a whole
    image. ``row_keys`` and ``needle_keys`` are arrays of distinct strings; a
    needle without keys never matches. None when there are no needles.
    """
    by_key = F.xxhash64("_text").alias("_key")
    needles = needles.withColumn("needle_id", F.sha2("needle", 256))
    wanted = needles.select("needle_id", F.explode(needle_keys).alias("_text")).select(
        "needle_id", by_key, F.col("_text").alias("_filed")
    )
    distinct_keys = wanted.select("_key").distinct()
    row_key = rows.select(F.explode(row_keys).alias("_text")).select(by_key)

    n = _slices_needed(distinct_keys, slice_bytes)
    if n == 0:
        return None
    counts = _union(
        [
            row_key.join(F.broadcast(part), "_key", "left_semi").groupBy("_key").count()
            for part in _slices(distinct_keys, "_key", n)
        ]
    )
    # One row per key: small for characters, so that a key that most needles hold
    # gathers in no task; where it is large, adaptive execution splits such a key.
    counts = broadcast_if_small(saved(counts))
    # A key that no row holds has no count: its needles match nothing.
    rarest = F.min(F.struct("count", "_key", "_filed")).alias("_best")
    filed = (
        wanted.join(counts, "_key", "left")
        .withColumn("count", F.coalesce("count", F.lit(0)))
        .groupBy("needle_id")
        .agg(rarest)
        .filter(F.col("_best.count") > 0)
        .select("needle_id", "_best._key", "_best._filed")
        .join(needles, "needle_id")
    )
    # The counting scan runs once: the filed needles are used by every slice.
    filed = saved(filed)
    n = _slices_needed(filed, slice_bytes)
    if n == 0:
        return None
    keyed = rows.withColumn("_text", F.explode(row_keys)).withColumn("_key", F.xxhash64("_text"))
    # The key itself is compared too: a row's other key of the same hash must not
    # bring the same match twice.
    verify = (F.col("_text") == F.col("_filed")) & verify
    return _union(
        [
            keyed.join(F.broadcast(part), "_key").filter(verify).drop("_key", "_text", "_filed")
            for part in _slices(filed, "needle_id", n)
        ]
    )
