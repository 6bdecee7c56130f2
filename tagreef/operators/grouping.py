"""Keyed helpers that hold when one key has a third of the rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Positions concatenated in one go before the pieces of a key meet.
BLOCK = 1024


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order`` (ties broken by the other columns).

    An aggregate, not a window: each task keeps one row per key before the
    shuffle, so a hot key sends one row per task.
    """
    rest = [name for name in df.columns if name not in keys and name not in order]
    row = F.struct(*order, *rest)
    best = df.groupBy(*keys).agg(F.min(row).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def ordered_concat(
    df: DataFrame, keys: list[str], position: str, texts: dict[str, str], sep: str = ""
) -> DataFrame:
    """Join the texts of a key in the order of a whole-number position.

    ``texts`` maps each text column to the name of its result. In two steps:
    blocks of neighbouring positions first, then the blocks of a key, so that the
    rows of a very long key are spread over many tasks.
    """
    block = F.floor(F.col(position) / BLOCK).alias("_block")

    def in_order(order: str) -> Column:
        return F.array_sort(F.collect_list(F.struct(order, *texts))).alias("_rows")

    def joined(name: str) -> Column:
        return F.array_join(F.transform("_rows", lambda row: row[name]), sep)

    blocks = (
        df.groupBy(*keys, block).agg(in_order(position))
        .select(*keys, "_block", *[joined(name).alias(name) for name in texts])
    )
    return (
        blocks.groupBy(*keys).agg(in_order("_block"))
        .select(*keys, *[joined(name).alias(result) for name, result in texts.items()])
    )
