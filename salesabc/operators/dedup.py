"""Keep-last deduplication (W4, W5) as an aggregate.

Spark has no row order, so "last" is always relative to explicit
order columns (source rank, then ingest position).  Written as
``max_by`` or ``max`` of a struct instead of ``row_number`` over a window: the aggregate keeps
one candidate per key per task before the shuffle (partial aggregation),
so a key holding a large share of the rows is reduced map-side instead
of being sorted inside one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesabc.session import written


def keep_last(df: DataFrame, keys: list[str], order: Column | list[str]) -> DataFrame:
    """Last row per key in ``order`` as an aggregate (map-side combined).

    ``max_by`` over a struct of the other columns keeps one candidate per
    key per task before the shuffle, so a hot key never gathers its rows
    in one place.

    ``order`` may name columns, compared in turn.  The candidate is then the
    greatest struct that begins with them, so they are shuffled once and not
    beside themselves; rows equal in all of them are told apart by the other columns.
    """
    others = [c for c in df.columns if c not in keys]
    if isinstance(order, list):
        fields = [*order, *(c for c in others if c not in order)]
        last = F.max(F.struct(*[F.col(f"`{c}`") for c in fields]))
    else:
        last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), order)
    best = df.groupBy(*keys).agg(last.alias("_last"))
    return best.select(*keys, *[F.col("_last")[c].alias(c) for c in others])


def keep_last_of_stored(df: DataFrame, keys: list[str], order: Column | list[str]) -> DataFrame:
    """The same rows for a stored table, whose columns can be read one by one; keys without nulls.

    Keys that repeat are found first, by a hash aggregate over the key columns
    alone, and written: the size of a stored table is known before the joins
    are planned, whereas one measured while they run has both sides shuffled
    by then.  Rows of all other keys pass as they are, neither sorted nor
    shuffled while the file of repeated keys is under Spark's broadcast
    threshold; only rows of repeated keys are aggregated.
    """
    found = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*[F.col(k).alias(f"_{k}") for k in keys])
    repeated = written(found, "repeated")
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    return df.join(repeated, same, "left_anti").unionByName(keep_last(df.join(repeated, same, "left_semi"), keys, order))
