"""Joins with a table of one row a key, safe for keys that many rows share."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than this share of the counted rows, so at most this many keys are.
HOT_SHARE = 1000


def look_up(rows: DataFrame, table: DataFrame, keys: list[str], hot: Column, spread: Column) -> DataFrame:
    """rows left-joined with ``table``, which has one row for each value of ``keys``.

    ``hot`` picks rows of table whose number and size the caller bounds
    (``HOT_SHARE`` short keys): they are broadcast. All other keys are
    shuffled; rows that a hot key has served are spread by ``spread`` (a
    long) there, so that they meet in no task. Null keys equal each other.
    The other columns of table must have names that rows doesn't have.
    """
    values = [c for c in table.columns if c not in keys]
    named = {k: f"__k{i}" for i, k in enumerate(keys)}
    part = lambda which, tag: table.where(which).select(
        *[F.col(k).alias(n) for k, n in named.items()], F.struct(*values).alias(tag)
    )
    on = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in named.items()])
    met = rows.join(F.broadcast(part(hot, "__hot")), on, "left").drop(*named.values())
    met = met.withColumn("__spread", F.when(F.col("__hot").isNull(), F.lit(0).cast("long")).otherwise(spread))
    cold = part(~hot, "__cold").withColumn("__zero", F.lit(0).cast("long"))
    out = met.join(cold, on & (F.col("__spread") == F.col("__zero")), "left")
    found = F.coalesce("__hot", "__cold")
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], *[found[v].alias(v) for v in values])
