"""Keep one row per key: the newest version wins (last write wins within Bronze)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: str | Sequence[str], order_by: Sequence[Column],
                complete_tiebreak: bool = True) -> DataFrame:
    """``row_number() over (partition by key order by ...) = 1``.

    ``order_by`` ranks the versions of a key, first wins. Ties are broken by every remaining column
    (ascending) so a rerun picks the same row. NULL keys form one group, as in SQL.

    Plan: Catalyst inserts a partial ``WindowGroupLimit`` (top 1 per key inside each map
    partition) before the shuffle on the key, so a key with many versions is reduced to one row
    per map task before it crosses the network, then a final limit after the exchange.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = list(order_by)
    if complete_tiebreak:
        # Appending a column that is already ranked is harmless: it is never reached.
        order += [F.col(n).asc_nulls_first() for n in df.columns if n not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row_num", F.row_number().over(w)).where(F.col("_row_num") == 1).drop("_row_num")
