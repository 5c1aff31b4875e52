"""Lookup joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed

#: A key with at least this many rows is joined apart from the rest.
HOT_ROWS = 1_000_000
#: At most this many keys, those with the most rows, are treated as hot, which bounds what is broadcast whatever the
#: data. A key left out has less than this part of all rows: no more than its share of a join of as many partitions.
HOT_KEYS = 20_000


def hottest(counts: DataFrame, n: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Of a table of keys and their numbers of rows ``n`` the keys with ``hot_rows`` or more, at most HOT_KEYS; None if
    there are none. The keys are stored, not collected: the driver learns only whether there are any."""
    hot = counts.where(F.col(n) >= hot_rows)
    return None if hot.isEmpty() else checkpointed(hot.orderBy(F.desc(n)).limit(HOT_KEYS).drop(n))


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The keys of ``df`` with ``hot_rows`` rows or more, at most HOT_KEYS of them; None if there are none.

    Counting combines on the map side, so a hot key costs one row per task. Null keys never match and are left out.
    """
    present = df
    for k in keys:
        present = present.where(F.col(k).isNotNull())
    return hottest(present.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")), "__n", hot_rows)


def lookup_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left", hot_rows: int = HOT_ROWS, hot: DataFrame | None | str = "find") -> DataFrame:
    """``big`` joined to ``small``, which holds each key at most once; ``how`` is 'left' or 'inner'.

    Rows of hot keys meet a broadcast of just those keys' rows (at most HOT_KEYS, one row each), so they keep the
    partitions they are in; all other rows take the ordinary shuffled join. The result is that of the plain join.
    ``hot`` may give the hot keys when the caller knows them already.
    """
    keys = list(keys)
    if isinstance(hot, str):
        hot = hot_keys(big, keys, hot_rows)
    if hot is None:
        return big.join(small, keys, how)
    hot = F.broadcast(hot)
    warm = big.join(hot, keys, "left_semi").join(F.broadcast(small.join(hot, keys, "left_semi")), keys, how)
    return big.join(hot, keys, "left_anti").join(small, keys, how).unionByName(warm)
