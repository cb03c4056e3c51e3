"""Joining a large table to a keyed table when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.common import as_list
from shelfmark.session import materialize

# A key with more than 1/HOT_KEYS of all rows is hot, so there are fewer than
# HOT_KEYS hot keys whatever the data: that is the bound of the broadcast.
HOT_KEYS = 10_000

# Rows of a narrow table (a key, a word, a number) that may be broadcast.
NARROW_ROWS = 250_000


def keyed_lookup(
    facts: DataFrame,
    keyed: DataFrame,
    key: str | list[str],
    counts: DataFrame,
    hot_keys: int = HOT_KEYS,
    broadcast_facts: int = 0,
) -> DataFrame:
    """Inner join of ``facts`` to ``keyed`` (unique on ``key``), safe under skew.

    ``counts`` holds the key and ``n``, the rows of each key in ``facts``. Hot keys take
    the broadcast branch and are never shuffled; the others each hold less than
    ``1/hot_keys`` of the rows and take the shuffle branch. The counts are stored first:
    a broadcast that had to wait for them could run into its time limit.

    A caller whose facts are narrow can allow that up to ``broadcast_facts`` rows of them
    are broadcast instead; the keyed table is then only scanned.
    """
    key = as_list(key)
    counts = materialize(counts, "key-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    if total <= broadcast_facts:
        return keyed.join(F.broadcast(facts), key)
    hot = counts.where(F.col("n") > total / hot_keys).select(*key)
    hot_rows = materialize(keyed.join(F.broadcast(hot), key, "left_semi"), "hot-keys")
    warm = facts.join(F.broadcast(hot_rows), key)
    cold = facts.join(F.broadcast(hot), key, "left_anti").join(keyed, key)
    return warm.unionByName(cold)
