"""Keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(spec) -> Column:
    """``"c"`` -> c ASC NULLS LAST; ``("c", "desc")`` -> c DESC NULLS LAST."""
    if isinstance(spec, Column):
        return spec
    if isinstance(spec, str):
        return F.col(spec).asc_nulls_last()
    name, direction = spec
    return F.col(name).desc_nulls_last() if direction == "desc" else F.col(name).asc_nulls_last()


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence, rn_col: str = "_rn", deal: bool = False) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order`` (nulls last).

    ``row_number() == 1`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the shuffle, so each map task ships at most one row per key: a hot
    key is reduced map-side and never lands whole in one task.

    ``deal``, for scans, which are cheap to read twice and whose tasks may hold
    millions of narrow rows: rows whose first key is known are dealt by their keys
    before they are sorted, so no map task sorts or spills what it read.  Rows
    whose first key is null can be many of one key and are reduced map-side.  Both
    parts are dealt alike: a grouping by the keys needs no further shuffle.  The
    dealt rows are sorted by a hash of the keys before the keys, which settles most
    comparisons.
    """
    def first(rows: DataFrame, *by: str) -> DataFrame:
        w = Window.partitionBy(*by, *keys).orderBy(*[_order(o) for o in order])
        return rows.withColumn(rn_col, F.row_number().over(w)).filter(F.col(rn_col) == 1).drop(rn_col, *by)

    if not deal:
        return first(df)
    lead, by = F.col(keys[0]), "_key_hash"
    known = df.where(lead.isNotNull()).repartition(*keys).withColumn(by, F.xxhash64(*keys))
    return first(known, by).unionByName(first(df.where(lead.isNull())))


def min_per_key(df: DataFrame, key: str | Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Lowest ``value`` per key -- a partial/final hash aggregate."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.min(value).alias(out or value))
