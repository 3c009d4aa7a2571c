"""Wide <-> long reshapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_effects.functions import code_to_name


def melt_measures(
    df: DataFrame,
    ids: Sequence[str],
    measures: Sequence[str] | Mapping[str, str],
    var_name: str = "subject",
    value_name: str = "grade",
    keep_nulls: bool = False,
    stay: bool = False,
) -> DataFrame:
    """Wide measure columns -> (var_name, value_name) rows.

    ``DataFrame.unpivot`` plans as one ``Expand`` (no shuffle) but keeps NULL
    values, unlike SQL UNPIVOT, so NULLs are dropped explicitly.  A mapping
    renames codes to names on the way (simple CASE; unknown code -> NULL).
    ``stay`` explodes each row instead: an ``Expand`` forgets how its rows were dealt,
    and a grouping by the same keys would deal the long rows again.
    """
    cols = list(measures.keys()) if isinstance(measures, Mapping) else list(measures)
    if stay:
        cells = F.array(*[F.struct(F.lit(c).alias("_code"), F.col(c).alias(value_name)) for c in cols])
        long = df.select(*ids, F.inline(cells))
    else:
        long = df.unpivot(list(ids), cols, "_code", value_name)
    if not keep_nulls:
        long = long.filter(F.col(value_name).isNotNull())
    name = code_to_name("_code", measures) if isinstance(measures, Mapping) else F.col("_code")
    return long.select(*ids, name.alias(var_name), value_name)


def pivot_wide(
    df: DataFrame,
    index: Sequence[str],
    column: str,
    value: str,
    values: Sequence[str],
    drop_incomplete: bool = True,
) -> DataFrame:
    """One column per value of ``column`` (listed up front, so no extra
    distinct pass), one row per ``index``; optionally drop rows missing any."""
    out = df.groupBy(*index).pivot(column, list(values)).agg(F.first(value))
    if drop_incomplete:
        out = out.na.drop(subset=list(values))
    return out
