"""Latest/earliest per key and running totals that survive hot keys.

``latest_by_key`` and ``earliest_by_key`` are aggregates, so copies of a key are
combined before the shuffle. ``running`` cuts the rows of a hot key into slices
of consecutive rows, totals each slice, and carries the totals forward, so that
no task ever holds a whole hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_ROWS = 1_000_000

TOTALS = {"sum": F.sum, "min": F.min, "max": F.max}
_COMBINE = {
    "sum": lambda a, b: a + F.coalesce(b, F.lit(0)),
    "min": lambda a, b: F.least(a, b),
    "max": lambda a, b: F.greatest(a, b),
}


def _pick_by_key(df: DataFrame, keys: list[str], order: Column, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def _order(order) -> Column:
    if isinstance(order, Column):
        return order
    return F.col(order) if isinstance(order, str) else F.struct(*order)


def latest_by_key(df: DataFrame, keys: list[str], order) -> DataFrame:
    """The row with the greatest ``order`` of each key."""
    return _pick_by_key(df, keys, _order(order), F.max_by)


def earliest_by_key(df: DataFrame, keys: list[str], order) -> DataFrame:
    """The row with the least ``order`` of each key."""
    return _pick_by_key(df, keys, _order(order), F.min_by)


def _sliced(df, keys, slice_on: Column, slice_rows: int, dense: bool) -> DataFrame:
    """Add ``_slice``: consecutive rows of a hot key, null for the rows of an ordinary key.

    Rows without ``slice_on`` sort first and form the slice before all others.
    """
    if dense:
        return df.withColumn("_slice", F.coalesce(F.floor(slice_on / F.lit(slice_rows)), F.lit(-1)))
    # every key above the slice size is cut, however many there are
    hot = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(slice_on).alias("_lo"), F.max(slice_on).alias("_hi"))
        .where(F.col("_n") > slice_rows)
        .withColumn("_width", (F.col("_hi") - F.col("_lo") + 1) / F.ceil(4 * F.col("_n") / slice_rows))
        .select(*keys, F.lit(True).alias("_hot"), "_lo", "_width")
    )
    number = F.coalesce(F.floor((slice_on - F.col("_lo")) / F.col("_width")), F.lit(-1))
    return (
        df.join(hot, keys, "left")
        .withColumn("_slice", F.when(F.col("_hot"), number))
        .drop("_hot", "_lo", "_width")
    )


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    totals: dict[str, tuple[str, Column]],
    slice_on: Column | None = None,
    slice_rows: int = SLICE_ROWS,
    dense: bool = False,
    contributors: DataFrame | None = None,
) -> DataFrame:
    """Add running totals (first row to this row) per key in ``order``.

    ``totals`` maps a new column to (``sum``/``min``/``max``, value). ``order``
    must be unique within a key; keys must not be null. ``slice_on`` is a number
    that never falls along ``order``, null only where ``order`` starts with null
    (default: the first order column); with ``dense`` it counts from 0
    without wide gaps and the keys need not be counted first. ``contributors``
    (dense only) are the rows that add to the totals, where these come cheaper
    than ``df`` as a whole.
    """
    slice_on = F.col(order[0]) if slice_on is None else slice_on
    sliced = _sliced(df, keys, slice_on, slice_rows, dense)
    upto = (
        Window.partitionBy(*keys, "_slice")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = sliced.select("*", *[TOTALS[k](v).over(upto).alias(n) for n, (k, v) in totals.items()])
    earlier = (
        Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    adding = sliced if contributors is None else _sliced(contributors, keys, slice_on, slice_rows, dense)
    per_slice = adding.where(F.col("_slice").isNotNull()).groupBy(*keys, "_slice").agg(
        *[TOTALS[k](v).alias(n) for n, (k, v) in totals.items()]
    )
    carry = per_slice.select(
        *keys, "_slice",
        *[TOTALS[k](F.col(n)).over(earlier).alias(f"_carry_{n}") for n, (k, _) in totals.items()],
    )
    # the window already placed the rows by (keys, _slice): this join moves only the carry
    joined = rows.join(carry, [*keys, "_slice"], "left")
    return joined.select(
        *df.columns,
        *[_COMBINE[k](F.col(n), F.col(f"_carry_{n}")).alias(n) for n, (k, _) in totals.items()],
    )


def ordinal(df: DataFrame, keys: list[str], order: list[str], name: str = "ord", **kw) -> DataFrame:
    """Add the position of each row within its key, from 0."""
    counted = running(df, keys, order, {name: ("sum", F.lit(1).cast("bigint"))}, **kw)
    return counted.withColumn(name, F.col(name) - 1)


def collect_in_order(order: Column | str, *values: str) -> Column:
    """Aggregate to the array of ``values`` by ``order``; use on bounded groups only.

    One value gives an array of it, several give an array of structs.
    """
    key = F.col(order) if isinstance(order, str) else order
    items = F.sort_array(F.collect_list(F.struct(key.alias("_o"), *[F.col(v) for v in values])))
    if len(values) == 1:
        return F.transform(items, lambda x: x[values[0]])
    return F.transform(items, lambda x: F.struct(*[x[v].alias(v) for v in values]))
