"""Ordered scans that stay parallel when one key holds most of the rows.

A plain window over a key sorts the whole key in one task. Here every key is cut into slices along
the order, each slice is scanned on its own, and only one summary row per (key, slice) is carried
from slice to slice. No task ever sees more than one slice of a key.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import staged

#: Rows a single slice should hold.
ROWS_PER_SLICE = 1_000_000


def in_slices(df: DataFrame, order: list[str], rows_per_slice: int = ROWS_PER_SLICE, out: str = "slice") -> DataFrame:
    """``df``, written once, with ``out``: the number of the run of about ``rows_per_slice`` rows it falls into.

    Runs follow each other along the whole ``order``, so rows that agree in its first columns are still told apart.
    There are as many as the table needs. ``df`` is read three times (to count, to find the cuts, to write).
    """
    runs = max(1, ceil(df.count() / rows_per_slice))
    return staged(df.repartitionByRange(runs, *order).withColumn(out, F.spark_partition_id()))


def _ordering(order: list[str], descending: bool) -> list[Column]:
    return [F.col(o).desc() if descending else F.col(o).asc() for o in order]


def last_before(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    out: str,
    slice_col: str,
    descending: bool = False,
) -> DataFrame:
    """Add ``out``: the nearest non-null ``value`` strictly before each row of its key.

    With ``descending`` the scan runs the other way and finds the nearest value after the row.
    """
    df = df.withColumn("_value", value)
    before = (
        Window.partitionBy(*keys, slice_col)
        .orderBy(*_ordering(order, descending))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    nearest = F.min_by if descending else F.max_by
    position = F.when(F.col("_value").isNotNull(), F.struct(*order))
    across = (
        Window.partitionBy(*keys)
        .orderBy(*_ordering([slice_col], descending))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        df.groupBy(*keys, slice_col)
        .agg(nearest("_value", position).alias("_tail"))
        .withColumn("_carried", F.last("_tail", ignorenulls=True).over(across))
        .drop("_tail")
    )
    return (
        df.withColumn("_near", F.last("_value", ignorenulls=True).over(before))
        .join(carried, [*keys, slice_col])
        .withColumn(out, F.coalesce("_near", "_carried"))
        .drop("_value", "_near", "_carried")
    )


def scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    slice_col: str,
    before: dict[str, Column] | None = None,
    after: dict[str, Column] | None = None,
    greatest_before: dict[str, Column] | None = None,
) -> DataFrame:
    """Several ordered scans over the same key at once; each adds the column it is named by.

    ``before`` and ``after``: the nearest non-null value strictly before or after each row; ``greatest_before``: the greatest
    non-null value strictly before it.
    """
    sides = {"up": (before or {}), "down": (after or {}), "most": (greatest_before or {})}
    df = df.withColumns({f"_{side}_{out}": value for side, values in sides.items() for out, value in values.items()})

    def within(descending: bool):
        return Window.partitionBy(*keys, slice_col).orderBy(*_ordering(order, descending)).rowsBetween(Window.unboundedPreceding, -1)

    def across(descending: bool):
        return Window.partitionBy(*keys).orderBy(*_ordering([slice_col], descending)).rowsBetween(Window.unboundedPreceding, -1)

    ends, carried, near, found = [], {}, {}, {}
    for side, values in sides.items():
        for out in values:
            name = f"_{side}_{out}"
            place = F.when(F.col(name).isNotNull(), F.struct(*order))
            end = {"up": F.max_by(name, place), "down": F.min_by(name, place), "most": F.max(name)}[side]
            ends.append(end.alias(f"{name}_end"))
            fold = F.max if side == "most" else (lambda c: F.last(c, ignorenulls=True))
            carried[f"{name}_carried"] = fold(F.col(f"{name}_end")).over(across(side == "down"))
            near[f"{name}_near"] = fold(F.col(name)).over(within(side == "down"))
            pick = F.greatest if side == "most" else F.coalesce
            found[out] = pick(F.col(f"{name}_near"), F.col(f"{name}_carried"))
    summary = df.groupBy(*keys, slice_col).agg(*ends).withColumns(carried).select(*keys, slice_col, *carried)
    kept = [c for c in df.columns if not any(c.startswith(f"_{side}_") for side in sides)]
    return df.withColumns(near).join(summary, [*keys, slice_col]).select(*kept, *(v.alias(k) for k, v in found.items()))


def running_total(
    df: DataFrame, keys: list[str], order: list[str], amount: Column, out: str, slice_col: str, total: str | None = None
) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over the key up to and including each row.

    With ``total`` the sum over the whole key is added too, from the same slice summary.
    """
    df = df.withColumn("_amount", amount)
    upto = Window.partitionBy(*keys, slice_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(*keys).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        df.groupBy(*keys, slice_col)
        .agg(F.sum("_amount").alias("_sum"))
        .withColumn("_carried", F.coalesce(F.sum("_sum").over(across), F.lit(0)))
    )
    if total:
        whole = Window.partitionBy(*keys).orderBy(slice_col).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
        carried = carried.withColumn(total, F.sum("_sum").over(whole))
    carried = carried.drop("_sum")
    return (
        df.withColumn("_near", F.sum("_amount").over(upto))
        .join(carried, [*keys, slice_col])
        .withColumn(out, F.col("_near") + F.col("_carried"))
        .drop("_amount", "_near", "_carried")
    )


def positions(df: DataFrame, order: list[str], out: str, slices: list[str], total: str | None = None) -> DataFrame:
    """Add ``out``: the 0-based position of each row in the total order given by ``order``.

    ``slices`` are columns of ``df`` that cut the order into consecutive runs. Rows are numbered inside
    their run; run sizes, one row per run, supply the offset and, if asked for, the ``total``.
    """
    within = Window.partitionBy(*slices).orderBy(*order)
    earlier = Window.orderBy(*slices).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(*slices).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = df.groupBy(*slices).agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    if total:
        starts = starts.withColumn(total, F.sum("_n").over(everything))
    return (
        df.withColumn("_rank", F.row_number().over(within))
        .join(starts.drop("_n"), slices)
        .withColumn(out, F.col("_start") + F.col("_rank") - 1)
        .drop("_rank", "_start")
    )
