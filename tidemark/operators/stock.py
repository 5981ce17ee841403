"""Running inventory balances: which movements are refused because the balance would leave INT range.

A movement is refused when the balance it would produce does not fit; later movements then start from
the unchanged balance. For almost every sku the sum of absolute movements proves that nothing can be
refused, and one partially aggregated pass settles it.

Of the remaining skus, those with no more movements than a slice may hold are replayed in order, all in one pass. Longer
ones are cut into slices, each along its own order, so that there are about as many slices as rows ask for, however many
skus there are. Each slice is summed up by three numbers: what it adds, and the
least and the greatest sum of its first movements. They say from which opening balances nothing of the slice is
refused. A scan over the slices of a sku carries the balance along up to the first slice whose opening lies outside
that interval. Only from there on movements are replayed, in order: in the first round one slice of each sku, then two,
four and so on, after which the scan goes on with the exact balance. So no movement is replayed twice, and there are
no more rounds than the logarithm of the number of slices, whatever is refused.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions.ordered import ROWS_PER_SLICE
from tidemark.session import staged


def risky_skus(moves: DataFrame, balances: DataFrame) -> DataFrame:
    """``(sku, opening, moves)`` of the skus whose balance could leave INT range at some point.

    The totals are written, one row per sku, as they are used twice; so the movements are read once.
    """
    totals = staged(moves.groupBy("sku").agg(F.try_sum(F.abs("delta")).alias("_swing"), F.count(F.lit(1)).alias("moves")))
    opening = balances.join(totals.select("sku"), "sku", "left_semi").select("sku", "quantity")
    reach = F.abs(F.col("opening")) + F.col("_swing")
    return (
        totals.join(opening, "sku", "left")
        .withColumn("opening", F.coalesce(F.col("quantity"), F.lit(0)).cast("bigint"))
        .filter(F.col("_swing").isNull() | (F.col("_swing") > S.INT_MAX) | (reach > S.INT_MAX))
        .select("sku", "opening", "moves")
    )


def _seq_parts(df: DataFrame) -> tuple[list[Column], list[str], Column]:
    """``seq`` as plain numeric columns for pandas, their names, and the way back."""
    dtype = df.schema["seq"].dataType
    if not isinstance(dtype, T.StructType):
        return [F.col("seq").alias("s0")], ["s0"], F.col("s0").cast(dtype).alias("seq")
    out, names, back = [], [], []
    for i, field in enumerate(dtype.fields):
        name = f"s{i}"
        value, rebuilt = F.col(f"seq.{field.name}"), F.col(name)
        if isinstance(field.dataType, T.TimestampType):
            value, rebuilt = F.unix_micros(value), F.timestamp_micros(rebuilt)
        out.append(value.cast("bigint").alias(name))
        names.append(name)
        back.append(rebuilt.cast(field.dataType).alias(field.name))
    return out, names, F.struct(*back).alias("seq")


def play(opening: int, deltas: np.ndarray) -> tuple[int, np.ndarray]:
    """Closing balance and an accepted mask for movements applied in order.

    Movements are tried one by one as long as some are refused. Sums of a longer stretch show the first one that is
    refused; stretches grow while nothing is.
    """
    accepted = np.ones(len(deltas), dtype=bool)
    balance, at, stretch = int(opening), 0, 64
    while at < len(deltas):
        if stretch == 64:
            near = deltas[at : at + stretch].tolist()
            refused = []
            for i, delta in enumerate(near, at):
                if S.INT_MIN <= balance + delta <= S.INT_MAX:
                    balance += delta
                else:
                    refused.append(i)
            accepted[refused] = False
            at, stretch = at + len(near), 64 if refused else 128
            continue
        path = balance + np.cumsum(deltas[at : at + stretch])
        outside = (path < S.INT_MIN) | (path > S.INT_MAX)
        first = int(outside.argmax())
        if outside[first]:
            balance = int(path[first - 1]) if first else balance
            accepted[at + first] = False
            at, stretch = at + first + 1, 64
        else:
            balance, at, stretch = int(path[-1]), at + len(path), 2 * stretch
    return balance, accepted


def slice_summaries(tape: DataFrame, order: list[str]) -> DataFrame:
    """``(sku, slice, moved, lowest, highest)``: the sum of a slice and the extremes of the sums of its first movements."""
    upto = Window.partitionBy("sku", "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = tape.withColumn("_upto", F.sum("delta").over(upto))
    return summed.groupBy("sku", "slice").agg(
        F.sum("delta").alias("moved"), F.min("_upto").alias("lowest"), F.max("_upto").alias("highest")
    )


_STATE = "sku string, slice bigint, moved bigint, lowest bigint, highest bigint, first bigint, closing bigint, opening bigint, todo boolean"


def _scan(slices_at_once: int):
    """Carry the balance of a sku over its slices; the first that refuses something and some after it are to be played."""

    def scan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("slice")
        balance, stop = int(group["first"].iloc[0]), len(group)
        for at, (moved, lowest, highest, closing) in enumerate(zip(*(group[c].tolist() for c in ("moved", "lowest", "highest", "closing")), strict=True)):
            if not pd.isna(closing):
                balance = int(closing)
            elif S.INT_MIN <= balance + lowest and balance + highest <= S.INT_MAX:
                balance += moved
            else:
                stop = at
                break
        todo = np.zeros(len(group), dtype=bool)
        todo[stop : stop + slices_at_once] = True
        return group.assign(opening=balance, todo=todo & group["closing"].isna().to_numpy())

    return scan


def _replay(names: list[str]):
    """Rows ``(sku, slice, opening, delta, *names)`` in order -> the refused ones, and a row for each slice's closing balance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, balance = None, 0
        for batch in batches:
            sku, at = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            opening, deltas = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            codes = batch.column(0).dictionary_encode().indices.to_numpy()
            cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (at[1:] != at[:-1])) + 1
            ends, lost = [], np.zeros(len(at), dtype=bool)
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
                if a == b:
                    continue
                key = (sku[a], int(at[a]))
                if key != current:
                    if current is not None:
                        ends.append((*current, balance))
                    if current is None or current[0] != key[0]:
                        balance = int(opening[a])
                    current = key
                balance, accepted = play(balance, deltas[a:b])
                lost[a:b] = ~accepted
            yield _closings(ends)
            refused = batch.filter(pa.array(lost))
            none = pa.nulls(len(refused), pa.int64())
            yield pa.RecordBatch.from_arrays([refused.column(0), refused.column(1), none, *refused.columns[4:]], ["sku", "slice", "closing", *names])
        if current is not None:
            yield _closings([(*current, balance)])

    def _closings(ends: list[tuple[str, int, int]]) -> pa.RecordBatch:
        sku, at, closing = zip(*ends, strict=True) if ends else ((), (), ())
        none = [pa.nulls(len(ends), pa.int64()) for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(sku, pa.string()), pa.array(at, pa.int64()), pa.array(closing, pa.int64()), *none], ["sku", "slice", "closing", *names])

    return run


def _sliced(tape: DataFrame, order: list[str], rows_per_slice: int) -> DataFrame:
    """``tape``, written once, with ``slice``: runs of up to ``rows_per_slice`` rows along ``sku`` and ``order``.

    A task cuts many slices, so tasks grow in number with the rows and not with the slices.
    """
    rows = tape.count()
    cores = tape.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, ceil(rows / ROWS_PER_SLICE), min(ceil(rows / rows_per_slice), cores))
    place = F.monotonically_increasing_id()
    in_task = F.floor(place.bitwiseAND(2**33 - 1) / rows_per_slice)
    ranged = tape.repartitionByRange(tasks, "sku", *order).sortWithinPartitions("sku", *order)
    return staged(ranged.withColumn("slice", F.shiftleft(F.spark_partition_id().cast("bigint"), 33) + in_task))


def refused_moves(
    moves: DataFrame,
    balances: DataFrame,
    rows_per_slice: int = ROWS_PER_SLICE,
    on_round: Callable[[int], None] | None = None,
) -> DataFrame:
    """``seq`` of every movement refused by the running balance.

    ``moves(seq, sku, delta)`` passed the row constraints; ``balances(sku, quantity)`` is the stored table. Each round over
    the slices of long skus tells ``on_round`` how many slices it replays.
    """
    risky = staged(risky_skus(moves, balances))
    parts, names, back = _seq_parts(moves)
    schema = "sku string, slice bigint, closing bigint, " + ", ".join(f"{n} bigint" for n in names)
    delta = F.coalesce("delta", F.lit(0).cast("bigint")).alias("delta")

    def played(rows: DataFrame) -> DataFrame:
        rows = rows.select("sku", "slice", "opening", delta, *names).repartition("sku")
        return staged(rows.sortWithinPartitions("sku", "slice", *names).mapInArrow(_replay(names), schema))

    refused = []
    is_short = F.col("moves") <= rows_per_slice
    short, long = risky.filter(is_short), risky.filter(~is_short)
    if not short.isEmpty():
        rows = moves.join(short, "sku").select("sku", F.lit(0).cast("bigint").alias("slice"), "opening", "delta", *parts)
        refused.append(played(rows).filter("closing IS NULL"))
    if not long.isEmpty():
        tape = staged(moves.join(long.select("sku"), "sku", "left_semi").select("sku", "delta", *parts))
        tape = _sliced(tape, names, rows_per_slice)
        never = F.lit(None).cast("bigint")
        first = long.select("sku", F.col("opening").alias("first"))
        state = slice_summaries(tape, names).join(first, "sku")
        state = state.withColumns({"closing": never, "opening": never, "todo": F.lit(False)})
        slices_at_once = 1
        while True:
            state = staged(state.groupBy("sku").applyInPandas(_scan(slices_at_once), _STATE))
            todo = state.filter("todo").select("sku", "slice", "opening")
            count = todo.count()
            if not count:
                break
            if on_round:
                on_round(count)
            ends = played(tape.join(todo, ["sku", "slice"]))
            refused.append(ends.filter("closing IS NULL"))
            ends = ends.filter("closing IS NOT NULL").selectExpr("sku", "slice", "closing AS _closing")
            state = state.join(ends, ["sku", "slice"], "left").withColumn("closing", F.coalesce("closing", "_closing")).drop("_closing")
            slices_at_once *= 2
    if not refused:
        return moves.select("seq").limit(0)
    return reduce(DataFrame.unionByName, refused).select(back)


def _deliver(names: list[str]):
    """Rows ``(sku, opening, delta, event_id, *names)`` in order -> those that are tried, and whether they are accepted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, balance, moved = None, 0, set()
        for batch in batches:
            tried, accepted = [], []
            for i, (sku, opening, delta, event_id) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)):
                if sku != current:
                    current, balance, moved = sku, opening, set()
                if event_id in moved:
                    continue
                fits = S.INT_MIN <= balance + delta <= S.INT_MAX
                if fits:
                    balance += delta
                    if event_id is not None:
                        moved.add(event_id)
                tried.append(i)
                accepted.append(fits)
            rows = batch.take(pa.array(tried, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns[4:], pa.array(accepted, pa.bool_())], [*names, "accepted"])

    return run


def replayed_deliveries(deliveries: DataFrame, balances: DataFrame) -> DataFrame:
    """``(seq, accepted)`` of the deliveries that are tried when each event id moves its sku once.

    ``deliveries(seq, sku, delta, event_id)`` are played in order, a sku after the other in a stream; a delivery after the
    accepted one of its id is left out, one after a refused one is tried. Only ids that are delivered repeatedly are remembered.
    """
    parts, names, back = _seq_parts(deliveries)
    times = deliveries.filter("event_id <> ''").groupBy("sku", "event_id").agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1")
    opening = F.coalesce("quantity", F.lit(0)).cast("bigint").alias("opening")
    rows = (
        deliveries.select("sku", "delta", "event_id", *parts)
        .join(times, ["sku", "event_id"], "left")
        .join(balances.select("sku", "quantity"), "sku", "left")
        .select("sku", opening, "delta", F.when(F.col("_times") > 1, F.col("event_id")).alias("event_id"), *names)
    )
    schema = ", ".join(f"{n} bigint" for n in names) + ", accepted boolean"
    ordered = rows.repartition("sku").sortWithinPartitions("sku", *names)
    return ordered.mapInArrow(_deliver(names), schema).select(back, "accepted")
