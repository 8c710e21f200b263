"""Exact order statistics and whole-table ranks without a whole-table sort in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelines.panel import as_micros
from tidelines.session import staged

_CELLS = 2048
# A candidate set of this size is sorted directly.
_FINISH = 100_000


def rows_at_ranks(
    df: DataFrame, keys: list[str], positions: Callable[[int], list[int]]
) -> tuple[int, list[Row | None]]:
    """Row count n, and the rows at ``positions(n)`` (from 1) in the order of ``keys``, which must not be null.

    None for positions outside the table. NaN is the largest value, as in Spark's order. The candidates of a position are narrowed by counting, key after key:
    each round is one scan with map-side counts over at most a few thousand cells, and keeps the one cell
    that holds the position. Only the last small remainder is sorted, so the cost does not depend on how
    rows are spread over keys.
    """
    rows = df.select(*keys)
    first = _extent(rows, keys[0])
    total = first[2]
    ranks = positions(total)
    inside = {r for r in ranks if 0 < r <= total}
    if total <= _FINISH:
        found = _pick(rows, keys, sorted(inside)) if inside else {}
    else:
        found = {r: _narrow(rows, keys, r, first) for r in inside}
    return total, [found.get(r) for r in ranks]


def _extent(rows: DataFrame, key: str) -> Row:
    axis = _axis(key, rows.schema[key].dataType)
    return rows.agg(F.min(axis), F.max(axis), F.count(F.lit(1))).first()


def _pick(rows: DataFrame, keys: list[str], ranks: list[int]) -> dict[int, Row]:
    """Rows at the given positions of a table of at most _FINISH rows, sorted in one task."""
    numbered = rows.withColumn("_rank", F.row_number().over(Window.orderBy(*keys)))
    return {r["_rank"]: r for r in numbered.filter(F.col("_rank").isin(ranks)).collect()}


def _narrow(rows: DataFrame, keys: list[str], rank: int, extent: Row) -> Row:
    for i, key in enumerate(keys):
        narrow = _narrow_text if isinstance(rows.schema[key].dataType, T.StringType) else _narrow_number
        rows, rank, left = narrow(rows, key, rank, extent if i == 0 else _extent(rows, key))
        if left <= _FINISH:
            return _pick(rows, keys, [rank])[rank]
    # Every remaining candidate has identical keys.
    return rows.first()


def _within(key: str, kind: T.DataType, lo, hi) -> Column:
    """Range filter on the bare column, so that it reaches the file scan."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        lo, hi = (F.timestamp_micros(F.lit(v)).cast(kind) for v in (lo, hi))
    return F.col(key).between(lo, hi)


def _axis(key: str, kind: T.DataType) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return as_micros(key)
    return F.col(key)


def _special(axis: Column) -> list[Column]:
    """Cells of the values that no width can divide: minus infinity, infinity and NaN, which comes last."""
    infinity = F.lit(float("inf"))
    return [axis == -infinity, axis == infinity, F.isnan(axis)]


def _narrow_number(rows: DataFrame, key: str, rank: int, extent: Row) -> tuple[DataFrame, int, int]:
    kind = rows.schema[key].dataType
    axis = _axis(key, kind)
    fractional = isinstance(kind, (T.DoubleType, T.FloatType))
    lo, hi, left = extent
    if fractional and left > _FINISH:
        # Three cells of equal values and one of all others; only the last needs narrowing.
        low, high, nan = _special(axis)
        cell = F.when(low, 0).when(nan, 3).when(high, 2).otherwise(1)
        hist = rows.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(axis).alias("lo"), F.max(axis).alias("hi"))
        hit, rank = _hit(hist, rank)
        lo, hi, left = hit["lo"], hit["hi"], hit["n"]
        rows = rows.filter([low, ~low & ~high & ~nan, high, nan][hit["cell"]])
        if hit["cell"] != 1:
            return rows, rank, left
    while left > _FINISH and lo != hi:
        # The halves of a range of doubles may be further apart than the largest double.
        width = (hi / _CELLS - lo / _CELLS) if fractional else (hi - lo) / _CELLS
        if fractional and width == 0:
            cell = axis  # neighbours among the smallest doubles: each value is a cell
        else:
            cell = F.least(F.floor(axis / F.lit(width) - F.lit(lo / width)) if fractional else F.floor((axis - F.lit(lo)) / F.lit(width)), F.lit(_CELLS - 1))
        hist = rows.groupBy(cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min(axis).alias("lo"), F.max(axis).alias("hi")
        )
        hit, rank = _hit(hist, rank)
        if hit["n"] == left:  # no pass may leave all as it was: halve by value
            middle = lo / 2 + hi / 2 if fractional else (lo + hi) // 2
            below = rows.filter(axis <= F.lit(middle)).agg(F.count(F.lit(1)), F.min(axis), F.max(axis)).first()
            above = rows.filter(axis > F.lit(middle)).agg(F.count(F.lit(1)), F.min(axis), F.max(axis)).first()
            part = below if rank <= below[0] else above
            rank -= 0 if part is below else below[0]
            left, lo, hi = part
        else:
            lo, hi, left = hit["lo"], hit["hi"], hit["n"]
        rows = rows.filter(_within(key, kind, lo, hi))
    return rows, rank, left


def _narrow_text(rows: DataFrame, key: str, rank: int, extent: Row) -> tuple[DataFrame, int, int]:
    lo, hi, left = extent
    width = 0
    while left > _FINISH and lo != hi:
        width += 2
        prefix = F.substring(key, 1, width)
        hist = rows.groupBy(prefix.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")
        )
        hit, rank = _hit(hist, rank)
        lo, hi, left = hit["lo"], hit["hi"], hit["n"]
        rows = rows.filter(F.col(key).between(lo, hi))
    return rows, rank, left


def _hit(hist: DataFrame, rank: int) -> tuple[Row, int]:
    """The histogram cell that holds the rank, and the rank within it. The window runs over the
    histogram only: a few thousand rows."""
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    hit = (
        hist.withColumn("upto", F.sum("n").over(upto)).filter(F.col("upto") >= rank).orderBy("cell").limit(1).first()
    )
    return hit, rank - (hit["upto"] - hit["n"])


#: A row's place after a range exchange: partition number, then row number within it (monotonically_increasing_id).
_ROW_BITS = 33


def ordinal_rank(df: DataFrame, time: str, ties: list[str], name: str = "rank") -> DataFrame:
    """Position of every row in the order (time, ties) over the whole table, from 1.

    Rows go to tasks by range, each task sorts its range and numbers its rows, and a range's offset is the row count of
    all earlier ones (one small row per range). So the cost of a row depends neither on the number of ranges nor on how
    times are spread: rows of equal keys may be divided among tasks. The numbered rows are stored before they are
    counted, as both must see the same ranges.
    """
    order = [F.col(c) for c in (time, *ties)]
    spread = df.withColumn("_spread", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange(*order, "_spread").sortWithinPartitions(*order, "_spread")
    placed = staged(ranged.drop("_spread").withColumn("_place", F.monotonically_increasing_id()), "ranks")
    part = F.shiftright("_place", _ROW_BITS)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # As many rows as there are ranges, in whatever number the exchange has made.
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    within = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1) + 1
    joined = placed.join(F.broadcast(offsets), part == F.col("_part"))
    return joined.select(*df.columns, (F.col("_offset") + within).alias(name))


def position_slice(df: DataFrame, time: str, ties: list[str], start: int, stop: int) -> DataFrame:
    """Rows at positions [start, stop) of the ordered table, counted from 0."""
    ranked = ordinal_rank(df, time, ties, "_rank")
    return ranked.filter((F.col("_rank") > start) & (F.col("_rank") <= stop)).drop("_rank")
