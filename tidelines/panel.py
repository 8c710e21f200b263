"""The panel key, and time slices that keep very large entities from landing in one task."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# A window group up to this size stays in one task (it streams and spills there).
MAX_ROWS = 2_000_000
# Upper bound on the number of sliced entities and of slices: the row limit grows with the table so that
# total_rows / limit, and with it everything that is broadcast below, stays within a fixed multiple of this.
MAX_SLICED = 20_000
# Rows that are drawn for each slice border. Slices differ in size by chance only: with so many, one of twice its
# intended size is out of reach.
DRAWN_PER_SLICE = 64

SLICE = "_slice"


def as_micros(col: str) -> Column:
    """Time column (timestamp, timestamp_ntz or date) as microseconds since the epoch."""
    return F.unix_micros(F.col(col).cast("timestamp"))


def order_key(time: str, ties: tuple[str, ...]) -> Column:
    """Place of a row in its entity's order. Nulls come first, as in Spark's windows."""
    return F.struct(as_micros(time).alias("time"), *[F.col(c).alias(f"tie{k}") for k, c in enumerate(ties)])


def count_not_above(borders: Column, key: Column, steps: int) -> Column:
    """How many borders are not above the key: they are sorted, so the range in question is halved ``steps`` times."""

    def halve(span: Column, _: Column) -> Column:
        low, high = span["low"], span["high"]
        middle = F.shiftright(low + high, 1)
        open_, above = low < high, F.get(borders, middle) <= key
        return F.struct(F.when(open_ & above, middle + 1).otherwise(low).alias("low"), F.when(open_ & ~above, middle).otherwise(high).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.size(borders).alias("high"))
    return F.aggregate(F.array_repeat(F.lit(0), steps), start, halve, lambda span: span["low"])


@dataclass(frozen=True)
class Slices:
    """Slices, in the order of time and ties, of the entities that are too large for one window group.

    ``table`` has one row per sliced entity: the order key at which each of its slices but the first begins. It holds
    at most MAX_SLICED rows and about twice as many borders, which makes it safe to broadcast.
    """

    table: DataFrame
    entity: str | None
    time: str
    ties: tuple[str, ...]
    steps: int

    def attach(self, df: DataFrame) -> DataFrame:
        """Add ``_slice``: the slice number of a row, or -1 for entities that are not sliced."""
        key = order_key(self.time, self.ties)
        if self.entity is None:
            # The whole table is one entity; its borders become literals.
            kind = self.table.schema["_borders"].dataType.elementType
            borders = F.array(*[F.struct(*[F.lit(b[f.name]).cast(f.dataType).alias(f.name) for f in kind.fields]) for b in self.table.first()["_borders"]])
            return df.withColumn(SLICE, count_not_above(borders.cast(self.table.schema["_borders"].dataType), key, self.steps))
        joined = df.join(F.broadcast(self.table), F.col(self.entity).eqNullSafe(F.col("_hot")), "left")
        own = F.when(F.col("_borders").isNull(), F.lit(-1)).otherwise(count_not_above(F.col("_borders"), key, self.steps))
        return joined.select(*[df[c] for c in df.columns], own.alias(SLICE))


@dataclass(frozen=True)
class Panel:
    """Key of a panel time series: entity, time and the columns that break ties in time.

    ``fit`` measures the panel once. If no entity exceeds the row limit, operators use one plain window
    per entity (one shuffle, one sort). Otherwise the large entities get time slices, and operators
    spread each of them over many tasks with identical results.
    """

    entity: str | None = "stationID"
    time: str = "timestamp_utc"
    ties: tuple[str, ...] = ()
    slices: Slices | None = None

    @property
    def order(self) -> list[str]:
        return [self.time, *self.ties]

    def keys(self) -> list[str]:
        return [self.entity] if self.entity else []

    def clause(self, *extra: str) -> str:
        """Window text of the panel: one group per entity (and ``extra`` columns), oldest row first."""
        groups = ", ".join(f"`{c}`" for c in [*self.keys(), *extra])
        order = ", ".join(f"`{c}`" for c in self.order)
        return (f"PARTITION BY {groups} " if groups else "") + f"ORDER BY {order}"

    def reverse_clause(self, *extra: str) -> str:
        """Same groups from the latest row back; used instead of frames that end at UNBOUNDED
        FOLLOWING, which Spark re-evaluates from scratch for every row."""
        groups = ", ".join(f"`{c}`" for c in [*self.keys(), *extra])
        order = ", ".join(f"`{c}` DESC" for c in self.order)
        return (f"PARTITION BY {groups} " if groups else "") + f"ORDER BY {order}"

    def window(self, *extra: str) -> WindowSpec:
        return Window.partitionBy(*self.keys(), *extra).orderBy(*self.order)

    def reverse_window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys()).orderBy(*[F.col(c).desc() for c in self.order])

    def fit(self, df: DataFrame, max_rows: int = MAX_ROWS) -> Panel:
        """Measure row counts per entity and plan slices for those above ``max_rows``.

        Reads only the key columns, with map-side counting. ``df`` should be the source scan rather than
        a long pipeline.
        """
        entity = F.col(self.entity) if self.entity else F.lit(0)
        keyed = df.select(entity.alias("_hot"), order_key(self.time, self.ties).alias("_key"))
        sizes = keyed.groupBy("_hot").agg(F.count(F.lit(1)).alias("_n"))
        top = sizes.agg(F.sum("_n").alias("total"), F.max("_n").alias("largest")).first()
        total, largest = top["total"] or 0, top["largest"] or 0
        if largest <= max_rows:
            return replace(self, slices=None)
        limit = max(max_rows, total // MAX_SLICED)
        return replace(self, slices=self._plan(keyed, sizes, limit))

    def _plan(self, keyed: DataFrame, sizes: DataFrame, limit: int) -> Slices:
        """Borders at even distances in a sorted draw of each large entity's rows. Rows are drawn by a hash of their
        key, so a draw depends on the data alone; equal keys are drawn together, and no order between them matters."""
        spark = keyed.sparkSession
        hot = sizes.filter(F.col("_n") > limit).withColumnRenamed("_hot", "_own")
        slices = F.ceil(F.col("_n") * 2 / F.lit(limit)).cast("long")
        share = F.least(F.lit(1.0), slices * F.lit(float(DRAWN_PER_SLICE)) / F.col("_n"))
        numbered = keyed.join(F.broadcast(hot), F.col("_hot").eqNullSafe(F.col("_own")))
        draw = F.pmod(F.xxhash64("_key", F.lit("draw")), F.lit(1 << 30)) < share * (1 << 30)
        drawn = numbered.filter(draw).groupBy("_hot").agg(
            F.array_sort(F.collect_list("_key")).alias("_sorted"), F.first(slices).alias("_slices")
        )
        steps = F.sequence(F.lit(1).cast("long"), F.greatest(F.col("_slices") - 1, F.lit(1)))
        place = lambda k: (k * F.size("_sorted") / F.col("_slices")).cast("int")
        borders = F.array_distinct(F.transform(steps, lambda k: F.get(F.col("_sorted"), place(k))))
        # At most total/limit <= MAX_SLICED rows; as literals they spare every later query the counting passes.
        table = drawn.select("_hot", F.array_compact(borders).alias("_borders"))
        rows = table.collect()
        steps = max((len(r["_borders"]) for r in rows), default=0).bit_length()
        return Slices(spark.createDataFrame(rows, table.schema), self.entity, self.time, self.ties, steps)
