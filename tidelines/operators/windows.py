"""Row-frame features per entity: lags, leads, rolling statistics, changes, sequences.

Features are described first, as SQL window expressions, and evaluated together: all of them share one
window specification, so any number of columns costs one shuffle and one sort.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from itertools import zip_longest

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelines.panel import SLICE, Panel


Expr = tuple[str, str]


@dataclass(frozen=True)
class RowFeatures:
    """Named window expressions, and how many rows back and ahead they look in total.

    In an expression ``{w}`` stands for the panel's PARTITION BY and ORDER BY. Expressions come in stages; a
    stage may use the columns of earlier ones. Only the columns named in ``outputs`` are kept.
    """

    stages: tuple[tuple[Expr, ...], ...]
    outputs: tuple[str, ...]
    back: int = 0
    ahead: int = 0


def _simple(exprs: Iterable[Expr], back: int = 0, ahead: int = 0) -> RowFeatures:
    exprs = tuple(exprs)
    return RowFeatures((exprs,), tuple(name for name, _ in exprs), back, ahead)


def add_features(df: DataFrame, panel: Panel, *features: RowFeatures) -> DataFrame:
    """Append all feature columns.

    Without slices: one window per entity. With slices (see Panel.fit): the rows inside a slice are
    computed on (entity, slice) windows, which are bounded in size; only the rows whose frame crosses a
    slice border are computed on a per-entity window over the slice rims. The union is exactly the result
    of the plain window, and both branches read the same exchange.
    """
    outputs = [name for f in features for name in f.outputs]

    def build(rows: DataFrame, clause: str) -> DataFrame:
        # Stages of all features run side by side. Each is one window operator on the same partitioning and
        # order, so later stages need no further shuffle or sort.
        for stage in zip_longest(*[f.stages for f in features], fillvalue=()):
            exprs = dict(e for part in stage for e in part)
            rows = rows.selectExpr("*", *[f"{text.replace('{w}', clause)} AS `{n}`" for n, text in exprs.items()])
        return rows

    if panel.slices is None:
        return build(df, panel.clause()).select(*df.columns, *outputs)

    back = max((f.back for f in features), default=0)
    ahead = max((f.ahead for f in features), default=0)
    reach = back + ahead
    ranked = panel.slices.attach(df).select(
        "*",
        F.row_number().over(panel.window(SLICE)).alias("_pos"),
        F.count(F.lit(1)).over(Window.partitionBy(*panel.keys(), SLICE)).alias("_size"),
    )
    whole = F.col(SLICE) < 0
    inside = whole | ((F.col("_pos") > back) & (F.col("_pos") <= F.col("_size") - ahead))
    rim = ~whole & ((F.col("_pos") <= reach) | (F.col("_pos") > F.col("_size") - reach))
    inner = build(ranked, panel.clause(SLICE)).filter(inside)
    outer = build(ranked.filter(rim), panel.clause()).filter(~inside)
    return inner.unionByName(outer).select(*df.columns, *outputs)


def _last(n: int) -> str:
    """Frame of the last ``n`` rows up to the current one."""
    return f"{{w}} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


def lags(cols: Iterable[str], steps: Iterable[int], name: str = "{c}_lag_{k}h") -> RowFeatures:
    """Value ``k`` rows earlier, for every column and step."""
    cols, steps = list(cols), list(steps)
    exprs = [(name.format(c=c, k=k), f"lag(`{c}`, {k}) OVER ({{w}})") for c in cols for k in steps]
    return _simple(exprs, back=max(steps, default=0))


def leads(cols: Iterable[str], steps: Iterable[int], name: str = "target_{c}_{k}h") -> RowFeatures:
    """Value ``k`` rows later (forecast targets)."""
    cols, steps = list(cols), list(steps)
    exprs = [(name.format(c=c, k=k), f"lead(`{c}`, {k}) OVER ({{w}})") for c in cols for k in steps]
    return _simple(exprs, ahead=max(steps, default=0))


def _blocks(windows: Iterable[int]) -> dict[int, list[tuple[int, int]]]:
    """How to build each window from shorter ones: size -> pieces (size, rows back), shortest size first.

    Sizes that are not asked for are added where a window would need more than four pieces, so the number
    of values combined per row grows with the logarithm of the window.
    """
    plan: dict[int, list[tuple[int, int]]] = {1: []}

    def build(n: int) -> None:
        if n in plan:
            return
        if n > 4 * max(size for size in plan if size < n):
            build((n + 1) // 2)
        pieces, offset = [], 0
        while offset < n:
            size = max(s for s in plan if s <= n - offset)
            pieces.append((size, offset))
            offset += size
        plan[n] = pieces

    for n in sorted(set(windows)):
        build(n)
    return plan


def rolling(
    cols: Iterable[str],
    windows: Iterable[int],
    stats: Iterable[str] = ("mean", "std", "min", "max"),
    name: str = "{c}_rolling_{stat}_{n}h",
) -> RowFeatures:
    """Statistics over the last ``n`` rows; null unless all ``n`` values are present.

    A sliding frame would visit all ``n`` rows again for every row. Instead each window is put together
    from shorter windows that end earlier: 24 = 12 + the 12 before, 12 = 6 + 6 and so on. Sums, minima and
    maxima simply combine; squared deviations combine with the spread of the pieces' means, which is as
    stable as the two-pass formula. A missing value anywhere makes the sum null.
    """
    cols, windows, stats = list(cols), list(windows), list(stats)
    unknown = set(stats) - {"mean", "std", "min", "max"}
    if unknown:
        raise ValueError(f"Unknown rolling statistics: {sorted(unknown)}")
    parts = ["s"] + ["q"] * ("std" in stats) + ["l"] * ("min" in stats) + ["h"] * ("max" in stats)
    plan = _blocks(windows)

    def state(part: str, n: int, c: str, back: int = 0) -> str:
        return f"_{part}{n}_{c}" + (f"_{back}" if back else "")

    start = [(state(p, 1, c), "0D" if p == "q" else f"CAST(`{c}` AS DOUBLE)") for c in cols for p in parts]
    stages: list[list[Expr]] = [start]
    for n, pieces in plan.items():
        if n == 1:
            continue
        shifted, combined = [], []
        for c in cols:
            shifted += [
                (state(p, size, c, back), f"lag(`{state(p, size, c)}`, {back}) OVER ({{w}})")
                for size, back in pieces
                if back
                for p in parts
            ]
            piece = lambda p: [f"`{state(p, size, c, back)}`" for size, back in pieces]  # noqa: B023, E731
            total = " + ".join(piece("s"))
            combined.append((state("s", n, c), total))
            if "q" in parts:
                spread = " + ".join(
                    f"{size} * pow({value} / {size} - ({total}) / {n}, 2)"
                    for (size, _), value in zip(pieces, piece("s"))
                )
                combined.append((state("q", n, c), " + ".join(piece("q")) + " + " + spread))
            if "l" in parts:
                combined.append((state("l", n, c), f"least({', '.join(piece('l'))})"))
            if "h" in parts:
                combined.append((state("h", n, c), f"greatest({', '.join(piece('h'))})"))
        stages += [shifted, combined]

    final: list[Expr] = []
    for c in cols:
        for n in windows:
            full = f"`{state('s', n, c)}` IS NOT NULL"
            values = {
                "mean": f"`{state('s', n, c)}` / {n}",
                "std": f"sqrt(`{state('q', n, c)}` / {n - 1})" if n > 1 else "CAST(NULL AS DOUBLE)",
                "min": f"`{state('l', n, c)}`",
                "max": f"`{state('h', n, c)}`",
            }
            final += [
                (name.format(c=c, n=n, stat=stat), f"CASE WHEN {full} THEN {values[stat]} END") for stat in stats
            ]
    stages.append(final)
    return RowFeatures(
        tuple(tuple(s) for s in stages), tuple(n for n, _ in final), back=max(windows, default=1) - 1
    )


def differences(col: str, steps: Iterable[int] = (1, 24), name: str = "{c}_diff_{k}h") -> RowFeatures:
    """Difference to the value ``k`` rows earlier."""
    steps = list(steps)
    exprs = [(name.format(c=col, k=k), f"`{col}` - lag(`{col}`, {k}) OVER ({{w}})") for k in steps]
    return _simple(exprs, back=max(steps))


def percent_change(
    col: str, step: int = 1, zero_div: str = "null", name: str = "{c}_pct_change_{k}h"
) -> RowFeatures:
    """Change in percent of the earlier value.

    A zero base gives null, or with ``zero_div="ieee"`` the IEEE result (signed infinity or NaN).
    """
    if zero_div not in ("null", "ieee"):
        raise ValueError(f"zero_div must be 'null' or 'ieee', got {zero_div!r}")
    base = f"lag(`{col}`, {step}) OVER ({{w}})"
    text = f"try_divide(`{col}` - {base}, {base}) * 100"
    if zero_div == "ieee":
        text = (
            f"CASE WHEN {base} <> 0 THEN {text} WHEN `{col}` > {base} THEN double('Infinity') "
            f"WHEN `{col}` < {base} THEN double('-Infinity') WHEN `{col}` = {base} THEN double('NaN') END"
        )
    return _simple([(name.format(c=col, k=step), text)], back=step)


def rolling_error(actual: str, predicted: str, window: int, name: str = "rolling_mae") -> RowFeatures:
    """Mean absolute error over the last ``window`` rows; null unless the frame is full."""
    mean = rolling(["_error"], [window], ["mean"], name)
    error = (("_error", f"abs(`{actual}` - `{predicted}`)"),)
    return RowFeatures((error, *mean.stages), mean.outputs, mean.back)


def sequences(cols: Iterable[str], length: int = 30, name: str = "sequence") -> RowFeatures:
    """The last ``length`` rows as an array of structs, oldest first; null until there are enough rows."""
    items = ", ".join(f"`{c}`" for c in cols)
    rows = f"collect_list(struct({items})) OVER ({_last(length)})"
    return _simple([(name, f"CASE WHEN size({rows}) = {length} THEN {rows} END")], back=length - 1)


def time_step(panel: Panel, name: str = "step_seconds") -> RowFeatures:
    """Seconds since the previous row of the entity."""
    now = f"unix_micros(CAST(`{panel.time}` AS TIMESTAMP))"
    before = f"unix_micros(CAST(lag(`{panel.time}`, 1) OVER ({{w}}) AS TIMESTAMP))"
    return _simple([(name, f"({now} - {before}) / 1000000D")], back=1)


def time_gaps(df: DataFrame, panel: Panel, expected_seconds: float = 3600.0) -> DataFrame:
    """Rows whose distance to the previous row differs from the expected cadence."""
    steps = add_features(df, panel, time_step(panel))
    return steps.filter(F.col("step_seconds").isNotNull() & (F.col("step_seconds") != expected_seconds))
