"""Interpolation of missing values by row position within an entity."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelines.panel import SLICE, Panel

_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
_UPTO = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _known(col: str) -> str:
    """Position and value of a known reading, null where the reading is missing."""
    return f"CASE WHEN `{col}` IS NOT NULL THEN struct(_at AS at, CAST(`{col}` AS DOUBLE) AS x) END"


def interpolate(
    df: DataFrame,
    panel: Panel,
    cols: Iterable[str],
    method: str = "linear",
    max_gap: int | None = None,
) -> DataFrame:
    """Fill nulls of ``cols`` from the known neighbours; nothing is extrapolated at the ends.

    Position counts rows, not elapsed time. ``max_gap`` limits the number of consecutive nulls that are
    filled; None fills gaps of any length. Columns that do not exist are skipped. The look-ahead uses a
    descending window, so the cost is linear in the length of the series.
    """
    if method not in ("linear", "nearest"):
        raise ValueError(f"method must be 'linear' or 'nearest', got {method!r}")
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    if panel.slices is None:
        located = df.withColumn("_at", F.row_number().over(panel.window()))
        bounded = _neighbours(located, panel, cols)
    else:
        bounded = _neighbours_sliced(df, panel, cols)
    return bounded.selectExpr(*[_fill(c, method, max_gap) if c in cols else f"`{c}`" for c in df.columns])


def _neighbours(located: DataFrame, panel: Panel, cols: list[str], *extra: str) -> DataFrame:
    """Value and position of the last known reading (``_px_``, ``_pa_``) and of the next (``_nx_``, ``_na_``)."""
    sides = {"p": panel.clause(*extra), "n": panel.reverse_clause(*extra)}
    return located.selectExpr(
        "*",
        *[
            f"last({value}, true) OVER ({clause} {_UPTO}) AS `_{side}{kind}_{c}`"
            for side, clause in sides.items()
            for c in cols
            for kind, value in (("x", f"CAST(`{c}` AS DOUBLE)"), ("a", f"CASE WHEN `{c}` IS NOT NULL THEN _at END"))
        ],
    )


def _shifted(struct: str) -> str:
    """A neighbour with its position counted from the start of the entity instead of the slice."""
    return f"CASE WHEN `{struct}` IS NOT NULL THEN struct(`{struct}`.at + _offset AS at, `{struct}`.x AS x) END"


def _neighbours_sliced(df: DataFrame, panel: Panel, cols: list[str]) -> DataFrame:
    """Neighbours for sliced entities: look within the slice, else carry over from other slices.

    The carry is computed on one summary row per (entity, slice), so no task sees a whole large entity.
    """
    ranked = panel.slices.attach(df).withColumn("_at", F.row_number().over(panel.window(SLICE)))
    keys = [*panel.keys(), SLICE]
    summary = ranked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_size"),
        *[F.min(F.expr(_known(c))).alias(f"_head_{c}") for c in cols],
        *[F.max(F.expr(_known(c))).alias(f"_tail_{c}") for c in cols],
    )
    groups = ", ".join(f"`{k}`" for k in panel.keys())
    part = f"PARTITION BY {groups} " if groups else ""
    earlier, later = f"{part}ORDER BY {SLICE} {_BEFORE}", f"{part}ORDER BY {SLICE} DESC {_BEFORE}"
    placed = summary.selectExpr(
        "*", f"coalesce(sum(_size) OVER ({earlier}), 0) AS _offset"
    ).selectExpr(
        *[f"`{k}`" for k in keys],
        "_offset",
        *[f"{_shifted(f'_{end}_{c}')} AS `_{end}_{c}`" for c in cols for end in ("head", "tail")],
    )
    carries = placed.selectExpr(
        *[f"`{k}` AS `_k_{k}`" for k in keys],
        "_offset",
        *[f"last(`_tail_{c}`, true) OVER ({earlier}) AS `_carry_{c}`" for c in cols],
        *[f"last(`_head_{c}`, true) OVER ({later}) AS `_ahead_{c}`" for c in cols],
    )
    on = F.expr(" AND ".join(f"`{k}` <=> `_k_{k}`" for k in keys))
    joined = _neighbours(ranked, panel, cols, SLICE).join(carries, on)
    return joined.selectExpr(
        *[f"`{c}`" for c in df.columns],
        "_at + _offset AS _at",
        *[
            text
            for c in cols
            for side, carry in (("p", f"`_carry_{c}`"), ("n", f"`_ahead_{c}`"))
            for text in (
                f"CASE WHEN `_{side}a_{c}` IS NULL THEN {carry}.x ELSE `_{side}x_{c}` END AS `_{side}x_{c}`",
                f"coalesce(`_{side}a_{c}` + _offset, {carry}.at) AS `_{side}a_{c}`",
            )
        ],
    )


def _fill(col: str, method: str, max_gap: int | None) -> str:
    x0, a0, x1, a1 = (f"`_{side}_{col}`" for side in ("px", "pa", "nx", "na"))
    if method == "linear":
        value = f"{x0} + ({x1} - {x0}) * (_at - {a0}) / ({a1} - {a0})"
    else:
        value = f"CASE WHEN _at - {a0} < {a1} - _at THEN {x0} ELSE {x1} END"
    limit = "" if max_gap is None else f" AND {a1} - {a0} - 1 <= {max_gap}"
    return (
        f"CASE WHEN `{col}` IS NOT NULL THEN `{col}` "
        f"WHEN {a0} IS NOT NULL AND {a1} IS NOT NULL{limit} THEN {value} END AS `{col}`"
    )
