"""Rates, shares, classes and geometry arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rate_per_100k(count, population) -> Column:
    """count / pop * 100000; NULL when the population is NULL or 0.
    Evaluation order (divide, then multiply) is kept for bit equality."""
    return _c(count).cast("double") / F.nullif(_c(population).cast("double"), F.lit(0.0)) * F.lit(100000.0)


def share_pct(part, total, digits: int = 1) -> Column:
    """round(100 * part / total, 1); NULL when either side is NULL or 0.
    Rounds half away from zero (SQL ROUND)."""
    p, t = _c(part), _c(total)
    return F.when((p != 0) & (t != 0),
                  F.round(F.lit(100.0) * p.cast("double") / t.cast("double"), digits))


def step_bucket(value, stops: list[float], outputs: list, default) -> Column:
    """step function.  NULL -> default; value >= stops[i] -> outputs[i]
    for the largest such i; below stops[0] -> default.
    ``len(outputs) == len(stops)``."""
    v = _c(value)
    out = F.lit(default)
    for stop, res in zip(stops, outputs, strict=True):
        out = F.when(v >= F.lit(stop), F.lit(res)).otherwise(out)
    return F.when(v.isNull(), F.lit(default)).otherwise(out)


def bbox_centre(geometry_json) -> tuple[Column, Column]:
    """centre of the bounding box of every coordinate pair in a GeoJSON
    geometry (Polygon or MultiPolygon alike); empty -> (0, 0)."""
    pairs = F.regexp_extract_all(
        _c(geometry_json),
        F.lit(r"\[\s*(-?[0-9.eE+-]+)\s*,\s*-?[0-9.eE+-]+\s*\]"), F.lit(1))
    ys = F.regexp_extract_all(
        _c(geometry_json),
        F.lit(r"\[\s*-?[0-9.eE+-]+\s*,\s*(-?[0-9.eE+-]+)\s*\]"), F.lit(1))
    xs_d = F.transform(pairs, lambda s: s.cast("double"))
    ys_d = F.transform(ys, lambda s: s.cast("double"))
    cx = F.coalesce((F.array_min(xs_d) + F.array_max(xs_d)) / 2, F.lit(0.0))
    cy = F.coalesce((F.array_min(ys_d) + F.array_max(ys_d)) / 2, F.lit(0.0))
    return cx, cy
