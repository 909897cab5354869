"""Map point clustering by zoom on a Web-Mercator pixel grid.

Re-aimed from a renderer's greedy clustering to a deterministic grid: at
zoom z a point falls in cell (floor(x / radius), floor(y / radius)) of the
256 * 2^z pixel world.  Points are counted in the cells of the largest zoom;
cells nest, so only that aggregate explodes into the zooms above.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mercator_px(lon, lat, zoom):
    world = F.lit(256.0) * F.pow(F.lit(2.0), zoom.cast("double"))
    x = (lon + F.lit(180.0)) / F.lit(360.0) * world
    rad = F.radians(lat)
    y = (F.lit(1.0) - F.ln(F.tan(rad) + F.lit(1.0) / F.cos(rad)) / F.lit(math.pi)) / F.lit(2.0) * world
    return x, y


def badge_size(n, steps=(5, 10)):
    """Badge class by count: 0 below steps[0], 1 below steps[1], else 2."""
    return F.when(n >= steps[1], 2).when(n >= steps[0], 1).otherwise(0)


def grid_clusters(points: DataFrame, lon: str = "lon", lat: str = "lat", max_zoom: int = 9,
                  radius: int = 40, digits: int = 6) -> DataFrame:
    p = points.select(F.col(lon).cast("double").alias("lon"), F.col(lat).cast("double").alias("lat"))
    x, y = mercator_px(F.col("lon"), F.col("lat"), F.lit(max_zoom))
    cells = p.select("lon", "lat", F.floor(x / radius).alias("gx"), F.floor(y / radius).alias("gy"))
    # centre = mean in integer micro-degrees: the sum is exact, so the mean
    # does not depend on the order rows are added in
    e6 = F.lit(10.0 ** digits)
    finest = cells.groupBy("gx", "gy").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("lon") * e6).cast("bigint")).alias("__sx"),
        F.sum(F.round(F.col("lat") * e6).cast("bigint")).alias("__sy"))
    # a cell lies in the cell of half its numbers one zoom above
    nested = finest.withColumn("zoom", F.explode(F.sequence(F.lit(0), F.lit(max_zoom)))).select(
        "zoom", F.expr(f"shiftright(gx, {int(max_zoom)} - zoom)").alias("gx"),
        F.expr(f"shiftright(gy, {int(max_zoom)} - zoom)").alias("gy"), "n", "__sx", "__sy")
    g = nested.groupBy("zoom", "gx", "gy").agg(F.sum("n").alias("n"), F.sum("__sx").alias("__sx"),
                                               F.sum("__sy").alias("__sy"))
    g = g.select("zoom", "gx", "gy", "n", (F.col("__sx") / F.col("n") / e6).alias("lon"),
                 (F.col("__sy") / F.col("n") / e6).alias("lat"))
    return g.withColumn("badge", badge_size(F.col("n")))
