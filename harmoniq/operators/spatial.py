"""Point-in-polygon region assignment (N6) without a pair explosion.

Polygons (GeoJSON Polygon or MultiPolygon text) are normalised to a list of
polygons of rings and covered by square cells of several sizes: a cell that no
edge passes lies wholly inside (kept as an inner cell) or outside (dropped); a
cell that an edge passes is split into four, down to the finest size, where it
is a border cell.  A point is keyed by its cell of every size, so the join is an
equi-join with as many candidates as there are sizes.  A point in an inner cell
is decided by the cell; only points in border cells take the exact test, an
even-odd ray cast over every ring (holes count as rings), evaluated with
higher-order functions inside the JVM.  Nothing is capped; a point inside several
polygons keeps the smallest code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MULTI = T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))
POLY = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))


def as_multipolygon(geometry_json) -> Column:
    g = F.col(geometry_json) if isinstance(geometry_json, str) else geometry_json
    gtype = F.get_json_object(g, "$.type")
    coords = F.get_json_object(g, "$.coordinates")
    return (F.when(gtype == "MultiPolygon", F.from_json(coords, MULTI))
            .when(gtype == "Polygon", F.array(F.from_json(coords, POLY))))


def _ring_crossings(ring: Column, px: Column, py: Column) -> Column:
    """Number of ring edges a ray from (px, py) towards +x crosses."""
    n = F.size(ring)

    def crosses(i):
        a = F.element_at(ring, i + 1)
        b = F.element_at(ring, F.when(i + 2 <= n, i + 2).otherwise(F.lit(1)))
        ax, ay, bx, by = a[0], a[1], b[0], b[1]
        straddles = (ay > py) != (by > py)
        x_at = (bx - ax) * (py - ay) / (by - ay) + ax
        return straddles & (px < x_at)
    return F.size(F.filter(F.sequence(F.lit(0), n - 1), crosses))


def contains(polys: Column, px: Column, py: Column) -> Column:
    """Even-odd rule over all rings of all polygons."""
    rings = F.flatten(polys)
    total = F.aggregate(F.transform(rings, lambda r: _ring_crossings(r, px, py)), F.lit(0),
                        lambda acc, c: acc + c)
    return (total % 2) == 1


LEVELS = 4                  # sizes of cells, each half the one before
HOT = 64                    # a point key is dealt out to this many salts


def polygon_edges(polys: DataFrame) -> DataFrame:
    """(code, x0, y0, x1, y1) of every ring edge of (code, polys)."""
    ring = polys.select("__code", F.explode(F.flatten("__polys")).alias("ring"))
    n = F.size("ring")

    def edge(i):
        a = F.element_at("ring", i + 1)
        b = F.element_at("ring", F.when(i + 2 <= n, i + 2).otherwise(F.lit(1)))
        return F.struct(a[0].alias("x0"), a[1].alias("y0"), b[0].alias("x1"), b[1].alias("y1"))
    return ring.filter(n > 0).select("__code", F.inline(F.transform(F.sequence(F.lit(0), n - 1), edge)))


def _touches(size: Column) -> Column:
    """Whether the edge meets the closed square (cx, cy) of ``size``: the boxes
    overlap and the square's corners are not all on one side of the edge's line.
    The squares are taken a little larger, so rounding adds cells, never loses one."""
    pad = size * 1e-9
    lx, ly = F.col("cx") * size - pad, F.col("cy") * size - pad
    hx, hy = (F.col("cx") + 1) * size + pad, (F.col("cy") + 1) * size + pad
    box = ((F.greatest("x0", "x1") >= lx) & (F.least("x0", "x1") <= hx)
           & (F.greatest("y0", "y1") >= ly) & (F.least("y0", "y1") <= hy))
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    side = [dx * (y - F.col("y0")) - dy * (x - F.col("x0")) for x in (lx, hx) for y in (ly, hy)]
    return box & (F.least(*side) <= 0) & (F.greatest(*side) >= 0)


def cell_cover(regions: DataFrame, code: str = "code", geometry: str = "geometry", cell: float = 1.0,
               levels: int = LEVELS) -> DataFrame:
    """(code, level, cx, cy, inner): the cells of size ``cell`` / 2 ** level that
    cover each polygon; inner ones lie wholly inside it, the others (of the last
    level) on its border."""
    from harmoniq.session import materialize
    polys = regions.select(F.col(code).alias("__code"), as_multipolygon(geometry).alias("__polys"))
    edges = polygon_edges(polys)

    def span(a, b, size):
        return F.sequence(F.floor(F.least(a, b) / size), F.floor(F.greatest(a, b) / size))
    size = F.lit(float(cell))
    met = (edges.withColumn("cx", F.explode(span("x0", "x1", size))).withColumn("cy", F.explode(span("y0", "y1", size)))
           .filter(_touches(size)))
    pts = F.flatten(F.flatten("__polys"))
    xs, ys = F.transform(pts, lambda p: p[0]), F.transform(pts, lambda p: p[1])
    box = (polys.filter(F.size(pts) > 0)
           .select("__code", F.explode(F.sequence(F.floor(F.array_min(xs) / size), F.floor(F.array_max(xs) / size))).alias("cx"),
                   F.floor(F.array_min(ys) / size).alias("y0"), F.floor(F.array_max(ys) / size).alias("y1"))
           .select("__code", "cx", F.explode(F.sequence("y0", "y1")).alias("cy")))
    cover = []
    for level in range(levels):
        size = F.lit(float(cell) / 2 ** level)
        met = materialize(met)
        border = met.select("__code", "cx", "cy").distinct()
        whole = box.join(border, ["__code", "cx", "cy"], "left_anti").join(polys, "__code")
        centre = contains(F.col("__polys"), (F.col("cx") + 0.5) * size, (F.col("cy") + 0.5) * size)
        cover.append(whole.filter(centre).select("__code", F.lit(level).alias("level"), "cx", "cy", F.lit(True).alias("inner")))
        if level + 1 == levels:
            cover.append(border.select("__code", F.lit(level).alias("level"), "cx", "cy", F.lit(False).alias("inner")))
            break
        four = F.array(*[F.struct((F.col("cx") * 2 + i).alias("cx"), (F.col("cy") * 2 + j).alias("cy")) for i in (0, 1) for j in (0, 1)])
        box = border.select("__code", F.explode(four).alias("c")).select("__code", "c.cx", "c.cy")
        met = (met.withColumn("c", F.explode(four)).select("__code", "x0", "y0", "x1", "y1", "c.cx", "c.cy")
               .filter(_touches(F.lit(float(cell) / 2 ** (level + 1)))))
    out = cover[0]
    for c in cover[1:]:
        out = out.unionByName(c)
    return materialize(out.withColumnRenamed("__code", "code"))


def assign_regions(points: DataFrame, regions: DataFrame, key: str, lon: str = "lon", lat: str = "lat",
                   code: str = "code", geometry: str = "geometry", cell: float = 1.0, levels: int = LEVELS,
                   report: bool = False) -> DataFrame:
    """Every point (identified by ``key``) with the code of the polygon
    containing it, NULL when none; with ``report`` also the number of cells that
    it met (``candidates``) and of exact tests that it took (``tests``).  The
    cells carry codes only; the geometry joins the points of border cells."""
    cover = cell_cover(regions, code, geometry, cell, levels).withColumnRenamed("code", "__code")
    polys = regions.select(F.col(code).alias("__code"), as_multipolygon(geometry).alias("__polys"))
    p = points.select(F.col(key).alias("__key"), F.col(lon).cast("double").alias("__px"),
                      F.col(lat).cast("double").alias("__py"))
    keys = F.array(*[F.struct(F.lit(k).alias("level"), F.floor(F.col("__px") / (cell / 2 ** k)).alias("cx"),
                              F.floor(F.col("__py") / (cell / 2 ** k)).alias("cy")) for k in range(levels)])
    # a cell may hold any share of the points: their keys are salted, the cells repeated per salt
    p = (p.withColumn("c", F.explode(keys)).select("__key", "__px", "__py", "c.*")
         .withColumn("salt", F.pmod(F.xxhash64("__key"), F.lit(HOT)).cast("int")))
    cover = cover.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(HOT - 1))))
    met = p.join(cover, ["level", "cx", "cy", "salt"]).select("__key", "__px", "__py", "__code", "inner")
    tested = met.filter(~F.col("inner")).join(polys, "__code").select(
        "__key", "__code", F.lit(1).alias("test"), contains(F.col("__polys"), F.col("__px"), F.col("__py")).alias("hit"))
    sure = met.filter("inner").select("__key", "__code", F.lit(0).alias("test"), F.lit(True).alias("hit"))
    found = sure.unionByName(tested).groupBy("__key").agg(
        F.min(F.when(F.col("hit"), F.col("__code"))).alias("region_code"),
        F.count(F.lit(1)).alias("candidates"), F.sum("test").cast("bigint").alias("tests"))
    out = points.join(found, points[key] == found["__key"], "left").drop("__key")
    if not report:
        return out.drop("candidates", "tests")
    return out.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("candidates", "tests")})
