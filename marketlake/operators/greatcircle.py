"""Exact nearest-neighbour join by great-circle distance, on an octree of unit-sphere coordinates.

Points become three coordinates on the unit sphere, where the straight chord between two of them grows with the great
circle, so boxes bound it as they do in the plane. There is no date line and no pole: both are places like any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.nearest import _literal_rows, _square, _stored
from marketlake.session import cut_lineage

EARTH_RADIUS_KM = 6371.0088  # mean radius
_AXES = ("u", "v", "w")
_MAX_LEVEL = 20  # boxes of 2 / 2**20 of the radius, about 12 m
_CUT_EVERY = 6
_BROADCAST_LEVEL = 5  # level 5 has at most 8**5 = 32,768 boxes


def _placed(df: DataFrame, x: str, y: str) -> DataFrame:
    lon, lat = F.radians(F.col(x).cast("double")), F.radians(F.col(y).cast("double"))
    return df.withColumns({"u": F.cos(lat) * F.cos(lon), "v": F.cos(lat) * F.sin(lon), "w": F.sin(lat)})


def _usable(x: str, y: str) -> Column:
    lon, lat = F.col(x).cast("double"), F.col(y).cast("double")
    good = lon.isNotNull() & lat.isNotNull() & lat.between(-90, 90) & ~F.isnan(lon) & (F.abs(lon) < float("inf"))
    return F.coalesce(good, F.lit(False))


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _box_bounds() -> tuple[Column, Column]:
    """Smallest squared chord to a box, and one within which the box surely has a site."""
    near, to_near_face, to_far_face = [], [], []
    for axis in _AXES:
        at, low, high = F.col(axis), F.col(f"{axis}_low"), F.col(f"{axis}_high")
        near.append(_square(F.greatest(low - at, at - high, F.lit(0.0))))
        a, b = _square(at - low), _square(at - high)
        to_near_face.append(F.least(a, b))
        to_far_face.append(F.greatest(a, b))
    # The boxes are tight, so each of their faces touches a site.
    surely = F.least(*[
        to_near_face[i] + _sum([to_far_face[j] for j in range(3) if j != i]) for i in range(3)
    ])
    return _sum(near), surely


def _pairs(spots: DataFrame, sites: DataFrame, leaf_size: int) -> DataFrame:
    """Each spot with the sites of the boxes its nearest one may be in."""
    steps = 1 << _MAX_LEVEL
    cells = {f"c{a}": F.least(F.floor((F.col(a) + 1) / 2 * steps), F.lit(steps - 1)).cast("bigint") for a in _AXES}
    sites = sites.withColumns(cells)
    level = F.explode(F.sequence(F.lit(1), F.lit(_MAX_LEVEL))).alias("level")
    number = [F.expr(f"shiftright(c{a}, {_MAX_LEVEL} - level) AS n{a}") for a in _AXES]
    bounds = [f"{a}_{end}" for a in _AXES for end in ("low", "high")]
    extents = [f(a).alias(f"{a}_{end}") for a in _AXES for f, end in ((F.min, "low"), (F.max, "high"))]
    boxes = _stored(
        sites.select(*_AXES, *cells, level).groupBy("level", *number).agg(*extents, F.count(F.lit(1)).alias("n")), "boxes"
    )
    fullest = dict(tuple(r) for r in boxes.groupBy("level").agg(F.max("n")).collect())  # a row per level
    depth = min((lv for lv, n in fullest.items() if n <= leaf_size), default=_MAX_LEVEL)

    near, surely = _box_bounds()
    parents, numbers = [f"g{a}" for a in _AXES], [f"n{a}" for a in _AXES]
    frontier = spots.select(*_AXES, F.explode(_literal_rows(  # at most 8
        boxes.where("level = 1").select(*numbers, *bounds))).alias("_b")).select(*_AXES, "_b.*")
    for step in range(1, depth + 1):
        if step > 1:
            children = boxes.where(F.col("level") == step).select(
                *[F.shiftright(n, 1).alias(g) for n, g in zip(numbers, parents)], *numbers, *bounds
            )
            frontier = frontier.join(F.broadcast(children) if step <= _BROADCAST_LEVEL else children, parents)
        frontier = (
            frontier.withColumn("_near", near)
            .withColumn("_bound", F.min(surely).over(Window.partitionBy(*_AXES)))
            # Slack for rounding: squared chords of unit vectors are off by a few 1e-16.
            .where(F.col("_near") <= F.col("_bound") * (1 + 1e-12) + 1e-15)
            .select(*_AXES, *[F.col(n).alias(g) for n, g in zip(numbers, parents)])
        )
        if step % _CUT_EVERY == 0 and step < depth:
            frontier = cut_lineage(frontier)
    leaves = sites.select(
        *[F.shiftright(f"c{a}", _MAX_LEVEL - depth).alias(f"g{a}") for a in _AXES],
        *[F.col(a).alias(f"s{a}") for a in _AXES], "site",
    )
    return frontier.join(leaves, parents).select(*_AXES, *[f"s{a}" for a in _AXES], "site")


def nearest_great_circle(
    points: DataFrame, centroids: DataFrame, centroid_key: str, x: str = "longitude", y: str = "latitude",
    leaf_size: int = 32, radius: float = EARTH_RADIUS_KM,
) -> DataFrame:
    """Each point with the key of its nearest centroid and the great-circle ``distance`` to it, in units of ``radius``.

    Longitudes may be any number of degrees, so 180 and -180 are one meridian; latitudes go from -90 to 90. Points
    without such coordinates get NULLs, centroids without them take no part. Among centroids whose chords are equal to
    the last bit the smallest key wins. Only centroids of the few boxes that may hold the nearest one are paired with a
    point; positions closer than a box of the deepest level (about 12 m on the Earth) can fill a box beyond ``leaf_size``.
    """
    key_type = centroids.schema[centroid_key].dataType
    sites = _stored(
        _placed(centroids.where(_usable(x, y)), x, y).groupBy(*_AXES).agg(F.min(centroid_key).alias("site")), "sites"
    )
    nothing = {centroid_key: F.lit(None).cast(key_type), "distance": F.lit(None).cast("double")}
    if sites.isEmpty():
        return points.withColumns(nothing)
    located = _placed(points.where(_usable(x, y)), x, y)
    chord = F.sqrt(_sum([_square(F.col(a) - F.col(f"s{a}")) for a in _AXES]))
    pairs = _pairs(located.select(*_AXES).distinct(), sites, leaf_size)
    best = pairs.groupBy(*_AXES).agg(F.min(F.struct(chord.alias("d"), "site")).alias("_best")).select(
        *_AXES, F.col("_best.site").alias(centroid_key),
        (F.asin(F.least(F.col("_best.d") / 2, F.lit(1.0))) * 2 * radius).alias("distance"),
    )
    columns = [*points.columns, centroid_key, "distance"]
    matched = located.join(best, list(_AXES), "left").select(*columns)
    return matched.unionByName(points.where(~_usable(x, y)).withColumns(nothing).select(*columns))
