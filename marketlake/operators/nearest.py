"""Exact nearest-neighbour join on a grid hierarchy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from marketlake.session import cut_lineage, scratch_path

_MAX_LEVEL = 20
_CUT_EVERY = 4
_BROADCAST_LEVEL = 4  # level 4 has at most 16**4 = 65,536 cells


def _square(column: Column) -> Column:
    return column * column


def _box_bounds() -> tuple[Column, Column]:
    """Smallest squared distance to a box, and one within which the box surely has a centroid."""
    near, to_near_face, to_far_face = {}, {}, {}
    for axis in ("u", "v"):
        at, low, high = F.col(axis), F.col(f"{axis}_low"), F.col(f"{axis}_high")
        near[axis] = _square(F.greatest(low - at, at - high, F.lit(0.0)))
        a, b = _square(at - low), _square(at - high)
        to_near_face[axis], to_far_face[axis] = F.least(a, b), F.greatest(a, b)
    # The boxes are tight, so each of their faces touches a centroid.
    surely = F.least(to_near_face["u"] + to_far_face["v"], to_near_face["v"] + to_far_face["u"])
    return near["u"] + near["v"], surely


def _stored_sites(centroids: DataFrame, key: str) -> tuple[DataFrame, dict]:
    """Distinct positions with their smallest key, stored once, and their number and extent, seen in passing."""
    seen = Observation("sites")
    sites = centroids.groupBy("u", "v").agg(F.min(key).alias("site")).observe(
        seen, F.count(F.lit(1)).alias("n"), F.min("u").alias("u0"), F.max("u").alias("u1"),
        F.min("v").alias("v0"), F.max("v").alias("v1"),
    )
    return _stored(sites, "sites"), seen.get


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _literal_rows(few: DataFrame) -> Column:
    """A handful of rows as one array, so that taking all of them needs no join."""
    types = {f.name: f.dataType for f in few.schema.fields}
    return F.array(*[
        F.struct(*[F.lit(r[c]).cast(t).alias(c) for c, t in types.items()]) for r in few.collect()
    ])


def _leaf_pairs(spots: DataFrame, sites: DataFrame, extent: dict, leaf_size: int) -> DataFrame:
    """(u, v, su, sv, site): each spot with the positions of the cells its nearest one may be in."""
    width = max(extent["u1"] - extent["u0"], extent["v1"] - extent["v0"]) or 1.0

    def cell(axis: str, low: float) -> Column:
        steps = 4**_MAX_LEVEL
        return F.least(F.floor((F.col(axis) - low) / width * steps), F.lit(steps - 1)).cast("bigint")

    sites = sites.withColumns({"cu": cell("u", extent["u0"]), "cv": cell("v", extent["v0"])})
    # The boxes of every level come from one pass. Their counts show how deep the grid must be.
    level = F.explode(F.sequence(F.lit(1), F.lit(_MAX_LEVEL))).alias("level")
    boxes = _stored(
        sites.select("u", "v", "cu", "cv", level)
        .groupBy(
            "level", F.expr(f"shiftright(cu, 2 * ({_MAX_LEVEL} - level))").alias("nu"),
            F.expr(f"shiftright(cv, 2 * ({_MAX_LEVEL} - level))").alias("nv"),
        ).agg(
            F.min("u").alias("u_low"), F.max("u").alias("u_high"), F.min("v").alias("v_low"),
            F.max("v").alias("v_high"), F.count(F.lit(1)).alias("n"),
        ), "boxes",
    )
    fullest = dict(tuple(r) for r in boxes.groupBy("level").agg(F.max("n")).collect())  # a row per level
    depth = min((lv for lv, n in fullest.items() if n <= leaf_size), default=_MAX_LEVEL)

    near, surely = _box_bounds()
    per_spot = Window.partitionBy("u", "v")
    bounds = ["u_low", "u_high", "v_low", "v_high"]
    first = _literal_rows(boxes.where("level = 1").select("nu", "nv", *bounds))  # at most 16
    frontier = spots.select("u", "v", F.explode(first).alias("_b")).select("u", "v", "_b.*")
    for step in range(1, depth + 1):
        if step > 1:
            children = boxes.where(F.col("level") == step).select(
                F.shiftright("nu", 2).alias("gu"), F.shiftright("nv", 2).alias("gv"), "nu", "nv", *bounds
            )
            if step <= _BROADCAST_LEVEL:
                children = F.broadcast(children)
            frontier = frontier.join(children, ["gu", "gv"])
        frontier = (
            frontier.withColumn("_near", near)
            .withColumn("_bound", F.min(surely).over(per_spot))
            # A hair of slack keeps rounding from dropping an exact tie.
            .where(F.col("_near") <= F.col("_bound") * (1 + 1e-12))
            .select("u", "v", F.col("nu").alias("gu"), F.col("nv").alias("gv"))
        )
        if step % _CUT_EVERY == 0 and step < depth:
            frontier = cut_lineage(frontier)
    leaves = sites.select(
        F.shiftright("cu", 2 * (_MAX_LEVEL - depth)).alias("gu"), F.shiftright("cv", 2 * (_MAX_LEVEL - depth)).alias("gv"),
        F.col("u").alias("su"), F.col("v").alias("sv"), "site",
    )
    return frontier.join(leaves, ["gu", "gv"]).select("u", "v", "su", "sv", "site")


def nearest_join(
    points: DataFrame,
    centroids: DataFrame,
    centroid_key: str,
    x: str = "longitude",
    y: str = "latitude",
    x_scale: float = 1.0,
    leaf_size: int = 32,
) -> DataFrame:
    """Each point with the key of its nearest centroid and the ``distance`` to it.

    Distance is planar, in degrees, with ``x`` scaled by ``x_scale`` (the cosine of the
    region's latitude makes it true to scale). Among equally near centroids the smallest
    key wins. Points without coordinates get NULLs.

    The centroids' extent is split 4 x 4 again and again until no cell holds more than
    ``leaf_size`` distinct positions. Distinct point positions then walk down that grid: an
    equi-join fetches the up to 16 children of the cells still in question, and cells that
    are surely farther than another one are dropped. Pairs of points and single centroids
    arise only in the few leaf cells left, so crowded cells stay cheap and the answer needs
    no search radius. Cells are at most 4**20 times smaller than the extent, which is finer
    than coordinates of eight decimal places; only positions closer than that can fill a leaf
    beyond ``leaf_size``, and the answer is exact then, too.
    """
    def place(df: DataFrame) -> DataFrame:
        return df.withColumns({"u": F.col(x).cast("double") * x_scale, "v": F.col(y).cast("double")})

    located = F.col("u").isNotNull() & F.col("v").isNotNull()
    key_type = centroids.schema[centroid_key].dataType
    sites, extent = _stored_sites(place(centroids).where(located), centroid_key)
    if extent["n"] == 0:
        return points.withColumn(centroid_key, F.lit(None).cast(key_type)).withColumn(
            "distance", F.lit(None).cast("double")
        )
    spots = place(points).where(located).select("u", "v").distinct()
    squared = _square(F.col("u") - F.col("su")) + _square(F.col("v") - F.col("sv"))
    if extent["n"] <= leaf_size:
        few = _literal_rows(sites.select(F.col("u").alias("su"), F.col("v").alias("sv"), "site"))
        pairs = spots.select("u", "v", F.explode(few).alias("_s")).select("u", "v", "_s.*")
    else:
        pairs = _leaf_pairs(spots, sites, extent, leaf_size)
    best = (
        pairs.groupBy("u", "v")
        .agg(F.min(F.struct(squared.alias("d2"), "site")).alias("_best"))
        .select("u", "v", F.col("_best.site").alias(centroid_key), F.sqrt("_best.d2").alias("distance"))
    )
    placed = place(points)
    columns = [*points.columns, centroid_key, "distance"]
    matched = placed.where(located).join(best, ["u", "v"], "left").select(*columns)
    unplaced = placed.where(~located).select(
        *points.columns, F.lit(None).cast(key_type).alias(centroid_key), F.lit(None).cast("double").alias("distance")
    )
    return matched.unionByName(unplaced)
