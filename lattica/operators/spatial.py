"""The tabular side of spatial assays: relabelling, assignment, nearest cells, counts.

These follow the contracts of the segmentation steps, not their algorithms: no
image or probabilistic segmentation is done here. Tables: transcripts
(transcript_id, gene, x, y), cells (cell_id, x, y), polygons (cell_id, z, ring).

Joins by position are equality joins on grid squares. Both sides come straight from
a shuffle and nothing is kept together after, so the adaptive planner splits crowded
squares (spark.sql.adaptive.skewJoin) and broadcasts a small side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def relabel(transcripts: DataFrame, panel: DataFrame) -> DataFrame:
    """transcripts with `label`: the panel's (gene, label), else the gene itself."""
    return transcripts.join(panel.select("gene", F.col("label").alias("_l")), "gene", "left").withColumn("label", F.coalesce("_l", F.col("gene").cast("string"))).drop("_l")


def assign_by_table(transcripts: DataFrame, assignment: DataFrame) -> DataFrame:
    """transcripts with the cell_id of (transcript_id, cell_id), null if unassigned."""
    return transcripts.join(assignment.select("transcript_id", "cell_id"), "transcript_id", "left")


def affine(points: DataFrame, m: tuple[tuple[float, float, float], tuple[float, float, float]]) -> DataFrame:
    """points with x, y moved by a 2 x 3 matrix."""
    (a, b, c), (d, e, f) = m
    return points.withColumns({"x": F.col("x") * a + F.col("y") * b + c, "y": F.col("x") * d + F.col("y") * e + f})


def _grid(c: Column, side: float) -> Column:
    return F.floor(c / F.lit(side)).cast("long")


def nearest_cell(transcripts: DataFrame, cells: DataFrame, distance: float) -> DataFrame:
    """(transcript_id, cell_id, dist) of the nearest cell within a distance; ties go to the smaller cell.

    Cells are listed in the nine grid squares around them, so the join is on equal
    squares; the best cell is an aggregate, combined before the shuffle.
    """
    side = float(distance) if distance > 0 else 1.0
    near = cells.select("cell_id", F.col("x").alias("cx"), F.col("y").alias("cy"))
    around = F.array(*[F.struct((_grid(F.col("cx"), side) + i).alias("gx"), (_grid(F.col("cy"), side) + j).alias("gy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    near = near.withColumn("_g", F.explode(around)).select("cell_id", "cx", "cy", "_g.gx", "_g.gy")
    points = transcripts.select("transcript_id", "x", "y", _grid(F.col("x"), side).alias("gx"), _grid(F.col("y"), side).alias("gy"))
    dist = F.sqrt((F.col("x") - F.col("cx")) * (F.col("x") - F.col("cx")) + (F.col("y") - F.col("cy")) * (F.col("y") - F.col("cy")))
    found = points.join(near, ["gx", "gy"]).withColumn("dist", dist).where(F.col("dist") <= distance)
    return found.groupBy("transcript_id").agg(F.min(F.struct("dist", "cell_id")).alias("b")).select("transcript_id", "b.cell_id", "b.dist")


def in_boxes(transcripts: DataFrame, boxes: DataFrame, side: float) -> DataFrame:
    """(transcript_id, cell_id) of points in boxes (cell_id, x0, y0, x1, y1), the upper bounds exclusive."""
    squares = F.sequence(_grid(F.col("x0"), side), _grid(F.col("x1"), side))
    listed = boxes.withColumn("gx", F.explode(squares)).withColumn("gy", F.explode(F.sequence(_grid(F.col("y0"), side), _grid(F.col("y1"), side))))
    points = transcripts.select("transcript_id", "x", "y", _grid(F.col("x"), side).alias("gx"), _grid(F.col("y"), side).alias("gy"))
    return points.join(listed, ["gx", "gy"]).where("x >= x0 and x < x1 and y >= y0 and y < y1").select("transcript_id", "cell_id")


def in_polygons(transcripts: DataFrame, polygons: DataFrame, side: float) -> DataFrame:
    """(transcript_id, cell_id) of points in polygons (cell_id, ring array<struct<x, y>>): grid squares, then the even-odd rule."""
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    boxes = polygons.withColumns({"x0": F.array_min(xs), "x1": F.array_max(xs), "y0": F.array_min(ys), "y1": F.array_max(ys)})
    listed = boxes.withColumn("gx", F.explode(F.sequence(_grid(F.col("x0"), side), _grid(F.col("x1"), side)))).withColumn("gy", F.explode(F.sequence(_grid(F.col("y0"), side), _grid(F.col("y1"), side))))
    points = transcripts.select("transcript_id", "x", "y", _grid(F.col("x"), side).alias("gx"), _grid(F.col("y"), side).alias("gy"))
    j = points.join(listed, ["gx", "gy"]).where("x between x0 and x1 and y between y0 and y1")
    crossed = F.expr("""
        aggregate(sequence(0, size(ring) - 1), 0, (n, i) ->
          n + CASE WHEN (ring[i].y > y) <> (ring[(i + 1) % size(ring)].y > y)
               AND x < (ring[(i + 1) % size(ring)].x - ring[i].x) * (y - ring[i].y) / (ring[(i + 1) % size(ring)].y - ring[i].y) + ring[i].x
              THEN 1 ELSE 0 END)""")
    return j.where(crossed % 2 == 1).select("transcript_id", "cell_id")


def counts(assigned: DataFrame, weight: Column | None = None) -> DataFrame:
    """(cell_id, gene, value): expected counts, the sum of the weights (1, if none) of assigned transcripts."""
    return assigned.where("cell_id is not null").groupBy("cell_id", "gene").agg(F.sum(weight if weight is not None else F.lit(1.0)).alias("value"))


def wide(count_table: DataFrame, genes: list) -> DataFrame:
    """A column for each of the genes."""
    return count_table.groupBy("cell_id").pivot("gene", genes).agg(F.sum("value"))


def cell_metadata(assigned: DataFrame) -> DataFrame:
    return assigned.where("cell_id is not null").groupBy("cell_id").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.count(F.lit(1)).alias("n"))


def gene_metadata(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("gene").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cell_id").isNotNull()).alias("n_assigned"))


def rates(count_table: DataFrame, exposure: DataFrame) -> DataFrame:
    """(cell_id, gene, rate): counts over the exposure (cell_id, volume); a maximum-likelihood stand-in."""
    return count_table.join(exposure, "cell_id").select("cell_id", "gene", (F.col("value") / F.col("volume")).alias("rate"))


def segmented_features(features: DataFrame) -> DataFrame:
    """(cell_id, geometry) of cell features only; the nucleus's geometry is preferred."""
    return features.where("objectType = 'cell'").select("cell_id", F.coalesce("nucleusGeometry", "geometry").alias("geometry"))


def _partial_hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The convex hull, counter-clockwise from the leftmost point, by a sweep over sorted points."""
    points = sorted(set(points))
    if len(points) < 3:
        return points
    hull: list[tuple[float, float]] = []
    for chain in (points, points[-2::-1]):
        floor = len(hull)
        for p in chain:
            while len(hull) - floor >= (2 if floor == 0 else 1):
                (ax, ay), (bx, by) = hull[-2], hull[-1]
                if (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax) > 0:
                    break
                hull.pop()
            hull.append(p)
    return hull[:-1]


def hulls(assigned: DataFrame, *by: str) -> DataFrame:
    """(by..., ring): the convex hull of each group's points (by z as well: one for each layer).

    Each batch is reduced to the hulls of its groups first, so only hull points are
    shuffled, and a large group never meets in one task as a whole.
    """
    import pandas as pd

    by = by or ("cell_id",)
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in assigned.schema.fields if f.name in by)

    def partly(batches):  # noqa: ANN001, ANN202
        for pdf in batches:
            parts = [pd.DataFrame({**dict(zip(by, k if isinstance(k, tuple) else (k,))), "x": [p[0] for p in h], "y": [p[1] for p in h]}) for k, g in pdf.groupby(list(by), sort=False) if (h := _partial_hull(list(zip(g["x"], g["y"]))))]
            yield pd.concat(parts) if parts else pdf.iloc[:0][[*by, "x", "y"]]

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        ring = [{"x": x, "y": y} for x, y in _partial_hull(list(zip(pdf["x"], pdf["y"])))]
        return pd.DataFrame({**{b: [pdf[b].iloc[0]] for b in by}, "ring": [ring]})

    some = assigned.where(" and ".join(f"{b} is not null" for b in by)).select(*by, "x", "y").mapInPandas(partly, f"{keys}, x double, y double")
    return some.groupBy(*by).applyInPandas(merged, f"{keys}, ring array<struct<x: double, y: double>>")


def prepared(metadata: DataFrame) -> DataFrame:
    """Transcript metadata in the layout that import expects."""
    return metadata.select("transcript_id", F.col("cell_id").alias("cell"), F.col("gene").cast("string").alias("gene"), "x", "y", F.col("cell_id").isNull().alias("is_noise"))


def geojson(polygons: DataFrame) -> DataFrame:
    """(cell_id, feature): a GeoJSON polygon of each ring, closed."""
    point = F.transform(F.concat("ring", F.slice("ring", 1, 1)), lambda p: F.array(p["x"], p["y"]))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(point).alias("coordinates"))
    return polygons.select("cell_id", F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.col("cell_id").alias("cell")).alias("properties"), geometry.alias("geometry"))).alias("feature"))


def import_options(df: DataFrame) -> DataFrame:
    """df with `problem`: assignment excludes nuclei and cells and needs polygons, expansion is 0 to 100, the filter not negative."""
    given = {c: F.coalesce(F.length(c) > 0, F.lit(False)) for c in ("transcript_assignment", "viz_polygons", "nuclei", "cells")}
    problem = F.coalesce(
        F.when(given["transcript_assignment"] & (given["nuclei"] | given["cells"]), F.lit("transcript_assignment excludes nuclei and cells")),
        F.when(given["transcript_assignment"] & ~given["viz_polygons"], F.lit("transcript_assignment needs viz_polygons")),
        F.when(~F.col("expansion_distance").between(0, 100), F.lit("expansion_distance must be 0 to 100")),
        F.when(F.col("dapi_filter") < 0, F.lit("dapi_filter must not be negative")),
    )
    return df.withColumn("problem", problem)
