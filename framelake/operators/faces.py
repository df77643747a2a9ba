"""Face boxes and eye rotations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def choose_box(df: DataFrame) -> DataFrame:
    """df (cache, landmarks, detector, carried) with box, its source and stale: a fresh cached box, else one from landmarks,
    else the detector's (which callers leave null where the clip has a cache), else a carried one, which is stale."""
    source = F.when(F.col("cache").isNotNull(), "cache").when(F.col("landmarks").isNotNull(), "landmarks").when(F.col("detector").isNotNull(), "detector").when(F.col("carried").isNotNull(), "carried")
    return df.withColumns({"box": F.coalesce("cache", "landmarks", "detector", "carried"), "source": source}).withColumn("stale", F.col("source") == "carried")


def eye_pose(faces: DataFrame, points: DataFrame) -> DataFrame:
    """(clip_id, frame_idx, rx, ry, rz): how far the iris landmarks (px, py) lie from the projected iris (vx, vy) of the face, over the box's side.

    faces: clip_id, frame_idx, camera s, tx, ty and box x1, y1, x2, y2. Boxes without a side give zero. Neither table is sent to all tasks: both have a row a frame or more."""
    j = points.join(faces.hint("merge"), ["clip_id", "frame_idx"])
    u = F.col("x1") + (F.col("s") * F.col("vx") + F.col("tx") + 1) / 2 * (F.col("x2") - F.col("x1"))
    v = F.col("y1") + (F.col("s") * F.col("vy") + F.col("ty") + 1) / 2 * (F.col("y2") - F.col("y1"))
    side = F.max(F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))
    out = j.groupBy("clip_id", "frame_idx").agg((F.avg("px") - F.avg(u)).alias("dx"), (F.avg("py") - F.avg(v)).alias("dy"), side.alias("side"))
    turn = lambda c: F.when(F.col("side") > 0, c / F.col("side") * 2).otherwise(0.0)
    return out.select("clip_id", "frame_idx", turn(-F.col("dy")).alias("rx"), turn(F.col("dx")).alias("ry"), F.lit(0.0).alias("rz"))
