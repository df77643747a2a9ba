"""A steady crop around a clip's subject."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake import constants as K


def sampled(frames: DataFrame, clips: DataFrame, most: int = K.CROP_FRAMES) -> DataFrame:
    """The frames of clips (clip_id, num_frames; start, if the clip's excerpt doesn't begin at 0) to look at: every max(1, num_frames div most)-th from the start on.

    Frames are dealt by clip and meet a hash table of their share of the clips, so they are neither sent to all tasks nor sorted."""
    about = clips.select("clip_id", F.col("num_frames").alias("_n"), (F.col("start") if "start" in clips.columns else F.lit(0)).alias("_from"))
    place = F.col("frame_idx") - F.col("_from")
    out = frames.join(about.hint("shuffle_hash"), "clip_id").where((place >= 0) & (place < F.col("_n")) & (place % F.greatest(F.lit(1), F.expr(f"_n div {most}")) == 0))
    return out.drop("_n", "_from")


def subject_crop(points: DataFrame, fx: float, fy: float, cx: float, cy: float, width: int, height: int, least: int = K.CROP_POINTS, pad: float = 0.15) -> DataFrame:
    """(clip_id, x0, y0, x1, y1) from points (clip_id, frame_idx, x, y, z): each frame's bounds of the points in front of the
    camera, where there are enough; the 5th percentile of the lows and the 95th of the highs; padded, cut at the frame, at
    least 16 pixels and of even sides."""
    seen = points.where("z > 1e-3").select("clip_id", "frame_idx", (F.col("x") / F.col("z") * fx + cx).alias("u"), (F.col("y") / F.col("z") * fy + cy).alias("v"))
    ok = ~(F.isnan("u") | F.isnan("v") | (F.abs("u") == float("inf")) | (F.abs("v") == float("inf")))
    frames = seen.groupBy("clip_id", "frame_idx").agg(F.count("*").alias("n"), F.count_if(ok).alias("m"), *(f(F.when(ok, F.col(c))).alias(a) for f, c, a in ((F.min, "u", "lx"), (F.min, "v", "ly"), (F.max, "u", "hx"), (F.max, "v", "hy"))))
    b = frames.where(f"n >= {least} AND m >= {least}").groupBy("clip_id").agg(*(F.percentile(c, q).alias(c) for c, q in (("lx", 0.05), ("ly", 0.05), ("hx", 0.95), ("hy", 0.95))))
    b = b.withColumn("p", pad * F.greatest(F.col("hx") - F.col("lx"), F.col("hy") - F.col("ly")))
    low = lambda c: F.greatest(F.lit(0.0), F.col(c) - F.col("p")).cast("int")
    high = lambda c, m: F.least(F.lit(float(m)), F.col(c) + F.col("p")).cast("int")
    c = b.select("clip_id", low("lx").alias("x0"), low("ly").alias("y0"), high("hx", width).alias("x1"), high("hy", height).alias("y1"))
    c = c.withColumns({"x1": F.least(F.lit(width), F.greatest(F.col("x0") + 16, "x1")), "y1": F.least(F.lit(height), F.greatest(F.col("y0") + 16, "y1"))})
    return c.withColumns({"x1": F.col("x1") - (F.col("x1") - F.col("x0")) % 2, "y1": F.col("y1") - (F.col("y1") - F.col("y0")) % 2})
