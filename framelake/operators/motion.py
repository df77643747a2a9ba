"""Velocity, the highest-motion window and depth outliers of clips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake import constants as K
from framelake.functions.arrays import l1


def velocity(df: DataFrame, pose: Column, valid: Column, by=("clip_id",), frame: str = "frame_idx") -> DataFrame:
    """df with velocity: the L1 difference from the frame before, 0 for the first, times the later frame's validity."""
    before = F.lag(pose).over(Window.partitionBy(*by).orderBy(frame))
    return df.withColumn("velocity", F.coalesce(l1(pose, before), F.lit(0.0)) * valid.cast("double"))


def window_scores(df: DataFrame, length: Column, value: str = "velocity") -> DataFrame:
    """(clip_id, start, score): the mean of value over each full window of length frames, by differences of prefix sums; frames count from 0 without gaps."""
    sums = F.sum(value).over(Window.partitionBy("clip_id").orderBy("frame_idx").rowsBetween(Window.unboundedPreceding, 0))
    each = df.select("clip_id", "frame_idx", length.alias("n"), sums.alias("s"))
    ends = each.select("clip_id", (F.col("frame_idx") - F.col("n") + 1).alias("start"), "n", F.col("s").alias("high")).where("start >= 0")
    lows = each.select("clip_id", (F.col("frame_idx") + 1).alias("start"), F.col("s").alias("low"))
    return ends.join(lows, ["clip_id", "start"], "left").select("clip_id", "start", "n", ((F.col("high") - F.coalesce("low", F.lit(0.0))) / F.col("n")).alias("score"))


def best_window(scores: DataFrame, digits: int = 9) -> DataFrame:
    """(clip_id, start, n, score, mean_score): the first window of the greatest score, scores taken as equal that agree to so many digits."""
    first = F.max(F.struct(F.round("score", digits).alias("score"), (-F.col("start")).alias("back"), "n"))
    return scores.groupBy("clip_id").agg(first.alias("b"), F.avg("score").alias("mean_score")).select("clip_id", (-F.col("b.back")).alias("start"), F.col("b.n").alias("n"), F.col("b.score").alias("score"), "mean_score")


def flag_depth(df: DataFrame, z: str, size: str | None = None, floor: float = K.DEPTH_FLOOR, stds: float = K.DEPTH_STDS, far: float = K.DEPTH_FAR) -> DataFrame:
    """df with depth_outlier: size over depth off its clip's median by over stds deviations, or depth over far medians. A clip with a NaN flags nothing; rows of no clip go.

    A clip's figures come from a window over it, in one exchange by clip: no table of frames is sent to all tasks."""
    ratio = (F.col(size) if size else F.lit(None).cast("double")) / F.greatest(F.col(z), F.lit(floor))
    clip = Window.partitionBy("clip_id")
    stats = {"_med": F.percentile("_r", 0.5), "_std": F.stddev_pop("_r"), "_zmed": F.percentile(z, 0.5), "_nan": F.bool_or(F.isnan(z))}
    x = df.where("clip_id IS NOT NULL").withColumn("_r", ratio).withColumns({c: v.over(clip) for c, v in stats.items()})
    off = F.coalesce(F.abs(F.col("_r") - F.col("_med")) > stds * F.col("_std"), F.lit(False))
    return x.withColumn("depth_outlier", ~F.col("_nan") & (off | (F.col(z) > far * F.col("_zmed")))).drop("_r", "_med", "_std", "_zmed", "_nan")
