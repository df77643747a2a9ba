"""Person tracks: summaries, ranks and the multi-person gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelake import constants as K


def rank_tracks(boxes: DataFrame) -> DataFrame:
    """(clip_id, track_id, n_frames, area_median, rank): rank 0 has the largest median box area, then the least id."""
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    each = boxes.groupBy("clip_id", "track_id").agg(F.count("*").alias("n_frames"), F.percentile(area, 0.5).alias("area_median"))
    return each.withColumn("rank", F.row_number().over(Window.partitionBy("clip_id").orderBy(F.desc("area_median"), "track_id")) - 1)


def overlaps(boxes: DataFrame, ranks: DataFrame, person: int = 0) -> DataFrame:
    """(clip_id, track_id, n_overlap_frames): frames in which the track and the chosen one are both present."""
    chosen = ranks.where(F.col("rank") == person).select("clip_id", "track_id")
    frames = boxes.join(chosen, ["clip_id", "track_id"], "left_semi").select("clip_id", "frame_idx").distinct()
    return boxes.join(frames, ["clip_id", "frame_idx"], "left_semi").groupBy("clip_id", "track_id").agg(F.countDistinct("frame_idx").alias("n_overlap_frames"))


def summarise_tracks(boxes: DataFrame, person: int = 0) -> DataFrame:
    """A row a track: rank, frames, overlap with the chosen track, median area, its share of the chosen track's, median box.

    One grouping by track gives all medians; a clip's few tracks are then ranked in one window, which also tells the chosen one's area; one join counts overlaps."""
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    medians = {"area_median": area, **{f"{c}_median": F.col(c) for c in ("x1", "y1", "x2", "y2")}}
    each = boxes.groupBy("clip_id", "track_id").agg(F.count("*").alias("n_frames"), *(F.percentile(v, 0.5).alias(n) for n, v in medians.items()))
    clip = Window.partitionBy("clip_id")
    ranks = each.withColumn("rank", F.row_number().over(clip.orderBy(F.desc("area_median"), "track_id")) - 1).withColumn("_chosen", F.max(F.when(F.col("rank") == person, F.col("area_median"))).over(clip))
    out = ranks.join(overlaps(boxes, ranks, person), ["clip_id", "track_id"], "left")
    return out.withColumns({"n_overlap_frames": F.coalesce("n_overlap_frames", F.lit(0).cast("long")), "area_share": F.try_divide("area_median", "_chosen")}).drop("_chosen")


def classify_tracks(summary: DataFrame, clips: DataFrame, person: int = 0, overlap: float = K.OVERLAP_SHARE, area: float = K.AREA_SHARE) -> DataFrame:
    """summary with kind: chosen, subject or blip. A track whose overlap or area isn't known is a subject."""
    shared = F.try_divide(F.col("n_overlap_frames"), F.col("num_frames"))
    known = F.col("n_overlap_frames").isNotNull() & F.col("area_share").isNotNull() & (F.col("num_frames") > 0)
    kind = F.when(F.col("rank") == person, "chosen").when(~F.coalesce(known, F.lit(False)) | ((shared >= overlap) & (F.col("area_share") >= area)), "subject").otherwise("blip")
    return summary.join(clips.select("clip_id", "num_frames"), "clip_id", "left").withColumn("kind", kind)


def multi_person_gate(kinds: DataFrame, chosen_explicitly: bool = False) -> DataFrame:
    """(clip_id, n_tracks, subjects, blips, failed)."""
    out = kinds.groupBy("clip_id").agg(F.count("*").alias("n_tracks"), F.count_if(F.col("kind") == "subject").alias("subjects"), F.count_if(F.col("kind") == "blip").alias("blips"))
    return out.withColumn("failed", (F.col("subjects") > 0) & F.lit(not chosen_explicitly))
