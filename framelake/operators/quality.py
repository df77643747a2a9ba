"""Non-finite guards, coverage, quality gates and run states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake import constants as K
from framelake.functions.arrays import finite
from framelake.functions.numbers import fused


def nonfinite_frames(df: DataFrame, columns: dict[str, str | None]) -> DataFrame:
    """(clip_id, frame_idx) of frames where one of the array columns holds NaN or infinity while its weight column, if named, is true or over 0."""
    def bad(column: str, weight: str | None) -> Column:
        if not weight:
            return ~finite(F.col(column))
        w = F.col(weight)
        return ~finite(F.col(column)) & (w if df.schema[weight].dataType.typeName() == "boolean" else w > 0)

    any_bad = F.lit(False)
    for c, w in columns.items():
        any_bad = any_bad | F.coalesce(bad(c, w), F.lit(False))
    return df.where(any_bad).select("clip_id", "frame_idx").distinct()


def union_bad_frames(*tables: tuple[DataFrame, dict[str, str | None]]) -> DataFrame:
    """(clip_id, frame_idx) of frames that are bad, as above, in any of several tables with their columns and weights."""
    bad = [nonfinite_frames(df, columns) for df, columns in tables]
    out = bad[0]
    for more in bad[1:]:
        out = out.unionByName(more)
    return out.distinct()


def nonfinite_report(df: DataFrame, columns: dict[str, str | None], first: int = 10) -> DataFrame:
    """(clip_id, n, frames): how many frames aren't finite, and the first of them. Each clip keeps its least frames only."""
    from pyspark.sql import Window

    bad = nonfinite_frames(df, columns)
    n = bad.groupBy("clip_id").agg(F.count("*").alias("n"))
    few = bad.withColumn("_k", F.row_number().over(Window.partitionBy("clip_id").orderBy("frame_idx"))).where(F.col("_k") <= first)
    return n.join(few.groupBy("clip_id").agg(F.array_sort(F.collect_list("frame_idx")).alias("frames")), "clip_id")


def coverage(df: DataFrame, masks: list[str]) -> DataFrame:
    """(clip_id, num_frames, a mean for each mask; 0 for a mask the table hasn't)."""
    share = lambda m: F.avg(F.coalesce(F.col(m), F.lit(False)).cast("double")) if m in df.columns else F.lit(0.0)
    return df.groupBy("clip_id").agg(F.count("*").alias("num_frames"), *(share(m).alias(m) for m in masks))


def hand_gate(df: DataFrame, least: float = K.HAND_GATE) -> DataFrame:
    """(clip_id, coverage, no_hands): the mean of the two hands' coverages, and whether it is under the least that a clip needs for its hands to be used."""
    c = coverage(df, ["left_valid", "right_valid"]).select("clip_id", ((F.col("left_valid") + F.col("right_valid")) / 2).alias("coverage"))
    return c.withColumn("no_hands", F.col("coverage") < least)


def loss_stats(df: DataFrame, loss: str, share: float = K.SOLVED_SHARE, median: float = K.SOLVED_MEDIAN, strict: bool = False) -> DataFrame:
    """(clip_id, median, p95, largest, covered, solved) of the losses over 0; covered is their share of all frames.

    A clip is solved with at least so large a share and a median under the given one. With strict, a clip that isn't fails the job that reads solved, naming it.
    The losses on both sides of a quantile are found by rank, in one exchange by clip, and mixed as DuckDB's quantile_cont does, which rounds once less than F.percentile."""
    from pyspark.sql import Window

    clip, place = Window.partitionBy("clip_id"), {q: (F.col("_n") - 1) * q for q in (0.5, 0.95)}
    over = df.select("clip_id", F.when(F.col(loss) > 0, F.col(loss)).alias("_l"))
    ranked = over.withColumn("_n", F.count("_l").over(clip)).withColumn("_k", F.row_number().over(clip.orderBy(F.asc_nulls_last("_l"))) - 1)
    beside = [F.max(F.when(F.col("_k") == side(p), F.col("_l"))).cast("double") for p in place.values() for side in (F.floor, F.ceil)]
    out = ranked.groupBy("clip_id").agg(F.array(*beside).alias("_b"), F.max("_n").alias("_n"), F.max("_l").alias("largest"), (F.count("_l") / F.count("*")).alias("covered"))

    def mixed(q: float, low: Column, high: Column) -> Column:
        part = place[q] - F.floor(place[q])
        return F.when(part == 0, low).otherwise(fused(low, 1 - part, high * part))

    b = F.col("_b")
    out = out.select("clip_id", mixed(0.5, b[0], b[1]).alias("median"), mixed(0.95, b[2], b[3]).alias("p95"), "largest", "covered")
    ok = F.coalesce((F.col("covered") >= share) & (F.col("median") < median), F.lit(False))
    if strict:
        ok = F.when(ok, ok).otherwise(F.raise_error(F.concat(F.lit("clip "), F.col("clip_id").cast("string"), F.lit(" isn't solved"))).cast("boolean"))
    return out.withColumn("solved", ok)


def quality_report(clips: DataFrame) -> DataFrame:
    """clips with warnings, failures and status.

    clips: readable, hands_on, face_on, gaze_on, has_detections, hands, face, gaze (coverages), ik_coverage. An unreadable clip
    fails and nothing else is said of it. A stage that is off is skipped. Hands on without detections fail, as does an absent ik_coverage; low coverages warn."""
    on = {"hands": F.col("hands_on"), "face": F.col("face_on"), "gaze": F.col("gaze_on")}
    low = [F.when(on[k] & (F.col(k) < K.COVERAGE[k]), F.lit(f"low {k} coverage")) for k in on]
    low.append(F.when(on["hands"] & (F.col("ik_coverage") < K.IK_WARN), F.lit("low arm coverage")))
    bad = [F.when(on["hands"] & ~F.col("has_detections"), F.lit("no hand detections")), F.when(on["hands"] & F.col("ik_coverage").isNull(), F.lit("no arm solution"))]
    none = F.array().cast("array<string>")
    out = clips.withColumns({"failures": F.when(~F.col("readable"), F.array(F.lit("unreadable"))).otherwise(F.array_compact(F.array(*bad))), "warnings": F.when(~F.col("readable"), none).otherwise(F.array_compact(F.array(*low)))})
    return out.withColumn("status", F.when(F.size("failures") > 0, "FAILED").when(F.size("warnings") > 0, "WARN").otherwise("OK"))


def run_state(markers: DataFrame) -> DataFrame:
    """(clip_id, state) from marker rows (clip_id, kind SUCCESS or FAILED, stage, reason); a clip with neither kind was never attempted, one with both is inconsistent."""
    each = markers.groupBy("clip_id").agg(F.count_if(F.col("kind") == "SUCCESS").alias("_s"), F.count_if(F.col("kind") == "FAILED").alias("_f"), F.min(F.when(F.col("kind") == "FAILED", F.struct("stage", "reason"))).alias("_r"))
    state = F.when((F.col("_s") > 0) & (F.col("_f") > 0), "inconsistent").when(F.col("_s") > 0, "SUCCESS").when(F.col("_f") > 0, F.concat(F.lit("FAILED("), F.col("_r.stage"), F.lit(", "), F.col("_r.reason"), F.lit(")"))).otherwise("never attempted")
    return each.select("clip_id", state.alias("state"))
