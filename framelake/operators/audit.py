"""Sources against outputs, alignment, frame rates, repairs, rebuild plans and golden comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake import constants as K

KEYS = ["session", "condition", "name"]


def audit(sources: DataFrame, outputs: DataFrame, finished: DataFrame) -> DataFrame:
    """A row for each source or output with status ok, unsynced (finished elsewhere), NOT-DONE or orphan."""
    s, o = (d.select(*KEYS).distinct().withColumn(m, F.lit(True)) for d, m in ((sources, "_s"), (outputs, "_o")))
    out = s.join(o, KEYS, "full_outer").join(finished.select("name").distinct().withColumn("_f", F.lit(True)), "name", "left")
    status = F.when(F.col("_s").isNull(), "orphan").when(F.col("_o"), "ok").when(F.col("_f"), "unsynced").otherwise("NOT-DONE")
    return out.select(*KEYS, status.alias("status"))


def rollup_counts(sources: DataFrame, outputs: DataFrame) -> DataFrame:
    """(session, condition, source, output, excerpt, gap): a row each, and a TOTAL row; an excerpt counts only with its output, and conditions without a source are left out.

    Without any source the job fails: nothing would be missing then, whatever there is."""
    rows = sources.select(*KEYS).distinct().withColumn("_s", F.lit(1)).join(outputs.select(*KEYS, "excerpt").withColumn("_o", F.lit(1)), KEYS, "left")
    # A row of no source, so that there is a total to check even if nothing else is there.
    blank = sources.sparkSession.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) if f.name != "_s" else F.lit(0).alias("_s") for f in rows.schema.fields))
    rows = rows.unionByName(blank)
    counts = rows.rollup("session", "condition").agg(F.sum("_s").alias("source"), F.count("_o").alias("output"), F.count_if(F.col("excerpt")).alias("excerpt"), F.grouping_id().alias("_g")).where("_g = 3 OR _g = 0 AND source > 0")
    counts = counts.withColumn("source", F.when(F.col("source") > 0, F.col("source")).otherwise(F.raise_error(F.lit("there is no source at all: look at the path")).cast("long")))
    return counts.select(*(F.when(F.col("_g") == 3, "TOTAL").otherwise(F.col(c)).alias(c) for c in ("session", "condition")), "source", "output", "excerpt", (F.col("source") != F.col("output")).alias("gap"))


def alignment(clips: DataFrame, videos: DataFrame) -> DataFrame:
    """clips (clip_id, num_frames) with delta = video frames - clip frames and status aligned, differs, not checked or missing."""
    v = videos.select("clip_id", "nb_frames", F.lit(True).alias("_v"))
    out = clips.join(v, "clip_id", "left").withColumn("delta", F.col("nb_frames") - F.col("num_frames"))
    return out.withColumn("status", F.when(F.col("_v").isNull(), "missing").when(F.col("nb_frames").isNull(), "not checked").when(F.col("delta") == 0, "aligned").otherwise("differs")).drop("_v", "nb_frames")


def backfill_fps(clips: DataFrame, videos: DataFrame) -> DataFrame:
    """clips with fps filled from videos (clip_id, video_fps) where missing or not positive, and outcome already, todo or unmatched. Applied again it changes nothing."""
    out = clips.join(videos.select("clip_id", "video_fps"), "clip_id", "left")
    has = F.coalesce(F.col("fps") > 0, F.lit(False))
    return out.withColumns({"outcome": F.when(has, "already").when(F.col("video_fps").isNull(), "unmatched").otherwise("todo"), "fps": F.when(has, F.col("fps")).otherwise(F.coalesce("video_fps", "fps"))}).drop("video_fps")


def repair_status(a: Column, b: Column, region: tuple[int, int] = (15, 21), region_tol: float = 1e-5) -> Column:
    """Of one frame's arrays: missing, shape, ok, refuse (they differ outside the region of joints) or needs-repair."""
    low, high = region[0] * 3, region[1] * 3
    close = ~F.exists(F.zip_with(a, b, lambda x, y: F.abs(x - y) > 1e-8 + 1e-5 * F.abs(y)), lambda x: x)
    outside = F.exists(F.filter(F.zip_with(a, b, lambda x, y: F.abs(x - y)), lambda x, i: (i < low) | (i >= high)), lambda x: x > region_tol)
    return F.when(a.isNull() | b.isNull(), "missing").when(F.size(a) != F.size(b), "shape").when(close, "ok").when(outside, "refuse").otherwise("needs-repair")


def classify_repairs(df: DataFrame, a: str, b: str, region: tuple[int, int] = (15, 21)) -> DataFrame:
    """(clip_id, status, worst): the gravest status among a clip's frames, and the largest difference."""
    grave = F.create_map(*(x for k, s in enumerate(("ok", "needs-repair", "refuse", "shape", "missing")) for x in (F.lit(s), F.lit(k))))
    each = df.select("clip_id", repair_status(F.col(a), F.col(b), region).alias("s"), F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y))).alias("d"))
    return each.groupBy("clip_id").agg(F.max(F.struct(grave[F.col("s")].alias("g"), F.col("s").alias("status"))).alias("m"), F.max("d").alias("worst")).select("clip_id", "m.status", "worst")


def apply_repairs(df: DataFrame, status: DataFrame, a: str, b: str, dry_run: bool = True) -> DataFrame:
    """df with a replaced by b in the clips that need it, or as it is in a dry run."""
    if dry_run:
        return df
    need = status.where(F.col("status") == "needs-repair").select("clip_id", F.lit(True).alias("_need"))
    return df.join(need, "clip_id", "left").withColumn(a, F.when(F.col("_need"), F.col(b)).otherwise(F.col(a))).drop("_need")


def rebuild_plan(df: DataFrame, changed: Column, state: Column) -> DataFrame:
    """df with action and reason. state: missing, no stamp, unreadable, not an object, broken, unknown or fine; changed: sorted keys that differ."""
    bad = ("missing", "no stamp", "unreadable", "not an object")
    reason = (
        F.when(state.isin(*bad), state)
        .when((F.size(changed) == 1) & (F.get(changed, F.lit(0)) == "code"), "code changed")
        .when(F.size(changed) > 0, F.concat(F.lit("changed: "), F.array_join(changed, ", ")))
        .when(state == "broken", "broken")
        .when(state == "unknown", "not verified")
        .otherwise("")
    )
    return df.withColumn("reason", reason).withColumn("action", F.when(F.col("reason").isin("", "not verified"), "skip").otherwise("rebuild"))


def tolerance_of(key: Column, wide: bool = False) -> Column:
    """The tolerance of the first family whose name the key contains."""
    out = F.lit(K.TOLERANCES[-1][2 if wide else 1])
    for family, tight, loose in reversed(K.TOLERANCES[:-1]):
        out = F.when(key.contains(family), loose if wide else tight).otherwise(out)
    return out


def verdict(same: Column, usable: Column, bad_tight: Column, bad_wide: Column) -> Column:
    return F.when(~usable, "unusable").when(same, F.when(bad_tight > 0, "fail").otherwise("pass")).when(bad_wide > 0, "fail").otherwise("skip")


def attribute_samples(samples: DataFrame, stages: DataFrame) -> DataFrame:
    """samples (run_id, ts, ...) with the stage running then: the last one begun, if not ended. Stages of a run don't overlap, so one ordered pass replaces a range join;
    of stages that begin at once the longest counts, as the others end where they begin."""
    from pyspark.sql import Window

    kept = samples.columns
    both = samples.withColumns({"_stage": F.lit(None).cast("struct<stage:string,end_ts:timestamp_ntz>"), "_o": F.lit(1)}).unionByName(
        stages.select("run_id", F.col("start_ts").alias("ts"), F.struct("stage", F.col("end_ts").cast("timestamp_ntz").alias("end_ts")).alias("_stage"), F.lit(0).alias("_o")), allowMissingColumns=True
    )
    last = F.last("_stage", ignorenulls=True).over(Window.partitionBy("run_id").orderBy("ts", "_o", F.col("_stage.end_ts").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("_last", last).where("_o = 1").select(*kept, F.when(F.col("ts") < F.col("_last.end_ts"), F.col("_last.stage")).alias("stage"))


def stage_bench(samples: DataFrame, stages: DataFrame, order=("ts",), start: str = "startup") -> DataFrame:
    """(run_id, stage, peak, util, seconds, underused) from samples (run_id, ts, used, util) and stages (run_id, stage, start_ts, end_ts).

    peak is the most that was used over what the run's first sample with a value, by order, had in use before any stage, at least 0; util the mean. Samples outside stages don't count, nor
    does the stage start. A stage of enough seconds with a low util is underused."""
    base = samples.groupBy("run_id").agg(F.min_by("used", F.when(F.col("used").isNotNull(), F.struct(*order))).alias("_base"))
    seen = attribute_samples(samples, stages).where(F.col("stage") != start).groupBy("run_id", "stage").agg(F.max("used").alias("_most"), F.avg("util").alias("util"))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    took = stages.select("run_id", "stage", ((micros("end_ts") - micros("start_ts")) / 1e6).alias("seconds"))
    out = seen.join(base, "run_id").join(took, ["run_id", "stage"])
    underused = (F.col("util") < K.UTIL_FLOOR) & (F.floor("seconds") >= K.UTIL_SECONDS)
    return out.select("run_id", "stage", F.greatest(F.col("_most") - F.col("_base"), F.lit(0.0)).alias("peak"), "util", "seconds", underused.alias("underused"))
