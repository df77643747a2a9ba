"""Structured Streaming forms of the per-frame rules; each takes a streaming DataFrame and returns one."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from framelake import constants as K
from framelake.operators.smoothing import one_euro_step


def stage_metrics(samples: DataFrame, width: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """samples (run_id, ts timestamp, used, util) to peak and mean by run and window; rows later than late after their window are dropped."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return samples.withWatermark("ts", late).groupBy("run_id", w.alias("w")).agg(F.max("used").alias("peak"), F.avg("util").alias("util"), F.count("*").alias("n")).select("run_id", F.col("w.start").alias("start"), "peak", "util", "n")


def detection_sessions(det: DataFrame, gap: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """det (clip_id, ts timestamp) to runs of detections with no longer gap."""
    s = det.withWatermark("ts", late).groupBy("clip_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return s.select("clip_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def dedupe_detections(det: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    return det.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def _ordered(batches: Iterator[pd.DataFrame]) -> pd.DataFrame:
    rows = pd.concat(list(batches))
    return rows.sort_values("frame_idx", kind="stable")


def carry_forward(frames: DataFrame, max_age: int = K.MAX_CARRY) -> DataFrame:
    """frames (clip_id, frame_idx, x null where nothing was detected) with carried, age, stale, late. State of a clip: the last frame seen, the last detection and its frame.

    A frame not after the last one seen of its clip comes too late to count: it changes nothing, and its row has late true and no values, so that late_counts() can tell how many there were."""
    key = frames.schema["clip_id"].dataType.simpleString()

    def step(k, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, at, value = state.get if state.exists else (-1, -1, 0.0)
        rows = []
        for f, x in _ordered(batches)[["frame_idx", "x"]].itertuples(index=False):
            if f <= seen:
                rows.append((k[0], int(f), None, None, None, True))
                continue
            seen = int(f)
            if not pd.isna(x):
                at, value = seen, float(x)
            near = at >= 0 and seen - at <= max_age
            rows.append((k[0], seen, value if near else None, seen - at if near else None, seen > at if near else None, False))
        state.update((seen, at, value))
        out = pd.DataFrame(rows, columns=["clip_id", "frame_idx", "carried", "age", "stale", "late"])
        yield out.astype({"age": "Int64", "stale": "boolean", "carried": "float64"})

    return frames.groupBy("clip_id").applyInPandasWithState(step, f"clip_id {key}, frame_idx long, carried double, age long, stale boolean, late boolean", "seen long, at long, value double", "append", GroupStateTimeout.NoTimeout)


def one_euro(frames: DataFrame, min_cutoff: float = 1.0, beta: float = 0.5, d_cutoff: float = 1.0, fps: float = 30.0) -> DataFrame:
    """frames (clip_id, frame_idx, x) with smooth and late; the state of a clip is its last frame, x, y and dx. Late frames are told as in carry_forward()."""
    key = frames.schema["clip_id"].dataType.simpleString()

    def step(k, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else None
        rows = []
        for f, x in _ordered(batches)[["frame_idx", "x"]].itertuples(index=False):
            if last is not None and f <= last[0]:
                rows.append((k[0], int(f), None, True))
                continue
            y, dx = (x, 0.0) if last is None else one_euro_step(x, last[1:], min_cutoff, beta, d_cutoff, 1 / fps)
            last = (int(f), float(x), float(y), float(dx))
            rows.append((k[0], last[0], last[2], False))
        if last is not None:
            state.update(last)
        yield pd.DataFrame(rows, columns=["clip_id", "frame_idx", "smooth", "late"]).astype({"smooth": "float64"})

    return frames.groupBy("clip_id").applyInPandasWithState(step, f"clip_id {key}, frame_idx long, smooth double, late boolean", "f long, x double, y double, dx double", "append", GroupStateTimeout.NoTimeout)


def late_counts(out: DataFrame) -> DataFrame:
    """(clip_id, rows, late) of what carry_forward() or one_euro() gave."""
    return out.groupBy("clip_id").agg(F.count("*").alias("rows"), F.count_if("late").alias("late"))


def ingest_finished(clips: DataFrame, target: str, checkpoint: str):
    """Starts a query that writes newly arrived clips to target, by clip; a batch that is run again replaces its clips and adds nothing."""
    from framelake.sources.sinks import write_frames

    return clips.writeStream.foreachBatch(lambda batch, _: write_frames(batch, target)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
