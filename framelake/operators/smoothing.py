"""The One-Euro filter: a recursive smoother whose cut-off follows the signal's speed."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake import constants as K


def one_euro_step(x, last, min_cutoff: float, beta: float, d_cutoff: float, dt: float):
    """(y, dx) of one sample after last = (x, y, dx); numbers or arrays."""
    gain = lambda c: 1 / (1 + 1 / (2 * math.pi * c * dt))
    dx = gain(d_cutoff) * (x - last[0]) / dt + (1 - gain(d_cutoff)) * last[2]
    a = gain(min_cutoff + beta * np.abs(dx))
    return a * x + (1 - a) * last[1], dx


def one_euro(df: DataFrame, column: str, min_cutoff: float = 1.0, beta: float = 0.5, d_cutoff: float = 1.0, fps: float | str = 30.0, frame: str = "frame_idx", out: str = "smooth", fallback: float = K.FALLBACK_FPS) -> DataFrame:
    """(clip_id, frame, out) over a clip's present rows in frame order; column is a number or an array. A clip's column has to fit in one task's memory.

    fps is a rate for all clips, or the column that has each clip's own (the same in all its rows); where that is null or not over 0, fallback stands for it."""
    vector = df.schema[column].dataType.typeName() == "array"
    kind = "array<double>" if vector else "double"
    key_type, frame_type = df.schema["clip_id"].dataType.simpleString(), df.schema[frame].dataType.simpleString()

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(frame, kind="stable")
        x = np.stack(rows[column].to_numpy()).astype(float) if vector else rows[column].to_numpy(float)
        rate = float(rows["_fps"].iloc[0])
        y, dx = np.empty_like(x), np.zeros_like(x[0])
        y[0] = x[0]
        for i in range(1, len(x)):
            y[i], dx = one_euro_step(x[i], (x[i - 1], y[i - 1], dx), min_cutoff, beta, d_cutoff, 1 / rate)
        return pd.DataFrame({"clip_id": rows["clip_id"], frame: rows[frame], out: list(y) if vector else y})

    rate = F.when(F.col(fps) > 0, F.col(fps)).otherwise(fallback) if isinstance(fps, str) else F.lit(float(fps))
    return df.select("clip_id", frame, column, rate.cast("double").alias("_fps")).groupBy("clip_id").applyInPandas(run, f"clip_id {key_type}, {frame} {frame_type}, {out} {kind}")
