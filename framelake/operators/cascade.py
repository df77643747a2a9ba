"""Which stages of a clip have to run again, given those that are stale themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A stage's inputs, each stage after its inputs.
EDGES = {"body": (), "hands": ("body",), "face": (), "gaze": (), "merge": ("body", "hands", "face", "gaze"), "ik": ("merge",)}


def cascade(plan: DataFrame) -> DataFrame:
    """plan (clip, stage, own) to a row a clip with a flag for each stage: stale itself, or by an input that is rebuilt."""
    out = plan.groupBy("clip").agg(*(F.coalesce(F.bool_or(F.when(F.col("stage") == s, F.col("own"))), F.lit(False)).alias(s) for s in EDGES))
    for stage, inputs in EDGES.items():
        flag = F.col(stage)
        for i in inputs:
            flag = flag | F.col(i)
        out = out.withColumn(stage, flag)
    return out
