"""Writing frame tables and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.operators.quality import nonfinite_report

#: Folders that a frame table has: each holds the clips whose hashed id falls to it, so a table of millions of clips has files of a good size.
BUCKETS = 64


def _there(df: DataFrame, path: str, delete: bool = False) -> bool:
    """Whether a folder exists; with delete, it doesn't any more."""
    context = df.sparkSession.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(context._jsc.hadoopConfiguration())
    return fs.delete(at, True) if delete else fs.exists(at)


def write_frames(df: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Parquet in folders of many clips each; a rerun replaces its own clips only.

    The folders that df has clips of are written anew, with their other clips, first beside the table and then in their places, so a write that fails before the last step leaves the
    table as it was. A table has to be written with one number of buckets. Two writers must not work on one table at once."""
    new = df.withColumn("bucket", F.pmod(F.xxhash64("clip_id"), F.lit(buckets)).cast("int"))
    whole = new
    if _there(df, path):
        old = df.sparkSession.read.parquet(path)
        touched = new.select("bucket").distinct()
        kept = old.join(F.broadcast(touched), "bucket", "left_semi").join(new.select("clip_id").distinct(), "clip_id", "left_anti")
        whole = new.unionByName(kept, allowMissingColumns=True)
    staged = f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
    whole.repartition(buckets, "bucket").sortWithinPartitions("bucket", "clip_id").write.partitionBy("bucket").parquet(staged)
    ready = df.sparkSession.read.schema(whole.schema).parquet(staged)
    ready.repartition(buckets, "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    _there(df, staged, delete=True)


def read_frames(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def write_guarded(df: DataFrame, path: str, columns: dict[str, str | None]) -> None:
    """write_frames, unless an array of columns isn't finite: then ValueError names the first clip and its first frames, and nothing is written."""
    bad = nonfinite_report(df, columns).orderBy("clip_id").limit(1).collect()
    if bad:
        raise ValueError(f"clip {bad[0]['clip_id']}: {bad[0]['n']} frames are not finite, first {bad[0]['frames']}")
    write_frames(df, path)


def write_report(df: DataFrame, path: str, form: str = "parquet") -> None:
    df.write.mode("overwrite").format(form).save(path)
