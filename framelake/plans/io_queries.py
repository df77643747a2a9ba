"""Queries that write and read files, and streaming queries run to the end of their input."""

from __future__ import annotations

import io
import re
import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.plans.registry import query
from framelake.sources import archives, sinks
from framelake.streaming import jobs

_own: list[str] = []


def folder(spark, name: str) -> str:
    """A new folder in spark.checkpoint.dir, which all executors share; where that is unset, in a temporary one of a local session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        base = _own[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _finished(stream: DataFrame, name: str) -> DataFrame:
    spark = stream.sparkSession
    out = folder(spark, name)
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", folder(spark, f"{name}-log")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


#: Rows of a file of an ordered stream, of which a batch takes one a file or more.
ROWS = 100_000


def _streamed(df: DataFrame, name: str, files: int = 4) -> DataFrame:
    """df written to files and read again as a stream, a file a batch."""
    at = folder(df.sparkSession, name)
    df.repartition(files).write.parquet(at)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(at)


def _streamed_in_order(df: DataFrame, name: str, column: str, cuts: tuple = ()) -> DataFrame:
    """df as a stream whose batches follow each other in column: written part after part, as files come in by their time. A part has as many
    files as a batch takes, each row numbered into one of them, and one row more in every file, all null, so that none is left out."""
    spark, at = df.sparkSession, folder(df.sparkSession, name)
    files = max(4, -(-df.count() // ROWS))
    # A label for each file, such that Spark's partitioning by hash gives each a partition of its own.
    label = F.col("id").cast("int")
    labels = {r.part: r.label for r in spark.range(64 * files).groupBy(F.pmod(F.hash(label), F.lit(files)).alias("part")).agg(F.min(label).alias("label")).collect()}
    blank = spark.range(64 * files).where(label.isin(*labels.values())).select(label.alias("_file"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    for low, high in zip((None, *cuts), (*cuts, None), strict=True):
        part = df if low is None else df.where(F.col(column) >= low)
        part = part if high is None else part.where(F.col(column) < high)
        own = F.element_at(F.array(*map(F.lit, labels.values())), F.pmod(F.xxhash64(*df.columns), F.lit(files)).cast("int") + 1)
        dealt = part.withColumn("_file", own).unionByName(blank)
        dealt.repartition(files, "_file").drop("_file").write.mode("append").parquet(at)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(at).where(F.col(column).isNotNull())


@query("stream_ingest_finished", "SELECT clip_id, frame_idx, x FROM v_frames")
def _(t):
    df = t.v_frames.select("clip_id", "frame_idx", "x")
    target = folder(t.spark, "ingested")
    at = folder(t.spark, "ingest")
    df.repartition(2, "clip_id").write.parquet(at)
    jobs.ingest_finished(t.spark.readStream.schema(df.schema).parquet(at), target, folder(t.spark, "ingest-log")).awaitTermination()
    return t.spark.read.schema("frame_idx long, x double, clip_id long").parquet(target).select("clip_id", "frame_idx", "x")


_SENTINEL = "TIMESTAMP '2030-01-01 00:00:00'"


def _with_end(df: DataFrame) -> DataFrame:
    """A last row far ahead, after which the watermark closes all windows."""
    end = df.sparkSession.sql(f"SELECT {', '.join(f'CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}' if f.name != 'ts' else f'{_SENTINEL} AS ts' for f in df.schema.fields)}")
    return df.withColumn("_o", F.lit(0)).unionByName(end.withColumn("_o", F.lit(1)))


@query("stream_stage_metrics", "SELECT run_id, date_trunc('hour', ts) AS start, round(max(used), 4) AS peak, round(avg(util), 4) AS util, count(*) AS n FROM v_samples GROUP BY 1, 2")
def _(t):
    s = _with_end(t.v_samples.select("run_id", F.col("ts").cast("timestamp").alias("ts"), "used", "util"))
    out = _finished(jobs.stage_metrics(_streamed_in_order(s, "samples", "ts", (F.expr("TIMESTAMP '2024-01-10 00:00:00'"),)).drop("_o")), "metrics")
    return out.where("run_id IS NOT NULL").select("run_id", F.col("start").cast("timestamp_ntz").alias("start"), F.round("peak", 4).alias("peak"), F.round("util", 4).alias("util"), "n")


@query("stream_stage_metrics_sliding", """SELECT run_id, start, round(max(used), 4) AS peak, round(avg(util), 4) AS util, count(*) AS n FROM (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS start FROM v_samples) s GROUP BY 1, 2""")
def _(t):
    s = _with_end(t.v_samples.select("run_id", F.col("ts").cast("timestamp").alias("ts"), "used", "util"))
    out = _finished(jobs.stage_metrics(_streamed_in_order(s, "samples", "ts", (F.expr("TIMESTAMP '2024-01-10 00:00:00'"),)).drop("_o"), slide="30 minutes"), "metrics")
    return out.where("run_id IS NOT NULL").select("run_id", F.col("start").cast("timestamp_ntz").alias("start"), F.round("peak", 4).alias("peak"), F.round("util", 4).alias("util"), "n")


@query("stream_detection_sessions", """SELECT clip_id, min(ts) AS start, count(*) AS n FROM (SELECT *, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY clip_id ORDER BY ts) AS s FROM
  (SELECT clip_id, ts, lag(ts) OVER (PARTITION BY clip_id ORDER BY ts) AS p FROM v_frames WHERE detected) q) r GROUP BY clip_id, s""")
def _(t):
    d = _with_end(t.v_frames.where("detected").select("clip_id", F.col("ts").cast("timestamp").alias("ts")))
    out = _finished(jobs.detection_sessions(_streamed_in_order(d, "detections", "ts", (F.expr("TIMESTAMP '2024-01-10 00:00:00'"),)).drop("_o"), "6 hours"), "sessions")
    return out.where("clip_id IS NOT NULL").select("clip_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("stream_dedupe_detections", "SELECT clip_id, frame_idx FROM v_frames")
def _(t):
    d = t.v_frames.select("clip_id", "frame_idx", F.col("ts").cast("timestamp").alias("ts"))
    return _finished(jobs.dedupe_detections(_streamed(d.unionByName(d.where("frame_idx % 3 = 0")), "replayed", 2), ["clip_id", "frame_idx"], "3650 days"), "deduped").select("clip_id", "frame_idx")


_CARRY = """SELECT clip_id, frame_idx, CASE WHEN age <= 5 THEN age END AS age, CASE WHEN age <= 5 THEN last_x END AS carried, CASE WHEN age <= 5 THEN age > 0 END AS stale FROM (
  SELECT clip_id, frame_idx, frame_idx - last_value(CASE WHEN detected THEN frame_idx END IGNORE NULLS) OVER w AS age, last_value(CASE WHEN detected THEN x END IGNORE NULLS) OVER w AS last_x
  FROM v_frames WINDOW w AS (PARTITION BY clip_id ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) q"""


@query("stream_carry_forward", _CARRY)
def _(t):
    d = t.v_frames.select("clip_id", "frame_idx", F.when(F.col("detected"), F.col("x")).alias("x"))
    return _finished(jobs.carry_forward(_streamed_in_order(d, "frames", "frame_idx", (20, 40))), "carried").where("NOT late").drop("late")


@query("stream_one_euro")
def _(t):
    d = t.v_frames.select("clip_id", "frame_idx", "x")
    return _finished(jobs.one_euro(_streamed_in_order(d, "frames", "frame_idx", (20, 40))), "smooth").where("NOT late").drop("late")


def _archived(t, name: str) -> str:
    """Each pose clip as an .npz archive in the shared folder, written by the tasks."""
    from pyarrow import fs

    at = folder(t.spark, name)
    fs.FileSystem.from_uri(at)[0].create_dir(fs.FileSystem.from_uri(at)[1], recursive=True)

    def save(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("frame_idx")
        b = io.BytesIO()
        np.savez(b, body_pose=np.stack(rows["pose"].to_numpy()).astype(np.float32), num_frames=np.int64(len(rows)))
        there, top = fs.FileSystem.from_uri(at)
        with there.open_output_stream(f"{top}/{int(rows['clip_id'].iloc[0]):06d}_1.npz") as f:
            f.write(b.getvalue())
        return pd.DataFrame({"n": [len(rows)]})

    t.v_poses.select("clip_id", "frame_idx", "pose").groupBy("clip_id").applyInPandas(save, "n long").agg(F.sum("n")).collect()
    return at



@query("src_frame_archives", "SELECT clip_id, frame_idx, round(list_sum(pose::DOUBLE[]), 5) AS total FROM v_poses")
def _(t):
    rows = archives.frame_archives(t.spark, _archived(t, "archives")).where("key = 'body_pose'")
    clip = F.regexp_extract("path", r"(\d+)_1\.npz$", 1).cast("long")
    return rows.select(clip.alias("clip_id"), "frame_idx", F.round(F.aggregate("value", F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


@query("src_detection_files", "SELECT clip_id - 1 AS det_frame, CAST(1 AS BIGINT) AS det_no, count(*) AS n FROM v_poses GROUP BY clip_id")
def _(t):
    rows = archives.detection_files(t.spark, _archived(t, "detections")).where("key = 'body_pose'")
    return rows.groupBy("det_frame", "det_no").agg(F.count("*").alias("n"))


@query("src_file_listing", "SELECT DISTINCT concat(lpad(CAST(clip_id AS STRING), 6, '0'), '_1.npz') AS name, true AS filled FROM v_poses")
def _(t):
    files = archives.file_listing(t.spark, _archived(t, "listed"))
    return files.select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), (F.col("length") > 0).alias("filled"))


@query("src_json_docs", "SELECT CASE s_suppkey % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'unreadable' WHEN 2 THEN 'not an object' ELSE 'empty' END AS state, count(*) AS n FROM supplier GROUP BY 1")
def _(t):
    at = folder(t.spark, "json")
    text = F.expr("CASE s_suppkey % 4 WHEN 0 THEN concat('{\"k\": ', s_suppkey, '}') WHEN 1 THEN '{\"k\": ' WHEN 2 THEN '[1, 2]' ELSE '' END")
    # A folder of its own for each document: text files are split by partition value.
    t.supplier.select("s_suppkey", text.alias("value")).repartition("s_suppkey").write.partitionBy("s_suppkey").text(at)
    return archives.json_docs(t.spark, f"{at}/*/*", "k long").groupBy("state").agg(F.count("*").alias("n"))


@query("sink_frame_table", "SELECT clip_id, frame_idx, CASE WHEN clip_id % 2 = 0 THEN x + 1 ELSE x END AS x FROM v_frames")
def _(t):
    at = folder(t.spark, "frames")
    df = t.v_frames.select("clip_id", "frame_idx", "x")
    sinks.write_frames(df, at)
    sinks.write_frames(df.where("clip_id % 2 = 0").withColumn("x", F.col("x") + 1), at)
    return t.spark.read.schema("frame_idx long, x double, clip_id long").parquet(at).select("clip_id", "frame_idx", "x")


@query("sink_guarded", "SELECT clip_id, count(*) AS n FROM v_poses GROUP BY clip_id")
def _(t):
    at = folder(t.spark, "guarded")
    good = t.v_poses.select("clip_id", "frame_idx", "pose")
    sinks.write_guarded(good, at, {"pose": None})
    try:
        sinks.write_guarded(good.withColumn("pose", F.array(F.lit(float("nan")))), at, {"pose": None})
    except ValueError:
        return t.spark.read.parquet(at).groupBy(F.col("clip_id").cast("long").alias("clip_id")).agg(F.count("*").alias("n"))
    raise AssertionError("a table that isn't finite was written")


@query("sink_report_tables", "SELECT session, condition, count(*) AS clips FROM v_clips GROUP BY session, condition")
def _(t):
    at = folder(t.spark, "report")
    sinks.write_report(t.v_clips.groupBy("session", "condition").agg(F.count("*").alias("clips")), at, "json")
    return t.spark.read.schema("session string, condition string, clips long").json(at)
