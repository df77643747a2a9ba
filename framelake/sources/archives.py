"""Per-clip archives (.npz), per-detection files, listings and JSON documents as tables; every file is read by Spark."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAMES = "path string, key string, frame_idx long, value array<double>, error string"


def frame_archives(spark: SparkSession, glob: str) -> DataFrame:
    """(path, key, frame_idx, value, error): a row for each frame of each array, scalars at frame_idx null.

    Archives that need unpickling, or can't be read, give one row with error. Files stream through tasks in Arrow batches;
    an archive has to fit in a task's memory."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(glob).select("path", "content")

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    with np.load(io.BytesIO(content), allow_pickle=False) as z:
                        for key in z.files:
                            a = z[key]
                            if a.dtype.kind not in "fiub":
                                continue
                            if a.ndim == 0:
                                yield pd.DataFrame({"path": [path], "key": [key], "frame_idx": [None], "value": [[float(a)]], "error": [None]}).astype({"frame_idx": "Int64"})
                            else:
                                flat = a.reshape(len(a), -1).astype(float)
                                for at in range(0, len(flat), 4096):
                                    part = flat[at : at + 4096]
                                    yield pd.DataFrame({"path": path, "key": key, "frame_idx": pd.array(range(at, at + len(part)), "Int64"), "value": list(part), "error": None})
                except Exception as e:  # noqa: BLE001  reported, as a row
                    yield pd.DataFrame({"path": [path], "key": [None], "frame_idx": [None], "value": [None], "error": [f"{type(e).__name__}: {e}"[:200]]}).astype({"frame_idx": "Int64"})

    return files.mapInPandas(load, FRAMES)


def detection_number(path):
    """(frame_idx from 0, det_no) of a path <frame from 1>_<number>.npz, null where it isn't one."""
    name = F.regexp_extract(path, r"([^/]+)\.[^./]+$", 1)
    frame, number = F.regexp_extract(name, r"^(\d+)_(\d+)$", 1), F.regexp_extract(name, r"^(\d+)_(\d+)$", 2)
    return frame.try_cast("long") - 1, number.try_cast("long")


def detection_files(spark: SparkSession, glob: str) -> DataFrame:
    """frame_archives of per-detection files, with their frame and number; names of another form are left out."""
    frame, number = detection_number(F.col("path"))
    return frame_archives(spark, glob).withColumns({"det_frame": frame, "det_no": number}).where("det_no IS NOT NULL")


def file_listing(spark: SparkSession, glob: str) -> DataFrame:
    """(path, length, modified); contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(glob).select("path", "length", F.col("modificationTime").alias("modified"))


def json_docs(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """(path, state, doc): a file each; state is ok, empty, unreadable or not an object."""
    text = spark.read.option("wholetext", True).text(glob).select(F.input_file_name().alias("path"), F.trim("value").alias("text"))
    got = F.from_json("text", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    state = F.when(F.length("text") == 0, "empty").when(~F.col("text").startswith("{"), F.when(F.col("text").rlike(r'^[\[\d"tfn-]'), "not an object").otherwise("unreadable")).when(F.col("doc._corrupt").isNotNull(), "unreadable").otherwise("ok")
    return text.withColumn("doc", got).select("path", state.alias("state"), F.when(state == "ok", F.col("doc").dropFields("_corrupt")).alias("doc"))
