"""What several text operators share: the shared folder, written intermediate tables, words and their hashes."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
_WHITE_BYTE = np.zeros(256, bool)
_WHITE_BYTE[[ord(c) for c in WHITE]] = True

_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local tests a new temporary one."""
    global _own_folder
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _own_folder is None:
            _own_folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        base = _own_folder
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def unused(name: str, columns: list[str]) -> str:
    """name, with as many underscores behind it as tell it from all columns (case aside, as Spark resolves names)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, and outlives a lost executor.

    The shuffle files behind it go once it is written, as nothing else reads them."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes tables that written() made, after all that reads them is written itself."""
    for t in tables:
        context = t.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(t.written_to)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (that of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept up to the last size of at most 1 M."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _powers:
        up, down = np.empty(size, np.uint64), np.empty(size, np.uint64)
        up[0] = down[0] = 1
        done = 1
        a, b = _BASE, _INVERSE
        while done < size:
            up[done : 2 * done] = up[:done] * np.uint64(a)
            down[done : 2 * done] = down[:done] * np.uint64(b)
            a, b, done = a * a % (1 << 64), b * b % (1 << 64), 2 * done
        if size > 1 << 20:
            return up, down
        _powers.clear()
        _powers[size] = up, down
    return _powers[size]


def word_places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a UTF-8 text begin and end, in bytes."""
    inside = ~_WHITE_BYTE[np.frombuffer(raw, np.uint8)]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edge[::2], edge[1::2]


def word_hashes(text: str | bytes) -> np.ndarray:
    """64-bit hashes of a text's words, in order, from prefix sums of a polynomial over its UTF-8 bytes."""
    text = text.encode() if isinstance(text, str) else text
    raw = np.frombuffer(text, np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    begin, end = word_places(text)
    up, down = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def run_hashes(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs of words from begin to end, from the words' hashes, by prefix sums as above."""
    up, down = _power_tables(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin])


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words."""
    n = max(0, len(words) - k + 1)
    return run_hashes(words, np.arange(n), np.arange(n) + k)


def connected(edges: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Connected components of undirected edges: (node, component), component being the least node.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), which need O(log^2 n) rounds and never
    gather a node's neighbours: each step is a minimum by key, combined before the shuffle, and a join with the written minima, whose
    sides are plain shuffles, so that Spark splits the partition of a node with very many links. Nodes without an edge don't occur. Null
    ends and loops are dropped."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    e = written(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)

    def stars(df: DataFrame) -> bool:
        """Each node hangs on one other at most, on which none hangs that hangs itself: nothing is left to do."""
        ends = df.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(df.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 AND up > 0").isEmpty()

    while not stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = written(large, name)
        drop(e, least)
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = large.join(least, "u").where("v != m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        e = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        drop(large, least)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def local_path(uri: str) -> tuple[object, str]:
    """An Arrow file system and the path in it, for a folder of the shared storage."""
    from pyarrow import fs

    if "://" not in uri:
        uri = "file://" + os.path.abspath(uri.removeprefix("file:"))
    return fs.FileSystem.from_uri(uri)
