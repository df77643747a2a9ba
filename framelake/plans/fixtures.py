"""Motion-data views over the sample tables: the same SQL, but for array slices and series, in Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = "region nation customer supplier part orders lineitem events documents embeddings".split()

_DETECTIONS = """SELECT l_suppkey AS clip_id, l_orderkey % 600 AS frame_idx,
  CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax) - 1 AS BIGINT) AS det_idx,
  l_linestatus = 'O' AS is_right, CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_quantity AS INT) END AS kp_count,
  CASE WHEN l_partkey % 70 = 0 THEN NULL ELSE CAST(1 AS DOUBLE) - CAST(5 AS DOUBLE) * l_discount END AS kp_conf,
  l_quantity / CAST(10 AS DOUBLE) - CAST(2 AS DOUBLE) AS cam_x, l_tax * CAST(10 AS DOUBLE) AS cam_y, l_extendedprice / CAST(20000 AS DOUBLE) - CAST(0.5 AS DOUBLE) AS cam_z,
  CASE WHEN l_suppkey % 3 = 0 THEN CAST(1000 AS DOUBLE) WHEN l_suppkey % 3 = 1 THEN CAST(1000.6 AS DOUBLE) END AS focal, (l_orderkey * 31 + l_linenumber) % 500 AS vec
  FROM lineitem"""
_POSES = """SELECT CAST(label AS BIGINT) AS clip_id, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS BIGINT) AS frame_idx, vec_id, embedding AS pose,
  (vec_id * 7 + label) % 10 < 7 AS left_valid, (vec_id * 3 + label) % 10 < 6 AS right_valid FROM embeddings"""
_BODY = """SELECT s_suppkey AS clip_id, f AS frame_idx, (s_suppkey * 7 + f) % 500 AS vec, (s_suppkey + f) % 20 <> 0 AS body_valid,
  CAST((s_suppkey * 13 + f * 7) % 97 AS DOUBLE) / CAST(20 AS DOUBLE) - CAST(0.3 AS DOUBLE) AS transl_z, CAST((s_suppkey * 5 + f * 11) % 61 + 40 AS DOUBLE) AS box_size
  FROM (SELECT s_suppkey, {series} AS f FROM supplier) s"""
_FACE = """SELECT clip_id, frame_idx AS timestep_id, (clip_id + frame_idx) % 9 = 0 AS stale, CAST((clip_id * 3 + frame_idx * 5) % 41 AS DOUBLE) / CAST(40 AS DOUBLE) AS jaw,
  CAST(((clip_id + frame_idx) % 31) - 15 AS DOUBLE) / CAST(20 AS DOUBLE) AS pitch, CAST(((clip_id * 2 + frame_idx) % 21) - 10 AS DOUBLE) / CAST(10 AS DOUBLE) AS yaw,
  CASE WHEN (clip_id + frame_idx * 3) % 11 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST((clip_id + frame_idx) % 17 AS DOUBLE) / CAST(40 AS DOUBLE) + CAST(0.05 AS DOUBLE) END AS blink
  FROM v_body WHERE (clip_id * 13 + frame_idx * 7) % 10 < 6"""

# Arrays: {at} takes an element counted from 1, {map} a range of numbers through an expression of i.
_HANDS = "SELECT d.*, {hand} AS hand FROM v_detections d JOIN embeddings e ON e.vec_id = d.vec"
_MESHES = """SELECT d.clip_id, d.frame_idx, d.det_idx, d.is_right, d.kp_count, d.kp_conf, d.cam_x, d.cam_y, CASE WHEN d.det_idx % 29 = 0 THEN CAST(0 AS DOUBLE) ELSE d.cam_z END AS cam_z, d.focal, {verts} AS verts
  FROM v_detections d JOIN embeddings e ON e.vec_id = d.vec"""
_FACES = """SELECT clip_id, timestep_id, row_idx, CASE WHEN clip_id % 4 = 3 THEN NULL ELSE stale <> (row_idx = 1) END AS stale, {jaw} AS jaw, {expression} AS expression, {eyes} AS eyes, pitch - row_idx AS gaze_pitch, yaw AS gaze_yaw, blink + row_idx AS blink_left, blink / CAST(2 AS DOUBLE) AS blink_right
  FROM (SELECT *, 0 AS row_idx FROM v_face UNION ALL SELECT *, 1 AS row_idx FROM v_face WHERE timestep_id % 5 = 0) q"""


def _mapped(n: str, of: str) -> tuple[str, str]:
    """An array of of over i from 1 to n, for Spark and for DuckDB."""
    return f"transform(sequence(1, {n}), i -> {of})", f"list_transform(range(1, {n} + 1), lambda i: {of})"


def _both(text: str, **arrays: tuple[str, str]) -> tuple[str, str]:
    return tuple(text.format(**{k: v[side] for k, v in arrays.items()}) for side in (0, 1))


_EMBEDDED = ("CAST(element_at(e.embedding, CAST({0} AS INT)) AS DOUBLE)", "CAST(e.embedding[{0}] AS DOUBLE)")


def _embedded(n: str, index: str, of: str) -> tuple[str, str]:
    """As _mapped, with x in of being element index of the embedding."""
    return tuple(_mapped(n, of.replace("x", x.format(index)))[side] for side, x in enumerate(_EMBEDDED))


#: name -> text, or (Spark's text, DuckDB's).
VIEWS: dict[str, str | tuple[str, str]] = {
    "v_frames": """SELECT user_id AS clip_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS frame_idx, ts,
  event_type <> 'error' AS valid, event_type = 'click' AS detected, value AS x, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS size FROM events""",
    "v_clips": """SELECT clip_id, count(*) AS num_frames, CAST(CASE WHEN clip_id % 4 = 0 THEN 25 WHEN clip_id % 4 = 1 THEN 29.97 WHEN clip_id % 4 = 2 THEN 30 ELSE 0 END AS DOUBLE) AS fps,
  concat('S0', CAST(clip_id % 5 + 1 AS STRING)) AS session, CASE clip_id % 3 WHEN 0 THEN 'BP' WHEN 1 THEN 'CS' ELSE 'FT1' END AS condition,
  CAST(sum(size) AS DOUBLE) / CAST(10 AS DOUBLE) AS mb, clip_id % 4 <> 1 AS excerpt FROM v_frames GROUP BY clip_id""",
    "v_poses": _POSES,
    "v_body": (_BODY.format(series="explode(sequence(CAST(0 AS BIGINT), CAST(599 AS BIGINT)))"), _BODY.format(series="unnest(range(600))")),
    "v_detections": _DETECTIONS,
    "v_face": _FACE,
    "v_hands": _both(_HANDS, hand=_embedded("45", "i", "x * CAST(8 AS DOUBLE)")),
    "v_meshes": _both(_MESHES, verts=_embedded("120", "(i - 1) % 64 + 1", "x + CAST(i AS DOUBLE) / CAST(1000 AS DOUBLE)")),
    "v_faces": _both(
        _FACES,
        jaw=_mapped("3", "jaw + CAST(i - 10 * row_idx AS DOUBLE) / CAST(10 AS DOUBLE)"),
        expression=_mapped("CASE WHEN (clip_id + timestep_id) % 13 = 0 THEN 80 ELSE 120 END", "CAST((clip_id * 3 + timestep_id * 5 + i * 7) % 41 - 50 * row_idx AS DOUBLE) / CAST(40 AS DOUBLE)"),
        eyes=_mapped("CASE WHEN (clip_id + timestep_id + row_idx) % 7 = 0 THEN 4 ELSE 6 END", "pitch * CAST(i AS DOUBLE) + CAST(row_idx AS DOUBLE)"),
    ),
    "v_joints": "SELECT clip_id, frame_idx, transl_z AS left_z, transl_z - CAST(clip_id % 5 AS DOUBLE) / CAST(10 AS DOUBLE) AS right_z FROM v_body WHERE frame_idx < 480 + clip_id % 100",
    "v_body_clips": "SELECT s_suppkey AS clip_id, 480 + s_suppkey % 100 AS num_frames, CASE WHEN s_suppkey % 2 = 0 THEN CAST(1000 AS DOUBLE) ELSE CAST(1200 AS DOUBLE) END AS fx, 640 AS width, 480 AS height FROM supplier",
    "v_weights": "SELECT p_partkey % 21 AS joint_id, (p_partkey * 7 + p_size) % 40 AS vertex_id, sum(CAST(p_retailprice AS DOUBLE)) / CAST(100000 AS DOUBLE) AS weight FROM part GROUP BY p_partkey % 21, (p_partkey * 7 + p_size) % 40",
    "v_tracks": """SELECT clip_id, track_id, frame_idx, x1, y1, x1 + w AS x2, y1 + h AS y2 FROM (SELECT l_suppkey AS clip_id,
  CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 1 WHEN l_orderkey % 40 = 0 THEN 2 ELSE 0 END AS track_id, l_orderkey % 600 AS frame_idx, l_quantity AS x1, l_tax * CAST(100 AS DOUBLE) AS y1,
  l_quantity * CAST(2 AS DOUBLE) + CAST(1 AS DOUBLE) AS w, l_discount * CAST(500 AS DOUBLE) + CAST(1 AS DOUBLE) AS h,
  row_number() OVER (PARTITION BY l_suppkey, CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 1 WHEN l_orderkey % 40 = 0 THEN 2 ELSE 0 END, l_orderkey % 600 ORDER BY l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice) AS rn
  FROM lineitem) q WHERE rn = 1""",
    "v_sources": "SELECT CASE WHEN o_orderkey % 50 = 3 THEN o_orderkey + 100000000 ELSE o_orderkey END AS name, o_orderstatus AS session, o_orderpriority AS condition FROM orders",
    "v_outputs": """SELECT DISTINCT o.o_orderkey AS name, o.o_orderstatus AS session, o.o_orderpriority AS condition, o.o_orderkey % 2 = 0 AS excerpt
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey""",
    "v_videos": """SELECT o_orderkey AS clip_id, o_orderstatus AS session, o_orderpriority AS condition, CASE o_orderkey % 4 WHEN 0 THEN '25/1' WHEN 1 THEN '30000/1001' WHEN 2 THEN '0/0' ELSE '' END AS r_frame_rate,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 900 + 100 END AS nb_frames, CAST(o_orderkey % 900 + 100 AS DOUBLE) / CAST(25 AS DOUBLE) AS duration,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(0 AS DOUBLE) WHEN o_orderkey % 3 = 1 THEN CAST(25 AS DOUBLE) END AS fps, o_orderkey % 900 + 100 + CASE WHEN o_orderkey % 11 = 0 THEN 2 ELSE 0 END AS num_frames FROM orders""",
    "v_samples": "SELECT user_id AS run_id, event_id, ts, value AS used, CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE) AS util FROM events",
    "v_stages": """SELECT run_id, stage, start_ts, end_ts FROM (SELECT user_id AS run_id, concat('stage ', CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS STRING)) AS stage,
  ts AS start_ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_ts FROM events WHERE event_type = 'signup') q""",
    "v_logs": """SELECT doc_id AS line_id, CAST(doc_id % 4 AS INT) AS code, concat(CASE doc_id % 8 WHEN 0 THEN 'CUDA out of memory' WHEN 1 THEN 'moov atom not found' WHEN 2 THEN 'File size limit exceeded'
  WHEN 3 THEN 'No space left on device' WHEN 4 THEN 'Killed' WHEN 5 THEN concat('ValueError: bad clip', chr(10), 'RuntimeError: frame ', CAST(doc_id AS STRING)) WHEN 6 THEN '==== Step 2b: Hands (gpu)' ELSE 'apex is not installed' END,
  chr(10), coalesce(text, '')) AS text FROM documents""",
    "v_stamps": """SELECT o_orderkey AS artifact, CAST(o_custkey AS STRING) AS input, o_orderpriority AS flags, o_orderstatus AS code,
  CASE WHEN o_orderkey % 5 = 0 THEN 'changed' ELSE CAST(o_custkey AS STRING) END AS new_input, CASE WHEN o_orderkey % 10 = 0 THEN 'x' ELSE o_orderpriority END AS new_flags,
  CASE WHEN o_orderkey % 6 = 0 THEN 'new' ELSE o_orderstatus END AS new_code, CASE o_orderkey % 13 WHEN 0 THEN 'missing' WHEN 1 THEN 'no stamp' WHEN 2 THEN 'unreadable' WHEN 3 THEN 'not an object' WHEN 4 THEN 'broken' WHEN 5 THEN 'unknown' ELSE 'fine' END AS state FROM orders""",
}


class Tables:
    """The base tables and the views of one folder, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._made = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in BASE:
                self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                text = VIEWS[name] if isinstance(VIEWS[name], str) else VIEWS[name][0]
                used = {u: getattr(self, u) for u in (*BASE, *VIEWS) if u != name and re.search(rf"\b(FROM|JOIN) {u}\b", text)}
                if "explode(" in text:  # the table is one small file: its rows are dealt before they become many, else one task makes them all
                    parts = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
                    used = {u: df.repartition(parts, df.columns[0]) for u, df in used.items()}
                self._made[name] = self.spark.sql(re.sub(r"\b(FROM|JOIN) (\w+)\b", lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in used else m[0], text), **used)
        return self._made[name]


def with_views(sql: str) -> str:
    """DuckDB SQL with the views it names in front, each after those it needs."""
    order: list[str] = []

    def need(text: str) -> None:
        for u in VIEWS:
            if re.search(rf"\b{u}\b", text) and u not in order:
                need(VIEWS[u] if isinstance(VIEWS[u], str) else VIEWS[u][1])
                order.append(u)

    need(sql)
    ctes = ", ".join(f"{u} AS ({VIEWS[u] if isinstance(VIEWS[u], str) else VIEWS[u][1]})" for u in order)
    sql = sql.strip()
    if not ctes:
        return sql
    if sql.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {sql[15:]}"
    return f"WITH {ctes}, {sql[5:]}" if sql.upper().startswith("WITH ") else f"WITH {ctes} {sql}"
