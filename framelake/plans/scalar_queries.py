"""Queries on the scalar functions, applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from framelake import constants as K
from framelake.functions import geometry as G
from framelake.functions import rotations as R
from framelake.functions import text as X
from framelake.plans.registry import query
from framelake.plans.report_queries import _points


def _aa(t):
    e = lambda i: F.col("embedding")[i].cast("double") * 4
    return t.embeddings.select("vec_id", F.array(e(0), e(1), e(2)).alias("a"), F.array(e(3), e(4), e(5)).alias("b"))


_QUAT = """(SELECT vec_id, cos(n / 2) AS w, sin(n / 2) / n * x AS x, sin(n / 2) / n * y AS y, sin(n / 2) / n * z AS z FROM (SELECT *, sqrt(x * x + y * y + z * z) AS n FROM
  (SELECT vec_id, embedding[{0}]::DOUBLE * 4 AS x, embedding[{1}]::DOUBLE * 4 AS y, embedding[{2}]::DOUBLE * 4 AS z FROM embeddings) e) m)"""


@query("fn_axis_angle_quat", f"SELECT vec_id, round(w, 6) AS w, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM {_QUAT.format(1, 2, 3)} q")
def _(t):
    q = _aa(t).select("vec_id", R.axis_angle_to_quat(F.col("a")).alias("q"))
    return q.select("vec_id", *(F.round(F.col("q")[i], 6).alias(c) for i, c in enumerate("wxyz")))


@query("fn_quat_axis_angle", f"SELECT vec_id, round(2 * atan2(n, w) / n * x, 5) AS x, round(2 * atan2(n, w) / n * y, 5) AS y, round(2 * atan2(n, w) / n * z, 5) AS z FROM (SELECT *, sqrt(x * x + y * y + z * z) AS n FROM {_QUAT.format(1, 2, 3)} q) m")
def _(t):
    q = _aa(t).select("vec_id", R.quat_to_axis_angle(R.axis_angle_to_quat(F.col("a"))).alias("v"))
    return q.select("vec_id", *(F.round(F.col("v")[i], 5).alias(c) for i, c in enumerate("xyz")))


_SLERP = f"""WITH d AS (SELECT a.vec_id, a.w AS aw, a.x AS ax, a.y AS ay, a.z AS az, b.w AS bw, b.x AS b_x, b.y AS b_y, b.z AS b_z, a.w * b.w + a.x * b.x + a.y * b.y + a.z * b.z AS d0 FROM {_QUAT.format(1, 2, 3)} a JOIN {_QUAT.format(4, 5, 6)} b ON a.vec_id = b.vec_id),
  s AS (SELECT *, CASE WHEN d0 < 0 THEN -1 ELSE 1 END AS g, least(abs(d0), 1.0::DOUBLE) AS d FROM d),
  k AS (SELECT *, CASE WHEN d > 0.9995::DOUBLE THEN 0.7::DOUBLE ELSE sin(0.7::DOUBLE * acos(d)) / sin(acos(d)) END AS ka, CASE WHEN d > 0.9995::DOUBLE THEN 0.3::DOUBLE ELSE sin(0.3::DOUBLE * acos(d)) / sin(acos(d)) END * g AS kb FROM s),
  r AS (SELECT vec_id, aw * ka + bw * kb AS w, ax * ka + b_x * kb AS x, ay * ka + b_y * kb AS y, az * ka + b_z * kb AS z FROM k)"""


@query("fn_slerp", _SLERP + " SELECT vec_id, round(w, 5) AS w, round(x, 5) AS x, round(z, 5) AS z FROM r")
def _(t):
    q = _aa(t).select("vec_id", R.slerp(R.axis_angle_to_quat(F.col("a")), R.axis_angle_to_quat(F.col("b")), F.lit(0.3)).alias("q"))
    return q.select("vec_id", *(F.round(F.col("q")[i], 5).alias(c) for i, c in ((0, "w"), (1, "x"), (3, "z"))))


@query("fn_slerp_pose", _SLERP + ", m AS (SELECT *, sqrt(x * x + y * y + z * z) AS n FROM r) SELECT vec_id, round(2 * atan2(n, w) / n * x, 5) AS x, round(2 * atan2(n, w) / n * y, 5) AS y FROM m")
def _(t):
    q = _aa(t).select("vec_id", R.slerp_pose(F.col("a"), F.col("b"), F.lit(0.3), joints=1).alias("v"))
    return q.select("vec_id", F.round(F.col("v")[0], 5).alias("x"), F.round(F.col("v")[1], 5).alias("y"))


@query("fn_mirror_hand", "SELECT vec_id, round(list_sum(list_transform(range(1, 46), lambda i: i * embedding[i]::DOUBLE * CASE WHEN (i - 1) % 3 = 0 THEN 1 ELSE -1 END)), 4) AS checksum FROM embeddings")
def _(t):
    m = R.mirror_hand(F.slice("embedding", 1, 45).cast("array<double>"))
    return t.embeddings.select("vec_id", F.round(F.aggregate(F.transform(m, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x), 4).alias("checksum"))


_SIX = """(SELECT vec_id, a1 / na AS a1, a2 / na AS a2, a3 / na AS a3, b1, b2, b3 FROM (SELECT *, sqrt(a1 * a1 + a2 * a2 + a3 * a3) AS na FROM (SELECT vec_id, embedding[1]::DOUBLE AS a1, embedding[2]::DOUBLE AS a2, embedding[3]::DOUBLE AS a3,
  embedding[4]::DOUBLE AS b1, embedding[5]::DOUBLE AS b2, embedding[6]::DOUBLE AS b3 FROM embeddings) e) m)"""
_MATRIX = f"""(SELECT vec_id, a1, a2, a3, c1 / nc AS b1, c2 / nc AS b2, c3 / nc AS b3 FROM (SELECT *, sqrt(c1 * c1 + c2 * c2 + c3 * c3) AS nc FROM (SELECT vec_id, a1, a2, a3, b1 - a1 * (a1 * b1 + a2 * b2 + a3 * b3) AS c1, b2 - a2 * (a1 * b1 + a2 * b2 + a3 * b3) AS c2, b3 - a3 * (a1 * b1 + a2 * b2 + a3 * b3) AS c3 FROM {_SIX} q) g) h)"""


def _matrix(t):
    return t.embeddings.select("vec_id", R.rot6d_to_matrix(F.slice("embedding", 1, 6).cast("array<double>")).alias("m"))


@query("fn_rot6d_to_matrix", f"SELECT vec_id, round(a1, 5) AS m0, round(b2, 5) AS m4, round(a1 * b2 - a2 * b1, 5) AS m8 FROM {_MATRIX} q")
def _(t):
    return _matrix(t).select("vec_id", *(F.round(F.col("m")[i], 5).alias(f"m{i}") for i in (0, 4, 8)))


# The angle of a rotation is acos((trace - 1) / 2), whichever way its axis was found.
_ANGLE = f"SELECT vec_id, round(acos(greatest(-1, least(1, (a1 + b2 + a1 * b2 - a2 * b1 - 1) / 2))), 4) AS angle FROM {_MATRIX} q"


def _angle(t, f):
    return f(_matrix(t), "m", "v").select("vec_id", F.round(F.sqrt(F.col("v")[0] ** 2 + F.col("v")[1] ** 2 + F.col("v")[2] ** 2), 4).alias("angle"))


query("fn_rotmat_to_axis_angle", _ANGLE)(lambda t: _angle(t, R.rotmat_to_axis_angle))
query("fn_matrix_to_axis_angle", _ANGLE)(lambda t: _angle(t, R.matrix_to_axis_angle))
# The axis lies in the skew part of the matrix, whose size is twice the sine of the angle.
_AXIS = f"""SELECT vec_id, round(k * (c2 - b3), 3) AS x, round(k * (a3 - c1), 3) AS y, round(k * (b1 - a2), 3) AS z FROM (SELECT *, acos((a1 + b2 + c3 - 1) / 2) / (2 * sin(acos((a1 + b2 + c3 - 1) / 2))) AS k FROM
  (SELECT *, a2 * b3 - a3 * b2 AS c1, a3 * b1 - a1 * b3 AS c2, a1 * b2 - a2 * b1 AS c3 FROM {_MATRIX} p) q) r"""


@query("fn_rot6d_to_axis_angle", _AXIS)
def _(t):
    return R.matrix_to_axis_angle(_matrix(t), "m", "v").select("vec_id", *(F.round(F.col("v")[i], 3).alias(c) for i, c in enumerate("xyz")))


@query("fn_eye_aspect_ratio", "SELECT vec_id, round((sqrt((x[2] - x[6])^2 + (y[2] - y[6])^2) + sqrt((x[3] - x[5])^2 + (y[3] - y[5])^2)) / (2 * sqrt((x[1] - x[4])^2 + (y[1] - y[4])^2)), 5) AS ear FROM (SELECT vec_id, list_transform(range(1, 7), lambda i: embedding[2 * i - 1]::DOUBLE) AS x, list_transform(range(1, 7), lambda i: embedding[2 * i]::DOUBLE) AS y FROM embeddings) q")
def _(t):
    return t.embeddings.select("vec_id", F.round(G.eye_aspect_ratio(_points("embedding"), (0, 1, 2, 3, 4, 5)), 5).alias("ear"))


@query("fn_landmarks_to_px", "SELECT vec_id, round(list_sum(list_transform(range(1, 33), lambda i: embedding[2 * i - 1]::DOUBLE * 640 + 10)), 3) AS x, round(list_sum(list_transform(range(1, 33), lambda i: embedding[2 * i]::DOUBLE * 480 + 20)), 3) AS y FROM embeddings")
def _(t):
    p = G.landmarks_to_px(_points("embedding"), F.lit(640.0), F.lit(480.0), F.lit(10.0), F.lit(20.0))
    total = lambda c: F.round(F.aggregate(F.transform(F.col("p"), lambda q: q[c]), F.lit(0.0), lambda a, x: a + x), 3).alias(c)
    return t.embeddings.select("vec_id", p.alias("p")).select("vec_id", total("x"), total("y"))




def _box():
    return [F.col(c) for c in ("x1", "y1", "x2", "y2")]


_T = ["clip_id", "track_id", "frame_idx"]


@query("fn_expand_bbox", "SELECT clip_id, track_id, frame_idx, round((x1 + x2) / 2 - (x2 - x1) * CAST(1.3 AS DOUBLE) / 2, 5) AS x1, round((y1 + y2) / 2 + (y2 - y1) * CAST(1.3 AS DOUBLE) / 2, 5) AS y2 FROM v_tracks")
def _(t):
    b = G.expand_bbox(*_box())
    return t.v_tracks.select(*_T, F.round(b[0], 5).alias("x1"), F.round(b[3], 5).alias("y2"))


@query("fn_roi_from_bbox", """SELECT clip_id, track_id, frame_idx, CASE WHEN c - a >= 16 AND d - b >= 16 THEN a END AS x1, CASE WHEN c - a >= 16 AND d - b >= 16 THEN d END AS y2 FROM (SELECT clip_id, track_id, frame_idx, trunc(greatest(0, cx - h))::INT AS a, trunc(greatest(0, cy - h))::INT AS b, trunc(least(100, cx + h))::INT AS c, trunc(least(60, cy + h))::INT AS d
  FROM (SELECT *, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, greatest(greatest(x2 - x1, y2 - y1) * CAST(1.8 AS DOUBLE), 192) / 2 AS h FROM v_tracks) q) r""")
def _(t):
    r = t.v_tracks.select(*_T, G.roi_from_bbox(*_box(), F.lit(100), F.lit(60)).alias("r"))
    return r.select(*_T, "r.x1", "r.y2")


@query("fn_crop_geometry", """SELECT clip_id, track_id, frame_idx, a AS x1, greatest(0, -a) AS "left", greatest(0, b + s - 60) AS bottom FROM (SELECT *, trunc((x1 + x2) / 2 - greatest(x2 - x1, y2 - y1) / 2)::INT AS a, trunc((y1 + y2) / 2 - greatest(x2 - x1, y2 - y1) / 2)::INT AS b, trunc(greatest(x2 - x1, y2 - y1))::INT AS s FROM v_tracks) q""")
def _(t):
    c = t.v_tracks.select(*_T, G.crop_geometry(*_box(), F.lit(100), F.lit(60)).alias("c"))
    return c.select(*_T, "c.x1", "c.left", "c.bottom")


@query("fn_gaze_decode", "SELECT vec_id, round(radians(list_sum(list_transform(range(1, 65), lambda i: (i - 1) * exp(embedding[i]::DOUBLE * 5))) / list_sum(list_transform(range(1, 65), lambda i: exp(embedding[i]::DOUBLE * 5))) * 4 - 180), 5) AS angle FROM embeddings")
def _(t):
    return t.embeddings.select("vec_id", F.round(G.decode_binned_angle(F.transform("embedding", lambda x: x.cast("double") * 5)), 5).alias("angle"))


@query("fn_gaze_arrow", "SELECT clip_id, timestep_id, trunc(100 - 150 * sin(yaw) * cos(pitch))::INT AS x, trunc(80 - 150 * sin(pitch))::INT AS y FROM v_face")
def _(t):
    x, y = G.gaze_arrow_end(F.lit(100.5), F.lit(80.2), F.col("pitch"), F.col("yaw"))
    return t.v_face.select("clip_id", "timestep_id", x.alias("x"), y.alias("y"))


@query("fn_ortho_to_persp", "SELECT clip_id, track_id, frame_idx, round(2 * ((x1 + x2) / 2 - 320) / b + CAST(0.1 AS DOUBLE) / CAST(0.9 AS DOUBLE), 5) AS tx, round(2 * CAST(1000 AS DOUBLE) / b, 5) AS tz FROM (SELECT *, greatest(x2 - x1, y2 - y1) * CAST(0.9 AS DOUBLE) + CAST(0.000000001 AS DOUBLE) AS b FROM v_tracks) q")
def _(t):
    x, _, z = G.ortho_to_persp(F.lit(0.9), F.lit(0.1), F.lit(0.2), tuple(_box()), F.lit(1000.0), F.lit(640), F.lit(480))
    return t.v_tracks.select(*_T, F.round(x, 5).alias("tx"), F.round(z, 5).alias("tz"))


@query("fn_project_point", "SELECT clip_id, det_idx, round(CASE WHEN cam_z > 0 THEN cam_x / cam_z * 500 + 320 END, 4) AS u, round(CASE WHEN cam_z > 0 THEN cam_y / cam_z * 500 + 240 END, 4) AS v FROM v_detections")
def _(t):
    u, v = G.project_point(F.col("cam_x"), F.col("cam_y"), F.col("cam_z"), F.lit(500.0), F.lit(500.0), F.lit(320.0), F.lit(240.0))
    return t.v_detections.select("clip_id", "det_idx", F.round(u, 4).alias("u"), F.round(v, 4).alias("v"))


@query("fn_image_size_from_k", "SELECT o_orderkey, trunc(2 * o_totalprice)::INT AS width, trunc(o_totalprice)::INT AS height FROM orders")
def _(t):
    w, h = G.image_size_from_k(F.col("o_totalprice"), F.col("o_totalprice") / 2)
    return t.orders.select("o_orderkey", w.alias("width"), h.alias("height"))


_RATE = "coalesce(CASE clip_id % 4 WHEN 0 THEN 25.0::DOUBLE WHEN 1 THEN 30000.0::DOUBLE / 1001 END, nb_frames / duration)"


@query("fn_parse_frame_rate", f"SELECT clip_id, round({_RATE}, 6) AS fps FROM v_videos")
def _(t):
    return t.v_videos.select("clip_id", F.round(X.parse_rate(F.col("r_frame_rate"), F.col("nb_frames"), F.col("duration")), 6).alias("fps"))


@query("fn_frame_count", "SELECT clip_id, coalesce(nb_frames, trunc(duration * fps)::BIGINT, 0) AS n FROM v_videos")
def _(t):
    return t.v_videos.select("clip_id", X.frame_count(F.col("nb_frames"), F.col("duration"), F.col("fps")).alias("n"))


_NAME = "concat('P', CAST(c_custkey AS STRING), '_S0', CAST(c_nationkey % 7 AS STRING), '_', CASE c_custkey % 6 WHEN 0 THEN 'BP' WHEN 1 THEN 'CS' WHEN 2 THEN 'TP' WHEN 3 THEN 'FT1' WHEN 4 THEN 'FT2' ELSE 'ZZ' END)"


@query("fn_parse_clip_name", f"SELECT c_custkey, nullif(regexp_extract({_NAME}, '^P[0-9]+_(S[0-9]+)_(BP|CS|TP|FT1|FT2)$', 1), '') AS session, nullif(regexp_extract({_NAME}, '^P[0-9]+_(S[0-9]+)_(BP|CS|TP|FT1|FT2)$', 2), '') AS condition FROM customer")
def _(t):
    n = F.expr(_NAME)
    return t.customer.select("c_custkey", X.clip_session(n).alias("session"), X.clip_condition(n).alias("condition"))


@query("fn_frame_time", "SELECT f.clip_id, f.frame_idx, round(f.frame_idx / CASE WHEN c.fps > 0 THEN c.fps ELSE CAST(29.97 AS DOUBLE) END, 6) AS seconds FROM v_frames f JOIN v_clips c ON f.clip_id = c.clip_id")
def _(t):
    fps = F.when(F.col("fps") > 0, F.col("fps")).otherwise(K.FALLBACK_FPS)
    return t.v_frames.join(t.v_clips.select("clip_id", "fps"), "clip_id").select("clip_id", "frame_idx", F.round(F.col("frame_idx") / fps, 6).alias("seconds"))


@query("fn_stale_temp", "SELECT event_id, ts < TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 1 DAY AS stale FROM events")
def _(t):
    return t.events.select("event_id", X.stale_temp(F.col("ts"), F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")).alias("stale"))


_KIND = "CASE line_id % 8 WHEN 0 THEN 'gpu memory' WHEN 1 THEN 'broken video' WHEN 2 THEN 'file size limit' WHEN 3 THEN 'disk full' WHEN 4 THEN 'killed' WHEN 5 THEN 'frame ' || CAST(line_id AS STRING) ELSE 'exit code ' || CAST(code AS STRING) END"


@query("fn_classify_error", f"SELECT line_id, {_KIND} AS kind FROM v_logs")
def _(t):
    return t.v_logs.select("line_id", X.classify_error(F.col("text"), F.lit(None).cast("string"), F.col("code")).alias("kind"))


_NOISY = """(SELECT line_id, concat(text, chr(10), CASE line_id % 5 WHEN 0 THEN 'a UserWarning: torch.meshgrid: b' WHEN 1 THEN 'a UserWarning: torch.other: b' WHEN 2 THEN 'l2cs a FutureWarning' WHEN 3 THEN 'a FutureWarning' ELSE 'No module named <spectre>' END) AS text FROM v_logs)"""


@query("fn_drop_noise_lines", f"SELECT count(*) AS n, sum(length(line))::BIGINT AS chars FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM {_NOISY} p) q WHERE NOT regexp_matches(line, '{X.NOISE}')")
def _(t):
    more = F.expr("CASE line_id % 5 WHEN 0 THEN 'a UserWarning: torch.meshgrid: b' WHEN 1 THEN 'a UserWarning: torch.other: b' WHEN 2 THEN 'l2cs a FutureWarning' WHEN 3 THEN 'a FutureWarning' ELSE 'No module named <spectre>' END")
    lines = t.v_logs.select(F.explode(F.split(F.concat("text", F.lit("\n"), more), "\n")).alias("line"))
    return lines.where(~X.noise_line(F.col("line"))).agg(F.count("*").alias("n"), F.sum(F.length("line")).alias("chars"))


@query("fn_parse_stage_banner", "SELECT line_id, CASE WHEN line_id % 8 = 6 THEN '2' ELSE '' END AS number, CASE WHEN line_id % 8 = 6 THEN 'Hands' ELSE '' END AS name FROM v_logs")
def _(t):
    number, name = X.stage_banner(F.col("text"))
    return t.v_logs.select("line_id", number.alias("number"), name.alias("name"))


@query("fn_size_floor_status", "SELECT clip_id, CASE WHEN nb_frames IS NULL THEN 'MISS' WHEN nb_frames < 300 THEN 'CORRUPT' ELSE 'OK' END AS status FROM v_videos")
def _(t):
    return t.v_videos.select("clip_id", X.size_status(F.col("nb_frames"), 300).alias("status"))


@query("fn_json_provenance", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) END AS k FROM events")
def _(t):
    text = F.expr("CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN substring(props, 1, 4) WHEN 2 THEN concat('[', props, ']') ELSE props END")
    return t.events.select("event_id", X.parsed_json(text, "k long")["k"].alias("k"))


@query("fn_first_divergence_fields", "SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_orderkey % 2 = 0 THEN 'gpu' END, CASE WHEN o_orderkey % 3 = 0 THEN 'torch' END, CASE WHEN o_orderkey % 5 = 0 THEN 'cuda' END], lambda x: x IS NOT NULL), ',') AS fields FROM orders")
def _(t):
    k = F.col("o_orderkey")
    golden = F.create_map(F.lit("gpu"), F.lit("a"), F.lit("torch"), F.lit("b"))
    now = F.create_map(F.lit("gpu"), F.when(k % 2 == 0, "x").otherwise("a"), F.lit("torch"), F.when(k % 3 == 0, "x").otherwise("b"), F.lit("cuda"), F.when(k % 5 == 0, "x").otherwise("unknown"))
    return t.orders.select("o_orderkey", F.array_join(X.differing_fields(golden, now), ",").alias("fields"))


@query("fn_card_recommendation", "SELECT o_orderkey, CASE WHEN o_orderkey * 3 <= 12526 THEN 8 ELSE 16 END AS card, o_orderkey * 3 > 0 AND o_orderkey % 20 > 0 AND o_orderkey % 20 < CAST(0.95 AS DOUBLE) * CASE WHEN o_orderkey * 3 <= 12526 THEN 8 ELSE 16 END AS too_small FROM orders")
def _(t):
    n = F.col("o_orderkey") * 3
    return t.orders.select("o_orderkey", X.recommend_card(n).alias("card"), X.card_too_small(n, F.col("o_orderkey") % 20).alias("too_small"))
