"""Queries on aggregates, reports, set operations, quality rules and repairs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from framelake import constants as K
from framelake.functions import text as X
from framelake.functions.arrays import total
from framelake.functions.numbers import rounded
from framelake.operators import audit as A
from framelake.operators import frames as O
from framelake.operators import motion as M
from framelake.operators import quality as Q
from framelake.operators import tracks as P
from framelake.plans.registry import query


@query("agg_coverage", "SELECT clip_id, count(*) AS num_frames, round(avg(CASE WHEN left_valid THEN 1.0::DOUBLE ELSE 0 END), 6) AS left_valid, round(avg(CASE WHEN right_valid THEN 1.0::DOUBLE ELSE 0 END), 6) AS right_valid, round(avg(CASE WHEN left_valid OR right_valid THEN 1.0::DOUBLE ELSE 0 END), 6) AS any_hand, 0.0::DOUBLE AS gaze_valid FROM v_poses GROUP BY clip_id")
def _(t):
    c = Q.coverage(t.v_poses.withColumn("any_hand", F.expr("left_valid OR right_valid")), ["left_valid", "right_valid", "any_hand", "gaze_valid"])
    return c.select("clip_id", "num_frames", *(F.round(m, 6).alias(m) for m in ("left_valid", "right_valid", "any_hand", "gaze_valid")))


_FPS = "CASE WHEN fps > 0 THEN fps ELSE CAST(29.97 AS DOUBLE) END"


def _rate():
    return F.when(F.col("fps") > 0, F.col("fps")).otherwise(K.FALLBACK_FPS)


@query("agg_corpus_totals", f"SELECT count(*) AS clips, sum(num_frames)::BIGINT AS frames, round(sum(num_frames / ({_FPS}) / 3600), 6) AS hours, round(sum(mb) / 1000, 6) AS gb, count(*) FILTER (WHERE excerpt) AS excerpts FROM v_clips")
def _(t):
    return t.v_clips.agg(F.count("*").alias("clips"), F.sum("num_frames").alias("frames"), F.round(F.sum(F.col("num_frames") / _rate() / 3600), 6).alias("hours"), F.round(F.sum("mb") / 1000, 6).alias("gb"), F.count_if("excerpt").alias("excerpts"))


@query("agg_by_condition", f"SELECT condition, count(*) AS clips, min(num_frames) AS low, max(num_frames) AS high, round(avg(num_frames / ({_FPS}) / 60), 6) AS minutes, round(avg(mb), 6) AS mb FROM v_clips GROUP BY condition")
def _(t):
    return t.v_clips.groupBy("condition").agg(F.count("*").alias("clips"), F.min("num_frames").alias("low"), F.max("num_frames").alias("high"), F.round(F.avg(F.col("num_frames") / _rate() / 60), 6).alias("minutes"), F.round(F.avg("mb"), 6).alias("mb"))


@query("agg_session_condition", "SELECT session, condition, count(*) AS clips, count(DISTINCT num_frames) = 1 AS same_length, arg_min(num_frames, clip_id) AS first_length FROM v_clips GROUP BY session, condition")
def _(t):
    return t.v_clips.groupBy("session", "condition").agg(F.count("*").alias("clips"), (F.countDistinct("num_frames") == 1).alias("same_length"), F.min_by("num_frames", "clip_id").alias("first_length"))


@query("agg_audit_rollup", "SELECT coalesce(session, 'TOTAL') AS session, coalesce(condition, 'TOTAL') AS condition, count(*) AS source, count(o_name) AS output, count(*) FILTER (WHERE excerpt) AS excerpt, count(*) <> count(o_name) AS gap FROM (SELECT s.session, s.condition, o.name AS o_name, o.excerpt FROM v_sources s LEFT JOIN v_outputs o ON s.name = o.name AND s.session = o.session AND s.condition = o.condition) q GROUP BY GROUPING SETS ((session, condition), ())")
def _(t):
    return A.rollup_counts(t.v_sources, t.v_outputs)


@query("agg_fps_histogram", "SELECT round_even(fps, 2) AS fps, count(*) AS n FROM v_clips GROUP BY 1")
def _(t):
    return t.v_clips.groupBy(F.bround("fps", 2).alias("fps")).agg(F.count("*").alias("n"))


@query(
    "agg_depth_outliers",
    """WITH r AS (SELECT *, box_size / greatest(transl_z, CAST(0.1 AS DOUBLE)) AS r FROM v_body), s AS (SELECT clip_id, quantile_cont(r, 0.5) AS med, stddev_pop(r) AS std, quantile_cont(transl_z, 0.5) AS zmed FROM r GROUP BY clip_id)
    SELECT r.clip_id, count(*) FILTER (WHERE abs(r - med) > 3 * std OR transl_z > 2 * zmed) AS outliers, count(*) AS frames FROM r JOIN s ON r.clip_id = s.clip_id GROUP BY r.clip_id""",
)
def _(t):
    return M.flag_depth(t.v_body, "transl_z", "box_size").groupBy("clip_id").agg(F.count_if("depth_outlier").alias("outliers"), F.count("*").alias("frames"))


_RANKS = "(SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY area_median DESC, track_id) - 1 AS rank FROM (SELECT clip_id, track_id, count(*) AS n_frames, quantile_cont((x2 - x1) * (y2 - y1), 0.5) AS area_median, quantile_cont(x1, 0.5) AS x1m FROM v_tracks GROUP BY clip_id, track_id) q)"
_SUMMARY = f"""WITH k AS {_RANKS}, c AS (SELECT t.clip_id, t.frame_idx FROM v_tracks t JOIN k ON k.clip_id = t.clip_id AND k.track_id = t.track_id AND k.rank = 0),
  o AS (SELECT t.clip_id, t.track_id, count(DISTINCT t.frame_idx) AS n FROM v_tracks t JOIN c ON c.clip_id = t.clip_id AND c.frame_idx = t.frame_idx GROUP BY t.clip_id, t.track_id),
  a AS (SELECT clip_id, area_median FROM k WHERE rank = 0),
  s AS (SELECT k.clip_id, k.track_id, k.n_frames, k.rank, coalesce(o.n, 0) AS overlap, k.area_median / a.area_median AS share, k.x1m FROM k LEFT JOIN o ON o.clip_id = k.clip_id AND o.track_id = k.track_id LEFT JOIN a ON a.clip_id = k.clip_id)"""


@query("win_track_rank", f"SELECT clip_id, track_id, n_frames, rank, round(area_median, 4) AS area_median FROM {_RANKS} r")
def _(t):
    return P.rank_tracks(t.v_tracks).select("clip_id", "track_id", "n_frames", F.col("rank").cast("long").alias("rank"), F.round("area_median", 4).alias("area_median"))


@query("join_co_presence", _SUMMARY + " SELECT clip_id, track_id, n AS n_overlap_frames FROM o")
def _(t):
    return P.overlaps(t.v_tracks, P.rank_tracks(t.v_tracks))


@query("agg_track_summary", _SUMMARY + " SELECT clip_id, track_id, n_frames, rank, overlap AS n_overlap_frames, round(share, 5) AS area_share, round(x1m, 4) AS x1_median FROM s")
def _(t):
    return P.summarise_tracks(t.v_tracks).select("clip_id", "track_id", "n_frames", F.col("rank").cast("long").alias("rank"), "n_overlap_frames", F.round("area_share", 5).alias("area_share"), F.round("x1_median", 4).alias("x1_median"))


def _track_clips(t):
    return t.v_tracks.select("clip_id").distinct().withColumn("num_frames", F.lit(600).cast("long"))


@query("dq_multi_person", _SUMMARY + """, d AS (SELECT clip_id, CASE WHEN rank = 0 THEN 'chosen' WHEN overlap / CAST(600 AS DOUBLE) >= CAST(0.05 AS DOUBLE) AND share >= CAST(0.01 AS DOUBLE) THEN 'subject' ELSE 'blip' END AS kind FROM s)
  SELECT clip_id, count(*) AS n_tracks, count(*) FILTER (WHERE kind = 'subject') AS subjects, count(*) FILTER (WHERE kind = 'blip') AS blips, bool_or(kind = 'subject') AS failed FROM d GROUP BY clip_id""")
def _(t):
    return P.multi_person_gate(P.classify_tracks(P.summarise_tracks(t.v_tracks), _track_clips(t)))


_ACC = "coalesce(kp_count, 21) >= 7 AND coalesce(kp_conf, CAST(1 AS DOUBLE)) >= CAST(0.6 AS DOUBLE)"


@query("agg_ik_coverage", f"SELECT clip_id, round(n_target / greatest(CAST(n_frames AS DOUBLE), 1), 6) AS ik_coverage, n_target / greatest(CAST(n_frames AS DOUBLE), 1) < CAST(0.2 AS DOUBLE) AS failed FROM (SELECT d.clip_id, count(DISTINCT d.frame_idx) AS n_frames, count(DISTINCT CASE WHEN b.body_valid THEN d.frame_idx END) AS n_target FROM v_detections d JOIN v_body b ON d.clip_id = b.clip_id AND d.frame_idx = b.frame_idx WHERE {_ACC} GROUP BY d.clip_id) q")
def _(t):
    frames = O.accepted_detections(t.v_detections).groupBy("clip_id", "frame_idx").agg(F.count("*").alias("n")).join(t.v_body.select("clip_id", "frame_idx", "body_valid").hint("merge"), ["clip_id", "frame_idx"])
    c = frames.groupBy("clip_id").agg((F.count_if("body_valid") / F.greatest(F.count("*"), F.lit(1))).alias("c"))
    return c.select("clip_id", F.round("c", 6).alias("ik_coverage"), (F.col("c") < K.IK_FAIL).alias("failed"))


@query("agg_loss_stats", "SELECT clip_id, round(quantile_cont(l, 0.5) FILTER (WHERE l > 0), 5) AS median, round(quantile_cont(l, 0.95) FILTER (WHERE l > 0), 5) AS p95, max(l) FILTER (WHERE l > 0) AS largest, round(count(*) FILTER (WHERE l > 0) / count(*)::DOUBLE, 6) AS covered, coalesce(count(*) FILTER (WHERE l > 0) / count(*)::DOUBLE >= CAST(0.2 AS DOUBLE) AND quantile_cont(l, 0.5) FILTER (WHERE l > 0) < CAST(0.05 AS DOUBLE), false) AS solved FROM (SELECT clip_id, CASE WHEN detected OR clip_id % 3 = 0 THEN x / (1000 + 4000 * (clip_id % 2)) ELSE 0 END AS l FROM v_frames) q GROUP BY clip_id")
def _(t):
    loss = F.when(F.col("detected") | (F.col("clip_id") % 3 == 0), F.col("x") / (1000 + 4000 * (F.col("clip_id") % 2))).otherwise(0.0)
    s = Q.loss_stats(t.v_frames.withColumn("loss", loss), "loss")
    return s.select("clip_id", rounded(F.col("median"), 5).alias("median"), rounded(F.col("p95"), 5).alias("p95"), "largest", rounded(F.col("covered"), 6).alias("covered"), "solved")


_STAGED = "(SELECT s.run_id, s.event_id, s.used, s.util, g.stage, g.start_ts, g.end_ts FROM v_samples s JOIN v_stages g ON s.run_id = g.run_id AND s.ts >= g.start_ts AND s.ts < g.end_ts) j"


@query("join_range_stage_samples", f"SELECT run_id, event_id, stage FROM {_STAGED}")
def _(t):
    return A.attribute_samples(t.v_samples, t.v_stages.where("end_ts IS NOT NULL")).where("stage IS NOT NULL").select("run_id", "event_id", "stage")


@query("agg_stage_bench", f"SELECT run_id, stage, round(greatest(max(used) - (SELECT arg_min(b.used, struct_pack(t := b.ts, e := b.event_id)) FROM v_samples b WHERE b.run_id = j.run_id), 0), 4) AS peak, round(avg(util), 4) AS util, epoch(max(end_ts) - max(start_ts))::BIGINT AS seconds, avg(util) < 40 AND floor(epoch(max(end_ts) - max(start_ts))) >= 5 AS underused FROM {_STAGED} WHERE stage <> 'startup' GROUP BY run_id, stage")
def _(t):
    s = A.stage_bench(t.v_samples, t.v_stages.where("end_ts IS NOT NULL"), ("ts", "event_id"))
    return s.select("run_id", "stage", rounded(F.col("peak"), 4).alias("peak"), rounded(F.col("util"), 4).alias("util"), F.rint("seconds").cast("long").alias("seconds"), "underused")


@query("agg_nonfinite_guard", "SELECT clip_id, count(*) AS n, min(frame_idx) AS first_frame FROM v_body WHERE vec % 37 = 0 GROUP BY clip_id")
def _(t):
    bad = t.v_body.withColumn("v", F.array(F.when(F.col("vec") % 37 == 0, float("nan")).otherwise(F.col("transl_z"))))
    return Q.nonfinite_report(bad, {"v": None}).select("clip_id", "n", F.col("frames")[0].alias("first_frame"))


@query("agg_status_counts", "SELECT split_part(concat(o_orderstatus, ': ', o_orderpriority), ':', 1) AS status, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy(F.split(F.concat_ws(": ", "o_orderstatus", "o_orderpriority"), ":")[0].alias("status")).agg(F.count("*").alias("n"))


@query("agg_array_inventory", "SELECT label AS clip_id, 'embedding' AS name, 'array<float>' AS kind, min(len(embedding))::INT AS low, max(len(embedding))::INT AS high FROM embeddings GROUP BY label")
def _(t):
    return t.embeddings.groupBy(F.col("label").alias("clip_id")).agg(F.lit("embedding").alias("name"), F.first(F.typeof("embedding")).alias("kind"), F.min(F.size("embedding")).alias("low"), F.max(F.size("embedding")).alias("high"))


@query("agg_value_range", "SELECT clip_id, round(min(pitch) FILTER (WHERE NOT stale), 6) AS low, round(max(pitch) FILTER (WHERE NOT stale), 6) AS high, round(max(blink) FILTER (WHERE NOT stale), 6) AS blink, count(*) FILTER (WHERE NOT stale) AS valid, count(*) AS total FROM v_face GROUP BY clip_id")
def _(t):
    good = lambda c: F.when(~F.col("stale"), F.col(c))
    return t.v_face.groupBy("clip_id").agg(F.round(F.min(good("pitch")), 6).alias("low"), F.round(F.max(good("pitch")), 6).alias("high"), F.round(F.max(good("blink")), 6).alias("blink"), F.count_if(~F.col("stale")).alias("valid"), F.count("*").alias("total"))


_CROP_POINTS = """(SELECT clip_id, frame_idx, CAST((clip_id * 3 + frame_idx * 5 + i * 7) % 41 - 20 AS DOUBLE) / CAST(10 AS DOUBLE) AS x, CAST((clip_id + frame_idx * 2 + i * 11) % 37 - 18 AS DOUBLE) / CAST(10 AS DOUBLE) AS y, transl_z + CAST(i AS DOUBLE) / CAST(100 AS DOUBLE) AS z
  FROM (SELECT b.clip_id, b.frame_idx, b.transl_z, unnest(range(1, 131)) AS i FROM v_body b JOIN v_body_clips c ON c.clip_id = b.clip_id WHERE b.frame_idx < c.num_frames AND b.frame_idx % greatest(1, c.num_frames // 40) = 0) q)"""


@query(
    "agg_subject_crop",
    f"""WITH f AS (SELECT clip_id, frame_idx, min(x / z * 100 + 320) AS lx, min(y / z * 100 + 240) AS ly, max(x / z * 100 + 320) AS hx, max(y / z * 100 + 240) AS hy FROM {_CROP_POINTS} p WHERE z > CAST(0.001 AS DOUBLE) GROUP BY clip_id, frame_idx HAVING count(*) >= 100),
    b AS (SELECT clip_id, quantile_cont(lx, 0.05) AS lx, quantile_cont(ly, 0.05) AS ly, quantile_cont(hx, 0.95) AS hx, quantile_cont(hy, 0.95) AS hy FROM f GROUP BY clip_id),
    p AS (SELECT *, CAST(0.15 AS DOUBLE) * greatest(hx - lx, hy - ly) AS pad FROM b),
    c AS (SELECT clip_id, trunc(greatest(0, lx - pad))::INT AS x0, trunc(greatest(0, ly - pad))::INT AS y0, trunc(least(640, hx + pad))::INT AS x1, trunc(least(480, hy + pad))::INT AS y1 FROM p),
    d AS (SELECT clip_id, x0, y0, least(640, greatest(x0 + 16, x1)) AS x1, least(480, greatest(y0 + 16, y1)) AS y1 FROM c)
    SELECT clip_id, x0, y0, x1 - (x1 - x0) % 2 AS x1, y1 - (y1 - y0) % 2 AS y1 FROM d""",
)
def _(t):
    from framelake.operators.crop import sampled, subject_crop

    few = sampled(t.v_body.select("clip_id", "frame_idx", "transl_z"), t.v_body_clips)
    c, f, i = F.col("clip_id"), F.col("frame_idx"), F.col("i")
    each = few.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(130))))
    pts = each.select("clip_id", "frame_idx", (((c * 3 + f * 5 + i * 7) % 41 - 20) / 10).alias("x"), (((c + f * 2 + i * 11) % 37 - 18) / 10).alias("y"), (F.col("transl_z") + i / 100).alias("z"))
    return subject_crop(pts, fx=100.0, fy=100.0, cx=320.0, cy=240.0, width=640, height=480)


@query("agg_landmark_box", "SELECT vec_id, round(min(x) - CAST(0.15 AS DOUBLE) * (max(x) - min(x)), 5) AS x1, round(max(y) + CAST(0.15 AS DOUBLE) * (max(y) - min(y)), 5) AS y2 FROM (SELECT vec_id, unnest(list_transform(range(1, 33), lambda i: embedding[2 * i - 1]::DOUBLE)) AS x, unnest(list_transform(range(1, 33), lambda i: embedding[2 * i]::DOUBLE)) AS y FROM embeddings) q GROUP BY vec_id")
def _(t):
    from framelake.functions.geometry import landmark_box

    b = t.embeddings.select("vec_id", landmark_box(_points("embedding")).alias("b"))
    return b.select("vec_id", F.round("b.x1", 5).alias("x1"), F.round("b.y2", 5).alias("y2"))


def _points(column: str):
    return F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.struct(F.get(F.col(column), 2 * i).cast("double").alias("x"), F.get(F.col(column), 2 * i + 1).cast("double").alias("y")))


@query("agg_rigid_fit", "SELECT CAST(label AS BIGINT) AS clip_id, round(cos(label * CAST(0.7 AS DOUBLE)), 4) AS r0, round(-sin(label * CAST(0.7 AS DOUBLE)), 4) AS r1, round(sin(label * CAST(0.7 AS DOUBLE)), 4) AS r3, round(avg(CAST(1 AS DOUBLE)), 4) AS r8, round(label / CAST(4 AS DOUBLE), 4) AS t0, round(-label / CAST(8 AS DOUBLE), 4) AS t1, CAST(3 AS DOUBLE) AS t2 FROM embeddings GROUP BY label")
def _(t):
    from framelake.operators.mesh import rigid_fit

    e = lambda i: F.col("embedding")[i].cast("double")
    # A turn about z and a shift of each clip's own: the fit must find them again.
    turn, k = F.col("label") * 0.7, F.col("label").cast("double")
    pairs = t.embeddings.select(F.col("label").cast("long").alias("clip_id"), e(0).alias("ax"), e(1).alias("ay"), e(2).alias("az"), (e(0) * F.cos(turn) - e(1) * F.sin(turn) + k / 4).alias("bx"), (e(0) * F.sin(turn) + e(1) * F.cos(turn) - k / 8).alias("by"), (e(2) + 3).alias("bz"))
    whole = lambda c: F.round(c, 4) + 0.0
    return rigid_fit(pairs).select("clip_id", *(whole(F.col("r")[i]).alias(f"r{i}") for i in (0, 1, 3, 8)), *(whole(F.col("t")[i]).alias(f"t{i}") for i in range(3)))


@query("agg_pose_regularizer", "SELECT clip_id, round(0.001::DOUBLE * sum(list_sum(list_transform(range(1, 13), lambda i: (pose[i]::DOUBLE - pose[i + 20]::DOUBLE) * (pose[i]::DOUBLE - pose[i + 20]::DOUBLE)))) + 0.00002::DOUBLE * sum(list_sum(list_transform(range(13, 19), lambda i: (pose[i]::DOUBLE - pose[i + 20]::DOUBLE) * (pose[i]::DOUBLE - pose[i + 20]::DOUBLE)))), 7) AS penalty FROM v_poses GROUP BY clip_id")
def _(t):
    part = lambda a, n: F.slice("pose", a, n).cast("array<double>")
    sq = lambda a, b: total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))
    return t.v_poses.groupBy("clip_id").agg(F.round(0.001 * F.sum(sq(part(1, 12), part(21, 12))) + 0.00002 * F.sum(sq(part(13, 6), part(33, 6))), 7).alias("penalty"))


@query("topk_worst_diff", "SELECT clip_id, x AS worst FROM (SELECT clip_id, max(x) AS x FROM v_frames GROUP BY clip_id) q ORDER BY x DESC, clip_id LIMIT 5")
def _(t):
    return t.v_frames.groupBy("clip_id").agg(F.max("x").alias("worst")).orderBy(F.desc("worst"), "clip_id").limit(5)


@query("topk_preview", "SELECT session, count(*) AS n, string_agg(name, ',' ORDER BY name) FILTER (WHERE rn <= 5) || CASE WHEN count(*) > 5 THEN ',…' ELSE '' END AS preview FROM (SELECT session, CAST(name AS STRING) AS name, row_number() OVER (PARTITION BY session ORDER BY CAST(name AS STRING)) AS rn FROM v_sources) q GROUP BY session")
def _(t):
    s = t.v_sources.select("session", F.col("name").cast("string").alias("name"))
    k = F.row_number().over(Window.partitionBy("session").orderBy("name"))
    few = s.withColumn("k", k).where("k <= 5").groupBy("session").agg(F.array_join(F.array_sort(F.collect_list("name")), ",").alias("p"))
    n = s.groupBy("session").agg(F.count("*").alias("n"))
    return n.join(few, "session").select("session", "n", F.concat("p", F.when(F.col("n") > 5, ",…").otherwise("")).alias("preview"))


@query("sort_report", "SELECT session, condition, clip_id, num_frames FROM v_clips ORDER BY session, condition, clip_id")
def _(t):
    return t.v_clips.select("session", "condition", "clip_id", "num_frames").orderBy("session", "condition", "clip_id")


_K = "session, condition, name"
query("set_sources_intersect_outputs", f"SELECT {_K} FROM v_sources INTERSECT SELECT {_K} FROM v_outputs")(lambda t: t.v_sources.select(*A.KEYS).intersect(t.v_outputs.select(*A.KEYS)))
query("set_sources_except_outputs", f"SELECT {_K} FROM v_sources EXCEPT SELECT {_K} FROM v_outputs")(lambda t: t.v_sources.select(*A.KEYS).subtract(t.v_outputs.select(*A.KEYS)))
query("set_orphans", f"SELECT {_K} FROM v_outputs EXCEPT SELECT {_K} FROM v_sources")(lambda t: t.v_outputs.select(*A.KEYS).subtract(t.v_sources.select(*A.KEYS)))
query("anti_missing", f"SELECT {_K} FROM v_sources s WHERE NOT EXISTS (SELECT 1 FROM v_outputs o WHERE o.name = s.name AND o.session = s.session AND o.condition = s.condition)")(lambda t: t.v_sources.join(t.v_outputs, A.KEYS, "left_anti").select(*A.KEYS))


@query("join_audit_in_out", """SELECT coalesce(s.session, o.session) AS session, coalesce(s.condition, o.condition) AS condition, coalesce(s.name, o.name) AS name,
  CASE WHEN s.name IS NULL THEN 'orphan' WHEN o.name IS NOT NULL THEN 'ok' WHEN s.name % 3 = 0 THEN 'unsynced' ELSE 'NOT-DONE' END AS status FROM v_sources s FULL OUTER JOIN v_outputs o ON s.name = o.name AND s.session = o.session AND s.condition = o.condition""")
def _(t):
    return A.audit(t.v_sources, t.v_outputs, t.v_sources.select("name").where("name % 3 = 0"))


def _renamed(videos, every: int):
    """videos, each so many of them under a name that no clip has."""
    k = F.col("clip_id")
    return videos.withColumn("clip_id", k + F.when(k % every == 0, 100_000_000).otherwise(0))


@query("join_archive_to_video", "SELECT a.name, v.duration FROM v_outputs a LEFT JOIN v_videos v ON a.name = v.clip_id + CASE WHEN v.clip_id % 5 = 0 THEN 100000000 ELSE 0 END")
def _(t):
    # Of several videos of one stem the last path counts.
    videos = _renamed(t.v_videos, 5).groupBy(F.col("clip_id").alias("name")).agg(F.max_by("duration", "session").alias("duration"))
    return t.v_outputs.select("name").join(videos, "name", "left")


_ALIGN = "(SELECT c.clip_id, c.num_frames, v.nb_frames - c.num_frames AS delta, CASE WHEN v.clip_id IS NULL THEN 'missing' WHEN v.nb_frames IS NULL THEN 'not checked' WHEN v.nb_frames = c.num_frames THEN 'aligned' ELSE 'differs' END AS status FROM v_videos c LEFT JOIN (SELECT clip_id + CASE WHEN clip_id % 9 = 0 THEN 100000000 ELSE 0 END AS clip_id, nb_frames FROM v_videos) v ON c.clip_id = v.clip_id) q"


@query("join_frame_alignment", f"SELECT clip_id, num_frames, delta, status FROM {_ALIGN}")
def _(t):
    return A.alignment(t.v_videos.select("clip_id", "num_frames"), _renamed(t.v_videos, 9)).select("clip_id", "num_frames", "delta", "status")


@query("backfill_fps", "SELECT c.clip_id, CASE WHEN c.fps > 0 THEN c.fps ELSE coalesce(v.f, c.fps) END AS fps, CASE WHEN c.fps > 0 THEN 'already' WHEN v.f IS NULL THEN 'unmatched' ELSE 'todo' END AS outcome FROM v_videos c LEFT JOIN (SELECT clip_id, CASE clip_id % 4 WHEN 0 THEN 25.0::DOUBLE ELSE 30.0 END AS f, clip_id % 9 = 0 AS other FROM v_videos) v ON c.clip_id = v.clip_id AND NOT v.other")
def _(t):
    videos = _renamed(t.v_videos, 9).select("clip_id", F.when(F.col("clip_id") % 4 == 0, 25.0).otherwise(30.0).alias("video_fps"))
    return A.backfill_fps(t.v_videos.select("clip_id", "fps"), videos).select("clip_id", "fps", "outcome")


@query("dq_quality_report", """WITH q AS (SELECT c_custkey AS clip_id, c_custkey % 17 <> 0 AS readable, c_nationkey % 5 <> 0 AS hands_on, c_nationkey % 4 <> 0 AS face_on, c_nationkey % 3 = 0 AS gaze_on, c_custkey % 6 <> 0 AS has_det,
    c_acctbal / 10000 AS hands, c_custkey % 10 / 10.0::DOUBLE AS face, c_custkey % 7 / 10.0::DOUBLE AS gaze, CASE WHEN c_custkey % 8 <> 0 THEN c_custkey % 9 / 9.0::DOUBLE END AS ik FROM customer),
  r AS (SELECT *, CASE WHEN NOT readable THEN 1 ELSE (hands_on AND NOT has_det)::INT + (hands_on AND ik IS NULL)::INT END AS failures,
    CASE WHEN NOT readable THEN 0 ELSE (hands_on AND hands < CAST(0.3 AS DOUBLE))::INT + (face_on AND face < CAST(0.2 AS DOUBLE))::INT + (gaze_on AND gaze < CAST(0.2 AS DOUBLE))::INT + coalesce(hands_on AND ik < CAST(0.5 AS DOUBLE), false)::INT END AS warnings FROM q)
  SELECT clip_id, failures, warnings, CASE WHEN failures > 0 THEN 'FAILED' WHEN warnings > 0 THEN 'WARN' ELSE 'OK' END AS status FROM r""")
def _(t):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    clips = t.customer.select(
        k.alias("clip_id"), (k % 17 != 0).alias("readable"), (n % 5 != 0).alias("hands_on"), (n % 4 != 0).alias("face_on"), (n % 3 == 0).alias("gaze_on"), (k % 6 != 0).alias("has_detections"),
        (F.col("c_acctbal") / 10000).alias("hands"), (k % 10 / 10.0).alias("face"), (k % 7 / 10.0).alias("gaze"), F.when(k % 8 != 0, k % 9 / 9.0).alias("ik_coverage"),
    )
    return Q.quality_report(clips).select("clip_id", F.size("failures").alias("failures"), F.size("warnings").alias("warnings"), "status")


@query("dq_corpus_hand_gate", "SELECT clip_id, round((l + r) / 2, 6) AS coverage, (l + r) / 2 < CAST(0.05 AS DOUBLE) AS no_hands FROM (SELECT clip_id, avg(CASE WHEN left_valid AND (clip_id % 3 = 0 OR vec_id % 8 = 0) THEN 1.0::DOUBLE ELSE 0 END) AS l, avg(CASE WHEN right_valid AND clip_id % 3 = 0 THEN 1.0::DOUBLE ELSE 0 END) AS r FROM v_poses GROUP BY clip_id) q")
def _(t):
    # Two clips in three with hands in hardly any frame.
    third = F.col("clip_id") % 3 == 0
    hands = t.v_poses.withColumns({"left_valid": F.col("left_valid") & (third | (F.col("vec_id") % 8 == 0)), "right_valid": F.col("right_valid") & third})
    return Q.hand_gate(hands).withColumn("coverage", F.round("coverage", 6))


_STAMP_CHANGED = "list_filter([CASE WHEN code <> new_code THEN 'code' END, CASE WHEN flags <> new_flags THEN 'flags' END, CASE WHEN input <> new_input THEN 'input' END], lambda x: x IS NOT NULL)"


def _stamped(t):
    m = lambda p: F.create_map(F.lit("input"), F.col(f"{p}input"), F.lit("flags"), F.col(f"{p}flags"), F.lit("code"), F.col(f"{p}code"))
    return t.v_stamps.withColumn("changed", X.changed_keys(m(""), m("new_")))


query("set_changed_keys", f"SELECT artifact, array_to_string({_STAMP_CHANGED}, ',') AS changed FROM v_stamps")(lambda t: _stamped(t).select("artifact", F.array_join("changed", ",").alias("changed")))
_PLAN = f"""(SELECT artifact, CASE WHEN state IN ('missing', 'no stamp', 'unreadable', 'not an object') THEN state WHEN c = ['code'] THEN 'code changed' WHEN len(c) > 0 THEN 'changed: ' || array_to_string(c, ', ')
  WHEN state = 'broken' THEN 'broken' WHEN state = 'unknown' THEN 'not verified' ELSE '' END AS reason FROM (SELECT *, {_STAMP_CHANGED} AS c FROM v_stamps) q)"""


def _planned(t):
    return A.rebuild_plan(_stamped(t), F.col("changed"), F.col("state"))


query("dq_rebuild_plan", f"SELECT artifact, reason, CASE WHEN reason IN ('', 'not verified') THEN 'skip' ELSE 'rebuild' END AS action FROM {_PLAN} p")(lambda t: _planned(t).select("artifact", "reason", "action"))


@query("dq_rebuild_cascade", f"""WITH p AS (SELECT artifact // 6 AS clip, artifact % 6 AS k, reason NOT IN ('', 'not verified') AS own FROM {_PLAN} r),
  w AS (SELECT clip, bool_or(own AND k = 0) AS body, bool_or(own AND k = 1) AS face, bool_or(own AND k = 2) AS hands0, bool_or(own AND k = 3) AS gaze, bool_or(own AND k = 4) AS merge0, bool_or(own AND k = 5) AS ik0 FROM p GROUP BY clip),
  x AS (SELECT clip, body, face, hands0 OR body AS hands, gaze, merge0, ik0 FROM w) SELECT clip, body, hands, face, gaze, merge0 OR body OR hands OR face OR gaze AS merge, ik0 OR merge0 OR body OR hands OR face OR gaze AS ik FROM x""")
def _(t):
    from framelake.operators.cascade import cascade

    names = F.element_at(F.array(*(F.lit(n) for n in ("body", "face", "hands", "gaze", "merge", "ik"))), (F.col("artifact") % 6 + 1).cast("int"))
    plan = _planned(t).select(F.floor(F.col("artifact") / 6).alias("clip"), names.alias("stage"), (F.col("action") == "rebuild").alias("own"))
    return cascade(plan)


@query("dq_run_state", "SELECT o_orderkey AS clip_id, CASE o_orderkey % 3 WHEN 0 THEN 'SUCCESS' WHEN 1 THEN 'FAILED(' || o_orderpriority || ', ' || o_orderstatus || ')' ELSE 'never attempted' END AS state FROM orders")
def _(t):
    k = F.col("o_orderkey")
    return Q.run_state(t.orders.select(k.alias("clip_id"), F.when(k % 3 == 0, "SUCCESS").when(k % 3 == 1, "FAILED").alias("kind"), F.col("o_orderpriority").alias("stage"), F.col("o_orderstatus").alias("reason")))


_REPAIR = """(SELECT clip_id, CASE WHEN bool_or(s = 2) THEN 'refuse' WHEN bool_or(s = 1) THEN 'needs-repair' ELSE 'ok' END AS status FROM (SELECT *, CASE WHEN clip_id % 3 = 0 THEN 0 WHEN clip_id % 3 = 1 AND frame_idx % 4 = 0 THEN 1 WHEN clip_id % 3 = 2 AND frame_idx % 4 = 0 THEN 2 ELSE 0 END AS s FROM v_poses) q GROUP BY clip_id) r"""


def _repairs(t):
    dims = lambda at, by: F.transform("pose", lambda x, i: F.when(i == at, x.cast("double") + by).otherwise(x.cast("double")))
    a = F.transform("pose", lambda x: x.cast("double"))
    hit = F.col("frame_idx") % 4 == 0
    b = F.when(hit & (F.col("clip_id") % 3 == 1), dims(50, 0.5)).when(hit & (F.col("clip_id") % 3 == 2), dims(3, 0.5)).otherwise(a)
    return t.v_poses.withColumns({"a": a, "b": b})


query("repair_classify", f"SELECT clip_id, status FROM {_REPAIR}")(lambda t: A.classify_repairs(_repairs(t), "a", "b").select("clip_id", "status"))


@query("repair_apply", "SELECT clip_id, frame_idx, round(pose[51]::DOUBLE + CASE WHEN clip_id % 3 = 1 AND frame_idx % 4 = 0 THEN 0.5::DOUBLE ELSE 0 END, 5) AS value FROM v_poses")
def _(t):
    r = _repairs(t)
    return A.apply_repairs(r, A.classify_repairs(r, "a", "b"), "a", "b", dry_run=False).select("clip_id", "frame_idx", F.round(F.col("a")[50], 5).alias("value"))


_KEYS = "list_extract(['transl_z', 'betas', 'gaze_pitch', 'blink_left', 'expression', 'body_pose'], (l_linenumber % 6 + 1)::INT)"
_TOL = "CASE WHEN key LIKE '%transl%' THEN {0} WHEN key LIKE '%betas%' THEN {1} WHEN key LIKE '%gaze%' THEN {2} WHEN key LIKE '%blink%' THEN {2} WHEN key LIKE '%expression%' THEN {3} ELSE {0} END"


@query("golden_verdict", f"""WITH e AS (SELECT l_suppkey AS clip_id, {_KEYS} AS key, l_discount * l_tax * 3 AS err FROM lineitem), w AS (SELECT clip_id, count(*) FILTER (WHERE err > {_TOL.format('0.02::DOUBLE', '0.05::DOUBLE', '0.05::DOUBLE', '0.1::DOUBLE')}) AS tight, count(*) FILTER (WHERE err > {_TOL.format('0.06::DOUBLE', '0.2::DOUBLE', '0.1::DOUBLE', '0.3::DOUBLE')}) AS wide FROM e GROUP BY clip_id)
  SELECT clip_id, tight, wide, CASE WHEN clip_id % 7 = 0 THEN 'unusable' WHEN clip_id % 2 = 0 THEN CASE WHEN tight > 0 THEN 'fail' ELSE 'pass' END WHEN wide > 0 THEN 'fail' ELSE 'skip' END AS verdict FROM w""")
def _(t):
    key = F.element_at(F.array(*(F.lit(n) for n in ("transl_z", "betas", "gaze_pitch", "blink_left", "expression", "body_pose"))), F.col("l_linenumber") % 6 + 1)
    e = t.lineitem.select(F.col("l_suppkey").alias("clip_id"), key.alias("key"), (F.col("l_discount") * F.col("l_tax") * 3).alias("err"))
    w = e.groupBy("clip_id").agg(F.count_if(F.col("err") > A.tolerance_of(F.col("key"))).alias("tight"), F.count_if(F.col("err") > A.tolerance_of(F.col("key"), wide=True)).alias("wide"))
    return w.withColumn("verdict", A.verdict(F.col("clip_id") % 2 == 0, F.col("clip_id") % 7 != 0, F.col("tight"), F.col("wide")))
