"""Operators over array channels: rules on hand-made rows, and plans."""

import math
import random
import re

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from framelake.functions import rotations
from framelake.operators import anchors, audit, compare, crop, depth, frames, fusion, mesh, quality
from framelake.operators.smoothing import one_euro
from framelake.streaming import jobs

HANDS = "clip_id long, frame_idx long, is_right boolean, det_idx long, kp_count int, kp_conf double, hand array<double>"
FACE = "clip_id long, timestep_id long, row_idx int, stale boolean, jaw array<double>, expression array<double>, eyes array<double>"


@pytest.fixture(scope="module")
def body(spark):
    return spark.createDataFrame([(c, f) for c in (1, 2) for f in range(4)] + [(None, 0)], "clip_id long, frame_idx long")


def test_hands_of_both_sides_are_filled_and_mirrored(spark, body):
    pose = lambda x: [1.0 * x, 2.0 * x, 3.0 * x] * 15
    rows = [(1, 0, True, 0, 21, 0.9, pose(0.1)), (1, 0, True, 2, 21, 0.9, pose(0.2)), (1, 0, True, 3, 3, 0.9, pose(9)), (1, 2, True, 0, None, None, pose(0.4)), (1, 1, False, 0, 21, 0.9, pose(0.1)), (1, 7, True, 0, 21, 0.9, pose(5)), (1, -1, False, 0, 21, 0.9, pose(5)), (9, 0, True, 0, 21, 1.0, pose(1))]
    got = {(r.clip_id, r.frame_idx): r for r in fusion.fuse(body, spark.createDataFrame(rows, HANDS), rest_pose=[0.5] * 45).collect()}
    assert len(got) == 9 and got[1, 0].right_hand_valid and got[1, 0].right_hand_pose == pose(0.2)
    assert not got[1, 1].right_hand_valid and got[1, 1].right_hand_pose[:3] == pytest.approx([0.3, 0.6, 0.9])
    assert got[1, 1].left_hand_valid and got[1, 1].left_hand_pose[:3] == [0.1, -0.2, pytest.approx(-0.3)]
    assert got[2, 0].left_hand_pose[:3] == [0.5, -0.5, -0.5] and got[2, 0].right_hand_pose == [0.5] * 45 and not got[None, 0].left_hand_valid
    # From the last detection towards rest, a 31st of the way.
    step = rotations.mixed_poses(np.array(pose(0.4)).reshape(1, 15, 3), np.full((1, 15, 3), 0.5), np.array([1 / 31]))
    assert got[1, 3].right_hand_pose == pytest.approx(step.ravel().tolist())


def test_face_and_gaze_rows(spark, body):
    face = [(1, 0, 0, False, [1.0, 2.0, 3.0, 4.0], [1.0] * 120, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]), (1, 0, 1, True, [9.0], [2.0] * 3, [7.0] * 5), (1, 1, 0, None, None, None, None), (1, 99, 0, False, [5.0] * 3, [5.0], [5.0] * 6)]
    got = {(r.clip_id, r.frame_idx): r for r in fusion.fuse(body, face=spark.createDataFrame(face, FACE)).collect()}
    a, b, c = got[1, 0], got[1, 1], got[2, 3]
    assert a.jaw_pose == [9.0, 0.0, 0.0] and a.expression == [2.0] * 3 + [0.0] * 97 and a.leye_pose == [1, 2, 3] and a.reye_pose == [4, 5, 6] and not a.face_valid
    assert b.face_valid and b.jaw_pose == [0.0] * 3 and not c.face_valid and c.expression == [0.0] * 100
    gaze = spark.createDataFrame([(1, 0, 0.5, 0.25, 1.0, 0.0)], "clip_id long, timestep_id long, gaze_pitch double, gaze_yaw double, blink_left double, blink_right double")
    got = {(r.clip_id, r.frame_idx): r for r in fusion.fuse(body, gaze=gaze).collect()}
    assert got[1, 0].gaze_valid and got[1, 0].gaze_yaw == 0.25 and not got[1, 1].gaze_valid and got[1, 1].blink_left == 0


def test_fusing_empty_tables(spark, body):
    hands, face = spark.createDataFrame([], HANDS), spark.createDataFrame([], FACE)
    got = fusion.fuse(body, hands, face).collect()
    assert len(got) == 9 and not any(r.left_hand_valid or r.face_valid for r in got) and all(r.right_hand_pose == [0.0] * 45 for r in got)
    assert fusion.fuse(body.limit(0), hands, face).count() == 0


def test_fusing_is_one_exchange(spark):
    from framelake.plans.fixtures import Tables

    t = Tables(spark, SF)
    tables = [spark.createDataFrame([], df.schema) for df in (t.v_body.select("clip_id", "frame_idx"), t.v_hands, t.v_faces, t.v_faces)]
    paths = []
    for i, df in enumerate(tables):
        from framelake.plans.io_queries import folder

        paths.append(folder(spark, f"fuse-{i}"))
        df.write.parquet(paths[-1])
    tables = [spark.read.schema(df.schema).parquet(p) for df, p in zip(tables, paths, strict=True)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = fusion.fuse(*tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.findall(r"\bExchange (\S+)", plan) == [m for m in re.findall(r"\bExchange (hashpartitioning\(clip_id#\d+L?,)", plan)] and len(re.findall(r"\bExchange\b", plan)) == 1
    assert "Join" not in plan and "BatchEvalPython" not in plan


def test_batches_mix_poses_as_columns_do(spark):
    r = random.Random(3)
    rows = [([r.gauss(0, 1.5) for _ in range(45)], [r.gauss(0, 1.5) for _ in range(45)], r.random()) for _ in range(30)] + [([0.0] * 45, [1e-9] * 45, 0.5), ([0.3] * 45, [0.3001] * 45, 0.2), (None, [0.0] * 45, 0.5), ([math.pi, 0.0, 0.0] * 15, [-math.pi, 0.0, 0.0] * 15, 0.5)]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>, t double")
    for x in df.select(rotations.slerp_poses("a", "b", "t").alias("x"), F.when(F.col("a").isNotNull(), rotations.slerp_pose(F.col("a"), F.col("b"), F.col("t"))).alias("y")).collect():
        assert x.x == x.y if x.y is None else x.x == pytest.approx(x.y, abs=1e-9)


def test_detections_out_of_range_are_told_and_meshes_placed(spark):
    det = spark.createDataFrame(
        [(1, 0, 0, True, 1.0, 2.0, 4.0, 500.0, [1.0, 2.0, 3.0]), (1, 7, 1, True, 1.0, 1.0, 1.0, None, [0.0]), (1, -1, 2, False, 1.0, 1.0, 1.0, None, None), (1, 1, 3, False, 1.0, 2.0, 4.0, None, [1.0, 2.0, 3.0]), (1, 2, 4, True, 1.0, 1.0, 1.0, 500.0, [1.0] * 3), (1, 3, 5, True, 1.0, 1.0, 1e-7, 500.0, [1.0] * 3), (8, 0, 6, True, 1.0, 1.0, 1.0, None, [1.0] * 3)],
        "clip_id long, frame_idx long, det_idx long, is_right boolean, cam_x double, cam_y double, cam_z double, focal double, verts array<double>",
    )
    joints = spark.createDataFrame([(1, f, 2.0, -1.0 if f == 2 else 8.0) for f in range(5)], "clip_id long, frame_idx long, left_z double, right_z double")
    clips = spark.createDataFrame([(1, 5, 1000.0, 640, 480)], "clip_id long, num_frames long, fx double, width int, height int")
    got = {r.det_idx: r for r in depth.depth_correct(det, joints, clips).collect()}
    assert {k: r.reject_reason for k, r in got.items()} == {0: "ok", 1: "out of range", 2: "out of range", 3: "ok", 4: "wrist_z", 5: "cam_z", 6: "out of range"}
    # The first detection is that of frame -1, without a focal length: 12,500 stands for it and doesn't match 1,000.
    assert (got[0].x, got[0].y, got[0].z) == (4.0, 8.0, 8.0) and got[0].verts == [2 + 4, 4 + 8, 6 + 8]
    assert (got[3].x, got[3].y, got[3].z) == (0.5, 1.0, 2.0) and got[3].verts == [-0.5 + 0.5, 1 + 1, 1.5 + 2] and got[5].verts is None


def test_joints_from_a_matrix_and_from_blocks(spark):
    r = np.random.default_rng(2)
    w = [(int(j), int(v), float(r.normal())) for j in range(6) for v in r.choice(300, 20, replace=False)]
    meshes = [(i, r.normal(size=900).tolist()) for i in range(20)] + [(20, None), (21, r.normal(size=150).tolist()), (22, [])]
    df, weights = spark.createDataFrame(meshes, "id long, verts array<double>"), spark.createDataFrame(w, "joint_id int, vertex_id int, weight double")
    for options in ({}, {"most": 10, "block": 64, "salts": 3}):
        got = {x.id: x.joints for x in mesh.regress_joints(df, weights, **options).collect()}
        assert got[20] is None and len(got) == 23
        for i, v in meshes[:20]:
            want = [[sum(x * v[3 * k + c] for jj, k, x in w if jj == j) for c in range(3)] for j in range(6)]
            assert np.allclose([[p.x, p.y, p.z] for p in got[i]], want)
        short = {p.joint_id: p.x is None for p in got[21]}
        assert short == {j: max(k for jj, k, _ in w if jj == j) >= 50 for j in range(6)} and all(p.y is None for p in got[22])
    assert mesh.regress_joints(df, weights.limit(0)).where("id = 3").first().joints == []


def test_scenes_stand_on_the_ground_and_face_ahead(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(3, 8, 3))
    rows = [(c, f, base[f].ravel().tolist()) for c in (1, 2) for f in range(3)]
    weights = spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.5), (1, 2, 1.0), (2, 3, 1.0), (16, 4, 1.0), (17, 5, 1.0)], "joint_id int, vertex_id int, weight double")
    df = spark.createDataFrame(rows, "clip_id long, frame_idx long, verts array<double>")
    plain = {(x.clip_id, x.frame_idx): np.array(x.verts).reshape(-1, 3) for x in mesh.scene_normalise(df, weights).collect()}
    turned = {(x.clip_id, x.frame_idx): np.array(x.verts).reshape(-1, 3) for x in mesh.scene_normalise(df, weights, facing=((1, 2), (16, 17))).collect()}
    root = base[0, :2].mean(axis=0)
    for f in range(3):
        assert np.allclose(plain[1, f], base[f] - [root[0], base[:, :, 1].min(), root[2]])
        assert np.allclose(np.linalg.norm(turned[2, f][:, ::2], axis=1), np.linalg.norm(plain[2, f][:, ::2], axis=1)) and np.allclose(turned[2, f][:, 1], plain[2, f][:, 1])
    across = turned[1, 0][2] - turned[1, 0][3] + turned[1, 0][4] - turned[1, 0][5]
    assert across[0] > 0 and across[2] == pytest.approx(0, abs=1e-9)


def test_golden_runs(spark):
    schema = "clip_id long, frame_idx long, left_hand_pose array<double>, left_hand_valid boolean, gaze_pitch double, gaze_valid boolean, K_fullimg array<array<double>>"
    golden = [(1, f, [0.0] * 45, f != 3, 0.0, True, [[1.0, 2.0], [3.0, 4.0]]) for f in range(40)]
    run = [(c, f, [0.01] * 44 + [5.0 if f == 3 else 0.0], v, 0.06 if f == 7 else g, True, k) for c, f, _, v, g, _, k in golden]
    keys = ["left_hand_pose", "gaze_pitch", "K_fullimg", "left_hand_valid", "gaze_valid"]
    check = lambda a, b, **k: {r.key: (r.error, r.failed) for r in compare.compare_runs(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), keys, **k).collect()}
    got = check(run, golden)
    assert got["left_hand_pose"] == (pytest.approx(0.01), False) and got["gaze_pitch"] == (0.06, True) and got["K_fullimg"] == (0, False) and got["frames"] == (0, False)
    assert not check(run, golden, wide=True)["gaze_pitch"][1]
    off = [(*x[:5], i >= 2, [[1.0, 2.0]] if i == 0 else x[6]) for i, x in enumerate(run)]
    got = check(off[:39], golden)
    assert got["gaze_valid"] == (pytest.approx(2 / 39), True) and got["K_fullimg"] == (float("inf"), True) and got["frames"] == (1, True)
    assert not check([(*x[:5], i >= 2, x[6]) for i, x in enumerate(run)], golden)["gaze_valid"][1]
    odd = [(*x[:2], [float("nan")] * 45 if i == 3 else None if i == 5 else x[2], *x[3:]) for i, x in enumerate(run)]
    assert check(odd[:5], golden[:5])["left_hand_pose"] == (pytest.approx(0.01), False) and check(odd, golden)["left_hand_pose"] == (float("inf"), True)


def test_anchors_and_their_loss(spark):
    verts = lambda k: [float(k + i) for i in range(30)]
    placed = spark.createDataFrame([(1, 0, 0, True, verts(0)), (1, 0, 1, True, verts(100)), (1, 0, 2, True, None), (1, 2, 0, False, verts(5)), (1, 9, 0, False, verts(5))], "clip_id long, frame_idx long, det_idx long, is_right boolean, verts array<double>")
    ids = spark.createDataFrame([(0, 4), (1, 1)], "place int, vertex_id int")
    clips = spark.createDataFrame([(1, 3), (2, 1)], "clip_id long, num_frames long")
    targets = anchors.anchor_targets(placed, ids, clips)
    got = {(r.clip_id, r.frame_idx): r for r in targets.collect()}
    assert len(got) == 4 and got[1, 0].right_target == [112.0, 113, 114, 103, 104, 105] and got[1, 0].left_weight == 0 and got[1, 0].left_target == [0.0] * 6 and got[1, 2].left_weight == 1 and got[2, 0].right_weight == 0
    found = targets.select("clip_id", "frame_idx", F.transform("left_target", lambda x: x + 2).alias("left_ring"), F.transform("right_target", lambda x: x - 1).alias("right_ring")).where("frame_idx < 2")
    loss = {(r.clip_id, r.frame_idx): r.loss for r in anchors.ring_loss(targets, found).collect()}
    assert loss == {(1, 0): 3.0, (1, 1): 0.0, (1, 2): 0.0, (2, 0): 0.0}


def test_solved_joints_are_spliced_and_smoothed(spark):
    rows = [(c, f, [float(c * f + i) for i in range(63)], [-1.0] * 63) for c in (1, 2) for f in range(5)]
    df = spark.createDataFrame(rows, "clip_id long, frame_idx long, body_pose array<double>, body_pose_incam array<double>")
    solved = spark.createDataFrame([(1, 2, [100.0] * 18, 0.5), (1, 3, [101.0] * 18, 0.25)], "clip_id long, frame_idx long, arms array<double>, loss double")
    hands = spark.createDataFrame([(1, 4)], "clip_id long, n_hand_frames long")
    got = {(r.clip_id, r.frame_idx): r for r in anchors.upsert_solved(df, solved, hands).collect()}
    spliced = [[100.0] * 18 if f == 2 else [101.0] * 18 if f == 3 else [float(f + i) for i in range(45, 63)] for f in range(5)]
    smooth = {r.frame_idx: r.smooth for r in one_euro(spark.createDataFrame([(1, f, a) for f, a in enumerate(spliced)], "clip_id long, frame_idx long, a array<double>"), "a").collect()}
    for f in range(5):
        assert got[1, f].body_pose == pytest.approx([float(f + i) for i in range(45)] + smooth[f]) and got[1, f].body_pose_incam == got[1, f].body_pose
        assert got[2, f].body_pose == rows[5 + f][2] and got[2, f].body_pose_incam == [-1.0] * 63 and (got[2, f].ik_n_targets, got[2, f].ik_coverage, got[2, f].ik_wrist_loss) == (0, 0, 0)
    assert (got[1, 0].ik_n_targets, got[1, 0].ik_coverage) == (2, 0.5) and [got[1, f].ik_wrist_loss for f in range(5)] == [0, 0, 0.5, 0.25, 0]


def test_classes_of_dyads(spark):
    clips = spark.createDataFrame([(k, "S1", "BP" if k < 500 else "CS", 100 + (k == 7)) for k in range(502)], "clip_id long, session string, condition string, num_frames long")
    got = {r.clip_id: (r.first_clip, r.partners, r.same_length) for r in compare.dyads(clips).collect()}
    assert got[7] == (0, 499, 0) and got[8] == (0, 499, 498) and got[501] == (500, 1, 1) and len(got) == 502


def test_an_audit_without_sources_fails(spark):
    s = spark.createDataFrame([("a", "S1", "BP"), ("b", "S1", "BP"), ("c", "S2", None)], "name string, session string, condition string")
    o = s.limit(1).withColumn("excerpt", F.lit(True))
    got = {(r.session, r.condition): (r.source, r.output, r.excerpt, r.gap) for r in audit.rollup_counts(s, o).collect()}
    assert got == {("S1", "BP"): (2, 1, 1, True), ("S2", None): (1, 0, 0, True), ("TOTAL", "TOTAL"): (3, 1, 1, True)}
    with pytest.raises(Exception, match="no source at all"):
        audit.rollup_counts(s.limit(0), o).collect()


def test_losses_of_unsolved_clips(spark):
    df = spark.createDataFrame([(1, 0.01), (1, 0.03), (1, 0.0), (2, 0.01), *[(2, 0.0)] * 9, (3, 0.5), (4, 0.0)], "clip_id long, loss double")
    got = {r.clip_id: (r.covered, r.median, r.solved) for r in quality.loss_stats(df, "loss").collect()}
    assert got == {1: (pytest.approx(2 / 3), 0.02, True), 2: (0.1, 0.01, False), 3: (1, 0.5, False), 4: (0, None, False)}
    assert quality.loss_stats(df.where("clip_id = 1"), "loss", strict=True).collect()[0].solved
    with pytest.raises(Exception, match="clip 3 isn't solved"):
        quality.loss_stats(df.where("clip_id = 3"), "loss", strict=True).collect()


def test_strides_and_samples(spark):
    f = spark.range(1000).select(F.lit(1).alias("clip_id"), F.col("id").alias("frame_idx"))
    few = f.unionByName(f.where("frame_idx < 30").withColumn("clip_id", F.lit(2)))
    clips = spark.createDataFrame([(1, 500, 100), (2, 30, 0)], "clip_id int, num_frames long, start long")
    got = [(r.clip_id, r.frame_idx) for r in crop.sampled(few, clips).orderBy("clip_id", "frame_idx").collect()]
    assert got == [(1, i) for i in range(100, 600, 12)] + [(2, i) for i in range(30)]
    labels = spark.createDataFrame([(v, 20 if v % 2 else 3) for v in range(40)] + [(99, 10)], "vertex_id long, joint_id int")
    parts = {r.vertex_id: (r.part, r.collides) for r in mesh.body_parts(labels).collect()}
    assert {v for v, (p, c) in parts.items() if p == "arm" and c} == set(range(1, 40, 6)) and {v for v, (p, c) in parts.items() if p == "torso" and c} == set(range(0, 40, 10)) and parts[99] == (None, False)


def test_a_stage_uses_what_is_over_the_first_sample(spark):
    ts = "timestamp_ntz"
    samples = spark.sql(f"SELECT * FROM VALUES (1, {ts}'2024-01-01 00:00:00', 5.0D, 0.0D), (1, {ts}'2024-01-01 00:00:10', 9.0D, 10.0D), (1, {ts}'2024-01-01 00:00:12', 4.0D, 20.0D), (1, {ts}'2024-01-01 00:01:00', 3.0D, 90.0D) AS t(run_id, ts, used, util)")
    stages = spark.sql(f"SELECT * FROM VALUES (1, 'startup', {ts}'2024-01-01 00:00:00', {ts}'2024-01-01 00:00:08'), (1, 'a', {ts}'2024-01-01 00:00:08', {ts}'2024-01-01 00:00:20'), (1, 'b', {ts}'2024-01-01 00:00:50', {ts}'2024-01-01 00:01:30') AS t(run_id, stage, start_ts, end_ts)")
    got = {r.stage: (r.peak, r.util, r.seconds, r.underused) for r in audit.stage_bench(samples, stages).collect()}
    assert got == {"a": (4.0, 15.0, 12.0, True), "b": (0.0, 90.0, 40.0, False)}


def test_late_frames_are_counted(spark, tmp_path):
    rows = [[(1, 0, 1.0), (1, 3, 2.0)], [(1, 1, 9.0), (1, 3, 9.0), (1, 4, None), (2, 0, None)], [(1, 2, 9.0), (2, 0, 5.0), (2, 1, 5.0)]]
    at = str(tmp_path / "in")
    for part in rows:
        spark.createDataFrame(part, "clip_id long, frame_idx long, x double").coalesce(1).write.mode("append").parquet(at)
    for i, (job, column) in enumerate(((jobs.carry_forward, "carried"), (jobs.one_euro, "smooth"))):
        given = spark.readStream.schema("clip_id long, frame_idx long, x double").option("maxFilesPerTrigger", 1).parquet(at)
        given = given if column == "carried" else given.where("x IS NOT NULL")
        q = job(given).writeStream.format("parquet").option("path", str(tmp_path / f"out{i}")).option("checkpointLocation", str(tmp_path / f"log{i}")).trigger(availableNow=True).start()
        q.awaitTermination()
        out = spark.read.parquet(str(tmp_path / f"out{i}"))
        late = {r.clip_id: (r.rows, r.late) for r in jobs.late_counts(out).collect()}
        assert late == ({1: (6, 3), 2: (3, 1)} if column == "carried" else {1: (5, 3), 2: (2, 0)})
        assert out.where(f"late AND {column} IS NOT NULL").count() == 0
        if column == "carried":
            assert {(r.clip_id, r.frame_idx): r.carried for r in out.where("NOT late").collect()} == {(1, 0): 1.0, (1, 3): 2.0, (1, 4): 2.0, (2, 0): None, (2, 1): 5.0}


def test_gaps_of_long_clips_are_read_once(spark):
    f = spark.range(60_000).select(F.lit(1).alias("clip_id"), F.col("id").alias("frame_idx"), (F.col("id") % 20_000 == 5).alias("valid"))
    got = [(r.gap_start, r.gap_end, r.prev_valid, r.next_valid) for r in frames.gap_islands(f).orderBy("gap_start").collect()]
    assert got == [(0, 5, None, 5), (6, 20_005, 5, 20_005), (20_006, 40_005, 20_005, 40_005), (40_006, 60_000, 40_005, None)]


def test_smoothing_at_each_clips_own_rate(spark):
    r = random.Random(1)
    rows = [(c, f, r.random(), fps) for c, fps in ((1, 25.0), (2, 60.0), (3, 0.0), (4, None)) for f in range(20)]
    df = spark.createDataFrame(rows, "clip_id long, frame_idx long, x double, fps double")
    got = {(x.clip_id, x.frame_idx): x.smooth for x in one_euro(df, "x", fps="fps").collect()}
    for c, fps in ((1, 25.0), (2, 60.0), (3, 29.97), (4, 29.97)):
        one = {(x.clip_id, x.frame_idx): x.smooth for x in one_euro(df.where(F.col("clip_id") == c), "x", fps=fps).collect()}
        assert {k: v for k, v in got.items() if k[0] == c} == one
