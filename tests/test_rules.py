import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.functions import rotations as R
from framelake.functions import text as X
from framelake.operators import audit, frames, quality, tracks


def matrix(aa):
    t = np.linalg.norm(aa)
    if t < 1e-12:
        return np.eye(3)
    k = aa / t
    s = np.array([[0, -k[2], k[1]], [k[2], 0, -k[0]], [-k[1], k[0], 0]])
    return np.eye(3) + math.sin(t) * s + (1 - math.cos(t)) * s @ s


@pytest.mark.parametrize("kernel", [R.rotmats_to_axis_angles, R.matrices_to_axis_angles])
def test_rotations_come_back(kernel):
    rng = np.random.default_rng(7)
    aa = [v / np.linalg.norm(v) * rng.uniform(0, math.pi) for v in rng.normal(size=(2000, 3))]
    aa += [np.array(v) * (math.pi - d) for v in np.eye(3) for d in (1e-2, 1e-3, 1e-4, 1e-5, 1e-6, 0)]
    aa += [np.array([1.0, 0, 0]) * t for t in (0, 1e-9, 1e-5, 0.5, 3)]
    m = np.stack([matrix(v) for v in aa])
    back = np.stack([matrix(v) for v in kernel(m)])
    assert np.abs(back - m).max() < 1e-5 and np.median(np.abs(back - m)) < 1e-9


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize(("seen", "stale"), [([1] + [0] * 29, [False, True, True, True, True, True] + [None] * 24), ([1, 0, 0, 1, 0], [False, True, True, False, True])])
def test_a_box_is_carried_five_frames(spark, seen, stale):
    df = spark.createDataFrame([(1, i, float(i) if s else None) for i, s in enumerate(seen)], "clip_id long, frame_idx long, x double")
    got = frames.carry_forward(df, "x").orderBy("frame_idx").collect()
    assert [r.stale for r in got] == stale


def test_a_rejected_later_detection_does_not_erase_an_accepted_one(spark):
    df = spark.createDataFrame([(1, 0, 0, True, 10, 0.9), (1, 0, 1, True, 3, 0.9), (1, 0, 2, False, None, None), (1, 0, 3, False, 10, float("nan"))], "clip_id long, frame_idx long, det_idx long, is_right boolean, kp_count int, kp_conf double")
    got = frames.last_detection(frames.accepted_detections(df))
    assert {(r.is_right, r.det_idx) for r in got.collect()} == {(True, 0), (False, 3)}


def test_gaps_at_the_ends_have_open_sides(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([False, True, False, False, True, False])], "clip_id long, frame_idx long, valid boolean")
    got = frames.gap_islands(df).select("gap_start", "gap_end", "gap_len", "prev_valid", "next_valid")
    assert rows(got) == [(0, 1, 1, None, 1), (2, 4, 2, 1, 4), (5, 6, 1, 4, None)]


@pytest.mark.parametrize(("overlap", "area", "kind"), [(1800, 0.09, "subject"), (3, 0.09, "blip"), (900, 0.002, "blip"), (900, 0.048, "subject"), (None, 0.09, "subject"), (3, None, "subject")])
def test_multi_person_rule(spark, overlap, area, kind):
    s = spark.createDataFrame([(1, 0, 0, 1800, 1.0), (1, 1, 1, overlap, area)], "clip_id long, track_id long, rank int, n_overlap_frames long, area_share double")
    clips = spark.createDataFrame([(1, 1800)], "clip_id long, num_frames long")
    got = tracks.classify_tracks(s, clips)
    assert got.where("rank = 1").first().kind == kind
    assert tracks.multi_person_gate(got).first().failed == (kind == "subject")
    assert not tracks.multi_person_gate(got, chosen_explicitly=True).first().failed


@pytest.mark.parametrize(
    ("stderr", "stdout", "kind"),
    [("CUDA out of memory", None, "gpu memory"), (None, "moov atom not found", "broken video"), ("File size limit exceeded", "", "file size limit"), ("ENOSPC", "", "disk full"), ("Killed", "", "killed"), ("No person was detected anywhere in it", "", "no person"), ("RuntimeError: a\nValueError: b", "", "b"), ("x", "RuntimeError: a", "exit code 1")],
)
def test_errors_are_told_apart(spark, stderr, stdout, kind):
    df = spark.createDataFrame([(stderr, stdout, 1)], "e string, o string, c int")
    assert df.select(X.classify_error(F.col("e"), F.col("o"), F.col("c")).alias("k")).first().k == kind


def test_quality_rules(spark):
    schema = "clip_id long, readable boolean, hands_on boolean, face_on boolean, gaze_on boolean, has_detections boolean, hands double, face double, gaze double, ik_coverage double"
    given = [
        (1, False, True, True, True, True, 0.0, 0.0, 0.0, None),
        (2, True, True, True, False, True, 0.9, 0.9, 0.0, 0.9),
        (3, True, True, True, True, False, 0.1, 0.1, 0.1, None),
        (4, True, True, True, False, True, 0.9, 0.1, 0.0, 0.4),
        (5, True, False, False, False, False, 0.0, 0.0, 0.0, None),
    ]
    got = {r.clip_id: (r.status, len(r.failures), len(r.warnings)) for r in quality.quality_report(spark.createDataFrame(given, schema)).collect()}
    assert got == {1: ("FAILED", 1, 0), 2: ("OK", 0, 0), 3: ("FAILED", 2, 3), 4: ("WARN", 0, 2), 5: ("OK", 0, 0)}


def test_verdicts(spark):
    given = [(True, True, 1, 0, "fail"), (True, True, 0, 0, "pass"), (False, True, 5, 1, "fail"), (False, True, 5, 0, "skip"), (True, False, 0, 0, "unusable")]
    df = spark.createDataFrame(given, "same boolean, usable boolean, tight int, wide int, want string")
    assert all(r.v == r.want for r in df.select("want", audit.verdict(*map(F.col, ("same", "usable", "tight", "wide"))).alias("v")).collect())
