"""Plans at size: tables of frames, which Spark takes for small where they are exploded, are not sent to all tasks."""

import pytest
from conftest import SF

from framelake.plans.all import QUERIES


def exploded_and_sent(plan, sent=False):
    """The nodes that explode below a broadcast."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return exploded_and_sent(plan.executedPlan(), sent)
    sent = sent or name == "BroadcastExchange"
    below = [plan.children().apply(i) for i in range(plan.children().size())]
    return [plan.simpleString(100)] * (sent and name == "Generate") + [x for p in below for x in exploded_and_sent(p, sent)]


@pytest.mark.parametrize(
    "key",
    [
        "agg_depth_outliers",
        "filter_body_valid",
        "agg_ik_coverage",
        "join_sparse_lookup",
        "join_eye_pose",
        "agg_subject_crop",
        "join_depth_correct",
        "agg_reject_reasons",
        "join_anchor_targets",
        "agg_ring_loss",
    ],
)
def test_frames_are_not_broadcast(spark, key):
    assert exploded_and_sent(QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan()) == []


def test_poses_of_both_hands_share_their_windows(spark):
    plan = QUERIES["join_fuse_streams"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    own = plan.split("Union")[0]
    assert sum(line.lstrip(" :+-").startswith("Window ") for line in own.split("\n")) == 2


def test_rows_without_a_frame_rest(spark):
    from pyspark.sql import functions as F

    from framelake.functions.rotations import slerp_poses
    from framelake.operators.frames import fill_gaps

    rows = [(1, None, False, None), (1, 0, False, None), (1, 1, True, [0.2] * 3), (1, 2, False, None), (1, 3, True, [0.4] * 3), (1, 4, False, None)]
    df = spark.createDataFrame(rows, "clip_id long, frame_idx long, valid boolean, pose array<double>")
    got = {r.frame_idx: r.filled for r in fill_gaps(df, "pose", "valid", F.array(*(F.lit(0.0) for _ in range(3))), slerp_poses).collect()}
    assert got[None] == [0.0] * 3 and got[1] == [0.2] * 3 and abs(got[2][0] - 0.3) < 1e-9
    assert abs(got[0][0] - 0.2 / 31) < 1e-9 and abs(got[4][0] - 0.4 * 30 / 31) < 1e-9


def test_frames_of_a_small_table_are_made_by_several_tasks(spark):
    from framelake.plans.fixtures import Tables

    assert Tables(spark, SF).v_body.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
