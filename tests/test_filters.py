import math

import pytest
from pyspark.sql import functions as F

from gaitmill.operators import balance as b
from gaitmill.operators import forward as fw
from gaitmill.operators import stage3 as g
from gaitmill.operators import wash as w
from tests.conftest import rows

RULE = b.BalanceRule()


def motion(spark, xs, yaw=None, fps=60.0):
    n = len(xs)
    yaw = yaw or [0.0] * n
    data = [
        ("m", i, float(x), 0.0, math.cos(a / 2), 0.0, 0.0, math.sin(a / 2))
        for i, (x, a) in enumerate(zip(xs, yaw))
    ]
    poses = spark.createDataFrame(
        data, "seg_id string, frame_idx long, x double, y double, qw double, qx double, qy double, qz double"
    )
    motions = spark.createDataFrame([("m", n, fps)], "seg_id string, n_frames long, fps double")
    found = b.describe_motions(poses, motions, RULE)
    return found.withColumn("stationary", b.is_stationary(RULE)).first()


def test_slow_drift_is_stationary(spark):
    d = motion(spark, [0.05 * i / 180 for i in range(181)])
    assert d.max_excursion_m == pytest.approx(0.05)
    assert d.p95_window_speed < 0.02 and d.max_rotation_deg == pytest.approx(0.0, abs=1e-6)
    assert d.stationary and d.window_frames == 30


def test_out_and_back_is_moving(spark):
    d = motion(spark, [1 - abs(i - 90) / 90 for i in range(181)])
    assert d.max_excursion_m > 0.9 and not d.stationary


def test_turn_in_place_is_moving(spark):
    d = motion(spark, [0.0] * 181, [math.radians(45) * i / 180 for i in range(181)])
    assert d.max_rotation_deg == pytest.approx(45.0) and not d.stationary


def round_robin(items, quota, seed):
    import hashlib

    def h(*parts):
        return hashlib.sha256("\x1f".join(map(str, (seed, *parts))).encode()).hexdigest()

    buckets = {}
    for seg, source, duration_bin, x, y in items:
        buckets.setdefault((source, duration_bin, x, y), []).append(seg)
    queues = [sorted(buckets[k], key=lambda s: h("motion", s))
              for k in sorted(buckets, key=lambda k: h("stratum", *k))]
    picked, level = [], 0
    while len(picked) < quota:
        picked += [q[level] for q in queues if level < len(q)]
        level += 1
    return set(picked[:quota])


@pytest.mark.parametrize("max_rows", [10_000, 20])
@pytest.mark.parametrize("partitions", [1, 7])
def test_selection_is_round_robin(spark, max_rows, partitions):
    data = []
    for i in range(120):
        moving = i % 6 == 0
        data.append((f"s{i}", "g1" if i < 100 else "g2", "cat", f"rec{i % 3}", 4.0 + i % 20,
                     float(i % 4), -0.5 * (i % 3), not moving, 100))
    df = spark.createDataFrame(
        data,
        "seg_id string, terrain_group string, category string, source_recording string, duration_s double, "
        "start_x double, start_y double, stationary boolean, n_frames long",
    ).repartition(partitions)
    rule = b.BalanceRule(seed=123)
    decided = b.decide(df, rule, max_rows=max_rows).collect()
    for group in ("g1", "g2"):
        mine = [r for r in decided if r.terrain_group == group]
        quota = sum(not r.stationary for r in mine)
        items = [
            (r.seg_id, r.source_recording,
             "3-5" if r.duration_s < 5 else "5-10" if r.duration_s < 10 else "10-20" if r.duration_s < 20 else "20-60",
             math.floor(r.start_x), math.floor(r.start_y))
            for r in mine if r.stationary
        ]
        kept = {r.seg_id for r in mine if r.stationary and r.decision == "keep"}
        assert kept == round_robin(items, quota, 123) and len(kept) == quota
        assert all(r.decision == "keep" for r in mine if not r.stationary)


def test_zero_quota_selects_none(spark):
    df = spark.createDataFrame(
        [("s", "g", "c", "r", 5.0, 0.0, 0.0, True, 9), ("t", "g", "c", "r", 2.0, 0.0, 0.0, False, 9)],
        "seg_id string, terrain_group string, category string, source_recording string, duration_s double, "
        "start_x double, start_y double, stationary boolean, n_frames long",
    )
    got = {r.seg_id: r.reject_reason for r in b.decide(df, RULE).collect()}
    assert got == {"s": "stationary_balance_excess", "t": "duration_lt_min"}


def commands(spark, forwards):
    return spark.createDataFrame(
        [("m", i, v) for i, v in enumerate(forwards)], "seg_id string, frame_idx long, forward double"
    )


def test_one_backward_frame_rejects(spark):
    scan = fw.scan_motion(commands(spark, [1.0, 0.0, -1.0, 1.0]), ["seg_id"], "frame_idx", "forward")
    r = scan.first()
    assert (r.frame_count, r.backward_frames, r.first_backward_frame, r.last_backward_frame) == (4, 1, 2, 2)
    assert r.min_forward_cmd == -1.0
    manifest = spark.createDataFrame([("m", "c", 4, 1.0)], "seg_id string, category string, n_frames long, duration_s double")
    judged = fw.judge(manifest, scan)
    assert not judged.first().keep and judged.first().reject_reason == "contains_backward_cmd"
    fw.validate(judged)
    with pytest.raises(ValueError, match="frame count"):
        fw.validate(judged.withColumn("n_frames", F.lit(5)))


def test_axis_noise_is_ignored(spark):
    scan = fw.scan_motion(commands(spark, [1.0, -0.01, 0.0]), ["seg_id"], "frame_idx", "forward")
    assert scan.first().backward_frames == 0


def test_stage3_subset(spark):
    solved = spark.createDataFrame([("keep", "c"), ("reject", "c")], "seg_id string, category string")
    accepted, rejected = solved.where("seg_id = 'keep'"), solved.where("seg_id = 'reject'")
    assert [r.status for r in fw.subset_solved(solved, accepted).collect()] == ["qa_ok_forward_only"]
    assert fw.solved_rejects(solved, rejected).count() == 1
    assert fw.set_differences(accepted, rejected, solved).count() == 0
    assert fw.set_differences(accepted, accepted, rejected).count() == 2


@pytest.mark.parametrize("max_rows", [1000, 4])
def test_wash_runs(spark, max_rows):
    bad = [0, 0, 1, 0, 1, 1, 0, 0, 0]
    df = spark.createDataFrame(
        [("c", "r", i, i / 2.0, 0.5, bool(x), 0.0, 1.0, 1.0, 1.0, None if i == 2 else 1.0) for i, x in enumerate(bad)],
        "category string, recording_id string, frame_idx long, t double, dt double, crouch boolean, "
        "move_right double, move_forward double, scale_x double, scale_y double, scale_z double",
    )
    rule = w.WashRule(min_frames=2, min_duration=0.5)
    runs = w.good_runs(df, rule=rule, max_rows=max_rows)
    got = [(r.seg_id, r.i0, r.i1, r.keep) for r in runs.orderBy("i0").collect()]
    assert got == [("r_seg000", 0, 2, True), ("r_seg001", 3, 4, False), ("r_seg002", 6, 9, True)]
    per = w.composition(df, w.CommandColumns(), rule)
    assert per.first().mesh_scale.missing_frames == 1
    accepted = w.accepted_manifest(runs, per, None, rule=rule)
    assert {r.fps_src for r in accepted.collect()} == {60.0}
    kept = w.washed_frames(df, accepted, ["category", "recording_id"], page_rows=2)
    assert rows(kept.select("seg_id", "frame_idx", "t"), "seg_id", "frame_idx") == [
        ("r_seg000", 0, 0.0), ("r_seg000", 1, 0.5),
        ("r_seg002", 0, 3.0), ("r_seg002", 1, 3.5), ("r_seg002", 2, 4.0),
    ]
    scaled = g.infer_manifest_scale(accepted)
    assert {r.scale_problem for r in scaled.collect()} == {"missing"}


def test_steering_needs_side_and_magnitude(spark):
    df = spark.createDataFrame([(0.25, 1.0), (0.26, 0.0), (-0.3, 0.5), (None, None)], "s double, f double")
    got = [r[0] for r in df.select(w.is_steering(F.col("s"), F.col("f"), w.WashRule())).collect()]
    assert got == [False, True, True, False]


def test_pose_checks(spark):
    nan = float("nan")
    data = [("ok", [1.0, 2.0]), ("ok", [0.0, 0.0]), ("thin", [1.0]), ("nan", [1.0, nan]), ("inf", [1.0, -math.inf])]
    poses = spark.createDataFrame(data, "seg_id string, q array<double>")
    checks = g.pose_check(poses, width=2)
    work = spark.createDataFrame([("ok", 2), ("thin", 1), ("nan", 1), ("inf", 1), ("none", 3)], "seg_id string, n_frames long")
    reasons = {r.seg_id: r.reject_reason for r in g.failure_reason(work.join(checks, "seg_id")).collect()}
    assert reasons == {"ok": None, "thin": g.SHAPE_REASON, "nan": g.NUMBER_REASON, "inf": g.NUMBER_REASON}
    assert {r.seg_id for r in g.still_to_do(work, checks).collect()} == {"thin", "nan", "inf", "none"}


def test_pair_problems(spark):
    s2 = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 1.0), ("c", 1, 1.0)], "seg_id string, n_frames long, duration_s double")
    s3 = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 1.0), ("d", 1, 1.0)], "seg_id string, n_frames long, duration_s double")
    assert rows(b.pair_problems(s2, s3), "seg_id") == [
        ("b", "n_frames_differ"), ("c", "missing_stage3"), ("d", "extra_stage3"),
    ]
    with pytest.raises(ValueError):
        b.validate_pair(s2, s3)
    b.validate_pair(s2, s2)
