import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaitmill.operators import metrics as m
from gaitmill.operators import stats, wash
from gaitmill.sinks import reports, tables
from gaitmill.sources import captures as cap
from gaitmill.sources import manifests, poses
from tests.conftest import rows


def frame(t, f, right=0.0, crouch=False):
    return {
        "t": t, "dt": 0.1, "f": f, "cmd": {"move": [right, 1.0], "crouch": crouch, "jump": f == 1},
        "root": {"p": [1.0, 2.0, 3.0], "mesh": {"s": [0.77, 0.77, 0.77]}},
        "joints": [{"n": "pelvis", "pi": -1, "wp": [1, 2, 3]}],
    }


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("captures")
    for category, rec, n in (("ground", "a_1", 4), ("stairs", "b", 3)):
        folder = base / category
        folder.mkdir(exist_ok=True)
        lines = [json.dumps(frame(i * 0.1, i)) for i in range(n)]
        (folder / f"{rec}_frames.jsonl").write_text("\n\n".join(reversed(lines)) + "\n")
        meta = {
            "sample_rate_hz": 50, "start_time": "2026-07-17T07:30:18.808Z", "terrain_ref": "",
            "bone_names": ["root", "pelvis", "head"], "parent_indices": [-1, 0, 1],
        }
        (folder / f"{rec}_meta.json").write_text(json.dumps(meta, indent=1))
    (base / "stairs" / "broken_frames.jsonl").write_text(json.dumps(frame(0, 0)) + "\n{oops\n")
    (base / "ground" / "alone_meta.json").write_text(json.dumps({"terrain_ref": "terrain_X.json"}))
    return str(base)


def test_frames_meta_and_pairs(spark, root):
    frames = cap.read_frames(spark, root)
    broken = wash.parse_rejects(frames.cache(), cap.CORRUPT, cap.KEYS)
    assert [r.seg_id for r in broken.collect()] == ["broken"]
    good = wash.readable(frames, broken, cap.KEYS).drop(cap.CORRUPT)
    indexed = cap.with_frame_index(good, order=("f",))
    got = rows(cap.frame_header(indexed).select("recording_id", "frame_idx", "t", "px", "scale_y", "jump"),
               "recording_id", "frame_idx")
    assert got[:2] == [("a_1", 0, 0.0, 1.0, 0.77, False), ("a_1", 1, 0.1, 1.0, 0.77, True)]
    assert len(got) == 7

    metas = cap.read_meta(spark, root)
    files = cap.list_files(spark, root, "_frames.jsonl")
    pairs, alone = cap.recording_pairs(metas, files)
    assert {r.recording_id for r in pairs.collect()} == {"a_1", "b"}
    assert [r.recording_id for r in alone.collect()] == ["alone"]
    scales = [(r.recording_id, r.data_scale) for r in cap.playlist(pairs).collect()]
    assert scales == [("a_1", 1.0), ("b", 1.0)]
    assert cap.playlist(pairs, limit=1, seed=4).count() == 1
    assert metas.where("recording_id = 'b'").first().terrain_ref is None
    with pytest.raises(Exception, match="(?i)malformed"):
        cap.read_frames(spark, root, ["stairs"], strict=True).select("t", "f").collect()


def test_repeated_and_missing_counters_keep_the_rows(spark, tmp_path):
    (tmp_path / "ground").mkdir()
    lines = ['{"t": 0.0, "f": 0}', '{"t": 0.1, "f": 1}', '{"t": 0.2, "f": 1}', '{"t": 0.3}', '{"t": 0.4, "f": null}']
    (tmp_path / "ground" / "r_frames.jsonl").write_text("\n".join(lines) + "\n")
    frames = cap.read_frames(spark, str(tmp_path), strict=True)
    indexed = cap.with_frame_index(frames).orderBy("frame_idx").collect()
    assert [(r.frame_idx, r.t, r.f) for r in indexed] == [
        (0, 0.0, 0), (1, 0.1, 1), (2, 0.2, 1), (3, 0.3, None), (4, 0.4, None)
    ]
    with pytest.raises(ValueError, match="equal order"):
        cap.with_frame_index(frames, order=("f",))


def test_bones(spark, root):
    bones = cap.bone_table(cap.read_meta(spark, root, ["stairs"]))
    assert [(r.bone, r.bone_idx) for r in cap.bone_lookup(bones, ["head"]).collect()] == [("head", 2)]
    with pytest.raises(ValueError, match="tail"):
        cap.bone_lookup(bones, ["head", "tail"])
    edges = cap.connections(bones, [("pelvis", "head"), ("head", "tail"), ("root", "pelvis")])
    assert [(r.from_idx, r.to_idx) for r in edges.orderBy("edge_no").collect()] == [(1, 2), (0, 1)]


def test_land_prunes_joints(spark, root, tmp_path):
    frames = cap.with_frame_index(cap.read_frames(spark, root, ["ground"], strict=True))
    cap.land(frames, str(tmp_path / "frames"))
    header = cap.frame_header(spark.read.parquet(str(tmp_path / "frames")))
    plan = header.where("category = 'ground'")._jdf.queryExecution().executedPlan().toString()
    assert "joints" not in plan.split("ReadSchema")[1] and "PartitionFilters: [isnotnull(category" in plan


def test_manifest_round_trip(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.createDataFrame([("s2", "b", 5), ("s1", "a", 7)], "seg_id string, category string, n_frames long")
    tables.write_json_rows(df, path, ("category",))
    assert rows(manifests.read_manifest(spark, path).select("seg_id", "n_frames"), "seg_id") == [("s1", 7), ("s2", 5)]
    (tmp_path / "bad.jsonl").write_text('{"seg_id": "x"}\nnot json\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        manifests.read_manifest(spark, str(tmp_path / "bad.jsonl")).collect()
    soft = manifests.read_manifest(spark, str(tmp_path / "bad.jsonl"), strict=False).cache()
    assert soft.where(F.col(cap.CORRUPT).isNotNull()).count() == 1


def test_poses_from_npy(spark, tmp_path):
    (tmp_path / "ground").mkdir()
    want = np.arange(3 * 36, dtype=float).reshape(3, 36)
    np.save(tmp_path / "ground" / "s1_frames.npy", want)
    (tmp_path / "ground" / "bad_frames.npy").write_bytes(b"nope")
    got = poses.read_poses(spark, str(tmp_path)).orderBy("seg_id", "frame_idx").collect()
    assert [(r.seg_id, r.frame_idx) for r in got] == [("bad", None), ("s1", 0), ("s1", 1), ("s1", 2)]
    assert got[0].problem and got[3].q == list(want[2])


def test_copy_accepted_reuses_and_refuses(spark, tmp_path):
    path = str(tmp_path / "out")
    frames = spark.createDataFrame(
        [(s, "c", i) for s in ("a", "b") for i in range(3)], "seg_id string, category string, frame_idx long"
    )
    accepted = spark.createDataFrame([("a", 3), ("b", 3)], "seg_id string, n_frames long")
    tables.copy_accepted(frames, accepted.where("seg_id = 'a'"), path)
    tables.copy_accepted(frames, accepted, path)
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(ValueError, match="differ"):
        tables.copy_accepted(frames, accepted.withColumn("n_frames", F.lit(4)), path)


def test_reports(spark):
    df = spark.createDataFrame([(2.5, "a"), (7.0, "a"), (40.0, "b")], "d double, category string")
    bins = reports.collected(stats.histogram(df, "d"))
    marks = reports.collected(stats.duration_percentiles(df, "d"))
    text = "\n".join(reports.duration_section("Durations", bins, marks, stats.duration_summary(df, "d").first().asDict()))
    assert "| 5-10 | 1 | 33.3% |" in text and "p50=7.00s" in text
    empty = stats.duration_summary(df.where("d < 0"), "d").first()
    assert (empty.n, empty.min, empty["median"]) == (0, 0.0, 0.0)
    assert [r["count"] for r in reports.collected(stats.histogram(df.where("d < 0"), "d"))] == [0] * 13


def test_position_matches(spark):
    config = {
        "ik_match_table1": {"pelvis": ["pelvis", 0, 10], "left_hip_yaw_link": ["thigh_l", 5, 10]},
        "ik_match_table2": {"left_hip_yaw_link": ["thigh_l", 1, 1], "left_ankle": ["LeftFootMod", 9, 1]},
    }
    got = rows(m.position_matches(spark, config).select("human", "robot", "body_part"), "human")
    assert got == [("foot_l", "left_ankle", "ankle"), ("thigh_l", "left_hip_pitch_link", "hip")]
    config["ik_match_table2"]["left_hip_yaw_link"][0] = "calf_l"
    with pytest.raises(ValueError, match="several"):
        m.position_matches(spark, config)
