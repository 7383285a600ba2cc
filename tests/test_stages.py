"""From recordings on disk to a training set, through every stage."""

import json
import math
import os

import pytest
from pyspark.sql import functions as F

from gaitmill.functions.rotation import Rigid
from gaitmill.operators.balance import BalanceRule
from gaitmill.operators.clean import CleanRule
from gaitmill.operators.wash import WashRule
from gaitmill.plans import stages


def frame(i, t, x, move, crouch=False):
    return {
        "t": t, "dt": 1 / 60, "f": i, "cmd": {"move": move, "crouch": crouch},
        "root": {"p": [x, 0.0, 0.0], "q": [0.0, 0.0, 0.0, 1.0], "mesh": {"s": [0.77, 0.77, 0.77]}},
        "joints": [{"n": "pelvis", "pi": -1, "wp": [x, 0.0, 90.0]}],
    }


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    folder = base / "ground"
    folder.mkdir()
    for rec in ("walk", "back", "stand"):
        frames = []
        for i in range(40):
            move = [0.0, -1.0 if rec == "back" and i == 30 else 1.0]
            t = i / 60 + (0.001 if i == 20 else 0.0) + (1.0 if i >= 25 else 0.0)
            frames.append(frame(i, t, 2.0 * i if rec != "stand" else 0.0, move, crouch=i == 10))
        (folder / f"{rec}_frames.jsonl").write_text("".join(json.dumps(f) + "\n" for f in frames))
        (folder / f"{rec}_meta.json").write_text(json.dumps({"sample_rate_hz": 60, "terrain_ref": ""}))
    (folder / "torn_frames.jsonl").write_text('{"t": 0.0\n')
    return str(base)


def test_all_stages(spark, raw, tmp_path):
    out = {n: str(tmp_path / n) for n in ("raw", "s1", "s2", "s3", "fw", "set")}
    stages.ingest(spark, raw, out["raw"])
    assert [r.seg_id for r in spark.read.parquet(out["raw"] + "/rejects").collect()] == ["torn"]

    stages.clean_stage(spark, out["raw"], out["s1"], CleanRule(min_frames=5, min_duration=0.05))
    s1 = spark.read.parquet(out["s1"] + "/frames")
    assert {r.seg_id for r in s1.select("seg_id").distinct().collect()} == {
        f"{n}_c{j}" for n in ("walk", "back", "stand") for j in (0, 1)
    }
    meta = spark.read.parquet(out["s1"] + "/meta").first()
    assert meta.cleaned and meta.num_frames is None

    rule = WashRule(min_frames=5, min_duration=0.05)
    broken = spark.read.parquet(out["raw"] + "/rejects")
    text = stages.wash_stage(spark, out["s1"], out["s2"], rule, broken=broken)
    assert "| kept_segments | 9 |" in text and "| parse_failures | 1 |" in text
    assert spark.read.parquet(out["s2"] + "/rejects").where("seg_id = 'torn'").count() == 1
    record = spark.read.parquet(out["s2"] + "/meta").first()
    assert record.wash.eps_mag == rule.eps_mag and record.i1 > record.i0
    s2 = spark.read.parquet(out["s2"] + "/frames")
    manifest = spark.read.parquet(out["s2"] + "/manifest")
    assert s2.groupBy("seg_id").count().join(manifest, "seg_id").where("count <> n_frames").count() == 0

    x = F.element_at("root.p", 1) * 0.01
    pose = F.concat(
        F.array(x, F.lit(0.0), F.lit(0.9), F.lit(1.0)), F.array_repeat(F.lit(0.0), 32)
    )
    poses = s2.select("seg_id", "category", "frame_idx", pose.alias("q"))
    summary = stages.qa_stage(spark, out["s2"], poses, out["s3"], rule).first()
    assert (summary.segments, summary.failures, summary.status) == (9, 0, "ok")
    assert spark.read.parquet(out["s3"] + "/rejects").where("seg_id = 'torn'").count() == 1
    assert {r.data_scale for r in spark.read.parquet(out["s3"] + "/manifest").collect()} == {1.0}

    text = stages.forward_stage(spark, out["s2"], out["s3"], out["fw"])
    assert "| backward_motions | 1 |" in text
    kept = spark.read.parquet(out["fw"] + "/manifest")
    assert kept.count() == 8
    assert spark.read.parquet(out["fw"] + "/solved_rejects").count() == 1
    assert spark.read.parquet(out["fw"] + "/set_differences").count() == 0
    stamped = spark.read.parquet(out["fw"] + "/meta")
    assert stamped.count() == 8 and stamped.first().backward_motion_filter.eps_back == 0.2

    balance = BalanceRule(min_duration_s=0.1, speed_window_s=0.05, max_excursion_m=0.05, max_p95_speed=0.5)
    refs = kept.select("seg_id", F.lit("").alias("terrain_ref"))
    text = stages.balance_stage(spark, kept, refs, poses, out["set"], balance)
    assert "## Per category" in text
    stats = spark.read.parquet(out["set"] + "/stats").where("scope = 'terrain'")
    assert [r.name for r in stats.collect()] == ["__no_terrain__/ground"]
    final = spark.read.parquet(out["set"] + "/decisions")
    n = {r.decision: r["count"] for r in final.groupBy("decision").count().collect()}
    assert sum(n.values()) == 8 and n["keep"] >= 4


def test_export_and_report(spark, raw, tmp_path):
    out = {n: str(tmp_path / n) for n in ("raw", "s1", "s2", "ex")}
    stages.ingest(spark, raw, out["raw"])
    stages.clean_stage(spark, out["raw"], out["s1"], CleanRule(min_frames=5, min_duration=0.05))
    stages.wash_stage(spark, out["s1"], out["s2"], WashRule(min_frames=5, min_duration=0.05))
    align = Rigid.from_wxyz((1.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0))
    stages.export_stage(spark, out["s2"], out["ex"], align, factor=0.5, offset=(0.0, 0.0, 1.0))
    frames = spark.read.parquet(out["s2"] + "/frames")
    sent = spark.read.parquet(out["ex"] + "/commands")
    assert sent.count() == frames.count() and sent.where("move_forward = 1").count() > 0
    joints = spark.read.parquet(out["ex"] + "/skeleton").join(frames.select("seg_id", "frame_idx", "root"), ["seg_id", "frame_idx"])
    assert joints.count() == frames.count()
    assert joints.where("abs(z - 1.45) > 1e-9 OR abs(y - root.p[0] * 0.005) > 1e-9").count() == 0
    text = stages.pipeline_report(spark, [("Stage 2", out["s2"]), ("Again", out["s2"])], str(tmp_path / "report"))
    assert "## Stage 2" in text and "## Again: change" in text and "(+0.0%)" in text


def test_balance_refuses_what_it_cannot_judge(spark, tmp_path):
    good = [0.0, 0.0, 0.9, 1.0] + [0.0] * 32
    manifest = spark.createDataFrame(
        [("a", "ground", "r", 3, 4.0, 60.0)],
        "seg_id string, category string, recording_id string, n_frames long, duration_s double, fps_src double",
    )
    meta = spark.createDataFrame([("a", "")], "seg_id string, terrain_ref string")
    cases = {
        "missing_qpos": [],
        "frames_differ": [(0, good), (2, good)],
        "wrong_width": [(0, good), (1, good[:-1]), (2, good)],
        "not_finite": [(0, good), (1, [math.nan, *good[1:]]), (2, good)],
        "zero_quaternion": [(0, good), (1, [0.0] * 36), (2, good)],
    }
    for problem, rows in cases.items():
        poses = spark.createDataFrame([("a", i, q) for i, q in rows], "seg_id string, frame_idx long, q array<double>")
        with pytest.raises(ValueError, match=problem):
            stages.balance_stage(spark, manifest, meta, poses, str(tmp_path / problem))
    poses = spark.createDataFrame([("a", i, good) for i in range(3)], "seg_id string, frame_idx long, q array<double>")
    with pytest.raises(ValueError, match="duration_differs"):
        longer = manifest.withColumn("duration_s", F.lit(5.0))
        stages.balance_stage(spark, manifest, meta, poses, str(tmp_path / "pair"), stage2=longer)
    stages.balance_stage(spark, manifest, meta, poses, str(tmp_path / "good"), stage2=manifest)
    assert spark.read.parquet(str(tmp_path / "good/decisions")).count() == 1


def test_nothing_settled_stays(spark, raw, tmp_path):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    stages.ingest(spark, raw, str(tmp_path / "raw"))
    assert set(os.listdir(folder)) <= before


def test_terrain_stage(spark, tmp_path):
    square = {
        "asset_path": "/Game/Box", "vertices": [[0, 0, 20], [100, 0, 20], [100, 100, 20], [0, 100, 20]],
        "normals": [], "indices": [0, 1, 2, 0, 2, 3],
    }
    turn = [0.0, 0.0, math.sin(math.pi / 4), math.cos(math.pi / 4)]
    instance = {"mesh": 0, "name": "b", "location": [50, 0, 0], "rotation_quat_xyzw": turn, "scale": [1, 1, 1]}
    doc = {"terrain_hash": "AB", "meshes": [square], "instances": [instance]}
    (tmp_path / "terrain_AB.json").write_text(json.dumps(doc, indent=1))
    align = Rigid.from_wxyz((1.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0))
    out = str(tmp_path / "out")
    stages.terrain_stage(spark, str(tmp_path), align, out, cell=0.1)
    assert spark.read.parquet(out + "/triangles").count() == 4
    field = spark.read.parquet(out + "/height_field")
    heights = {round(r.z, 6): r["count"] for r in field.groupBy("z").count().collect()}
    assert set(heights) == {0.0, 0.2} and heights[0.2] == 100
