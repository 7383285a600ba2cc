import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaitmill.functions.blend import blend
from gaitmill.operators import clean as c
from gaitmill.operators import versions
from gaitmill.schemas import FRAME
from tests.conftest import rows

TRACE = [
    (0.000, 0, "keep"), (0.017, 5, "keep"), (0.018, 5, "drop_stuck"), (0.035, 10, "keep"),
    (0.052, 34, "drop_glitch"), (0.069, 20, "keep"), (0.149, 40, "gap"), (0.166, 500, "split"),
    (0.183, 505, "keep"), (0.483, 510, "split"), (0.500, 515, "keep"), (0.490, 520, "drop_stuck"),
]
AT = c.FrameColumns()
RULE = c.CleanRule(min_frames=1, min_duration=0.0)


def frame(category, rec, i, t, x, dt=0.4):
    joints = [{"n": "pelvis", "wp": [float(i), 0.0, 0.0]}]
    return {
        "category": category, "recording_id": rec, "frame_idx": i, "t": t, "dt": dt, "f": 100 + i,
        "px": float(x), "py": 0.0, "pz": 0.0,
        "cmd": {"move": [0.0, float(i)], "jump": i == 5},
        "root": {"p": [float(x), 0.0, 0.0], "q": [0.0, 0.0, math.sin(i / 20), math.cos(i / 20)]},
        "joints": joints,
    }


SCHEMA = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("recording_id", T.StringType()),
        T.StructField("frame_idx", T.LongType()),
        *[T.StructField(n, T.DoubleType()) for n in ("px", "py", "pz")],
        *FRAME.fields,
    ]
)


@pytest.fixture(scope="module")
def frames(spark):
    data = [frame("a", "r", i, t, x) for i, (t, x, _) in enumerate(TRACE)]
    data += [frame("a", "still", i, i / 60.0, i) for i in range(5)]
    return spark.createDataFrame(data, SCHEMA).cache()


def test_labels(frames):
    labelled = c.label_frames(frames, AT, RULE).df.where("recording_id = 'r'")
    got = [r.decision for r in labelled.orderBy("frame_idx").collect()]
    assert got == [d for _, _, d in TRACE]


@pytest.mark.parametrize("max_rows", [1000, 3])
def test_segments_and_filled_frames(frames, max_rows):
    cleaned = c.clean(frames, AT, RULE, max_rows=max_rows)
    segments = rows(cleaned.segments.where("recording_id = 'r'"), "segment")
    assert [s[3] for s in segments] == [9, 2, 2]
    # a split head brings its logged dt (0.4) into the duration
    assert [round(s[4], 6) for s in segments] == [0.149, 0.417, 0.417]
    assert [s[6] for s in segments] == [0, 1, 2]

    out = c.cleaned_frames(frames, cleaned, AT)
    first = out.where("seg_id = 'r_c0'").orderBy("frame_idx").collect()
    assert [r.frame_idx for r in first] == list(range(9))
    assert [r.filled for r in first] == [False] * 4 + [True] * 4 + [False]
    step = (0.149 - 0.069) / 5
    assert [round(r.dt, 6) for r in first[4:]] == [round(step, 6)] * 5
    assert [r.f for r in first] == list(range(9))
    # between raw frames 5 and 6: lists lerp, booleans snap, joints are held
    assert first[4].cmd.move[1] == pytest.approx(5.2)
    assert [r.cmd.jump for r in first[4:8]] == [True, True, False, False]
    assert {r.joints[0].wp[0] for r in first[4:8]} == {5.0}
    angle = math.asin(first[4].root.q[2])
    assert angle == pytest.approx(5 / 20 + 0.2 / 20)
    blended = c.cleaned_frames(frames, cleaned, AT, records="blend")
    moved = blended.where("seg_id = 'r_c0' and frame_idx = 4").first()
    assert moved.joints[0].wp[0] == pytest.approx(5.2)

    head = out.where("seg_id = 'r_c1' and frame_idx = 0").first()
    assert (head.dt, head.f) == (0.4, 107)


def test_unchanged_recording_passes_without_filter(frames):
    strict = c.CleanRule(min_frames=60, min_duration=1.0)
    cleaned = c.clean(frames, AT, strict)
    manifest = {r.recording_id: r for r in cleaned.manifest.collect()}
    assert not manifest["still"].changed and manifest["still"].segs_kept == 1
    assert manifest["r"].segs_kept == 0 and manifest["r"].n_out_total == 0
    out = c.cleaned_frames(frames, cleaned, AT).collect()
    assert {r.seg_id for r in out} == {"still"} and {r.dt for r in out} == {0.4}
    stats = cleaned.stats.first()
    assert (stats.files, stats.files_unchanged, stats.frames_out, stats.segs_dropped) == (2, 1, 5, 3)


def test_versions_round_trip(frames):
    cleaned = c.clean(frames, AT, RULE)
    keys = ["category", "recording_id"]
    raw = frames.select(*keys, F.col("recording_id").alias("seg_id"), "t")
    out = c.cleaned_frames(frames, cleaned, AT, values=["px"]).select(*keys, "seg_id", "t")
    changed = cleaned.manifest.where("changed").select(*keys)
    out = out.join(changed, keys, "left_semi")
    applied = versions.apply_cleaning(raw, cleaned.manifest, out, keys)
    names = {r.seg_id for r in applied.select("seg_id").distinct().collect()}
    assert names == {"still", "r_c0", "r_c1", "r_c2"}
    swaps = versions.swap_manifest(cleaned.manifest, c.output_segments(cleaned, AT), keys)
    back = versions.roll_back(applied, raw, swaps, keys, "seg_id")
    assert rows(back, "seg_id", "t") == rows(raw, "seg_id", "t")


def test_blend_edge_cases(spark):
    q = T.ArrayType(T.DoubleType())
    df = spark.createDataFrame(
        [([0.0, 0.0, 0.0, 1.0], [0.0, 0.0, 0.0, -1.0], 1, 5, None, 2.0)],
        "a array<double>, b array<double>, i int, j int, x double, y double",
    )
    half, low = F.lit(0.5), F.lit(0.4)
    row = df.select(
        blend(F.col("a"), F.col("b"), q, half, name="q").alias("same"),
        blend(F.col("i"), F.col("j"), T.IntegerType(), low).alias("snap"),
        blend(F.col("i"), F.col("j"), T.IntegerType(), half).alias("late"),
        blend(F.col("x"), F.col("y"), T.DoubleType(), half).alias("only_b"),
    ).first()
    assert row.same == [0.0, 0.0, 0.0, 1.0]
    assert (row.snap, row.late, row.only_b) == (1, 5, 2.0)


def test_half_even_rounding_of_fill_count(spark):
    rule = c.CleanRule(target_dt=0.032, small_gap_dt=0.05, big_gap_dt=1.0, jump_speed=1e9)
    data = [frame("a", "r", i, t, 0) for i, t in enumerate((0.0, 0.08, 0.16))]
    df = spark.createDataFrame(data, SCHEMA)
    placed = c.lay_out(c.label_frames(df, AT, rule), AT, rule).df.orderBy("frame_idx").collect()
    assert [r.slots for r in placed] == [1, 2, 2]  # 2.5 rounds to 2


def test_slerp_takes_the_short_way(spark):
    a, b = [0.0, 0.0, 0.0, 1.0], [0.0, 0.0, -math.sin(0.6), -math.cos(0.6)]
    df = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    kind = T.ArrayType(T.DoubleType())
    got = df.select(blend(F.col("a"), F.col("b"), kind, F.lit(0.25), name="q")).first()[0]
    assert got == pytest.approx([0.0, 0.0, math.sin(0.15), math.cos(0.15)])
