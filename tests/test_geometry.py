import math
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaitmill.functions import rotation as rot
from gaitmill.functions.rotation import Quat, Rigid, Vec
from gaitmill.operators import calibrate as cal
from gaitmill.operators import shared
from gaitmill.operators import smoothing as sm
from gaitmill.operators import terrain as te


def hann(x, window):
    n = len(x)
    w = window + 1 if window % 2 == 0 else window
    if w > n:
        w = n if n % 2 else n - 1
    if w < 3 or n < 3:
        return x
    kernel = np.hanning(w + 2)[1:-1]
    kernel /= kernel.sum()
    return np.convolve(np.pad(x, w // 2, mode="reflect"), kernel, mode="valid")


@pytest.mark.parametrize("window", [9, 4, 2, 1])
def test_smoothing_equals_convolution(spark, window):
    rng = np.random.default_rng(1)
    series = {n: rng.normal(size=n) for n in (1, 2, 3, 4, 7, 9, 40)}
    data = [(n, i, float(v)) for n, x in series.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(data, "k long, i long, v double")
    sizes = df.groupBy("k").agg(F.count(F.lit(1)).alias("n_frames"))
    out = sm.smoothed(df, sizes, ["k"], "i", ["v"], window, page_rows=11)
    got = {}
    for r in out.orderBy("k", "i").collect():
        got.setdefault(r.k, []).append(r.v_smooth)
    for n, x in series.items():
        np.testing.assert_allclose(got[n], hann(x, window), atol=1e-12)


def test_rotations(spark):
    q = rot.unit(rot.constant((1.0, 2.0, -0.5, 0.25), Quat))
    v = rot.constant((0.3, -1.0, 2.0))
    once = rot.rotate(q, v)
    by_matrix = rot.transform(rot.matrix(q), v)
    back = rot.rotate(rot.conjugate(q), once)
    row = spark.range(1).select(*once, *by_matrix, *back, rot.norm(q)).first()
    np.testing.assert_allclose(row[:3], row[3:6])
    np.testing.assert_allclose(row[6:9], (0.3, -1.0, 2.0))
    assert row[9] == pytest.approx(1.0)
    # swapping axes of a rotation: M R M
    m = np.array([[0, 1, 0], [1, 0, 0], [0, 0, 1]], dtype=float)
    r = np.array(spark.range(1).select(*[c for v in rot.matrix(q) for c in v]).first()).reshape(3, 3)
    s = spark.range(1).select(*[c for v in rot.matrix(rot.swap_rotation(q)) for c in v]).first()
    np.testing.assert_allclose(np.array(s).reshape(3, 3), m @ r @ m, atol=1e-12)


def test_zero_quaternion_is_null(spark):
    q = rot.unit(rot.constant((0.0, 0.0, 0.0, 0.0), Quat))
    assert spark.range(1).select(*q).first() == (None, None, None, None)


def test_fit_recovers_a_rigid_motion(spark):
    rng = np.random.default_rng(5)
    ref = rng.normal(size=(8, 3))
    align = Rigid.from_wxyz((0.9, 0.1, -0.3, 0.2), (1.0, -2.0, 0.5))
    r, t = np.array(align.rotation), np.array(align.translation)
    moved = (ref - t) @ r  # so that r @ moved + t = ref
    mirrored = moved * [1, 1, -1]
    data = [(f, b, *map(float, p)) for f, pose in ((0, moved), (1, mirrored)) for b, p in enumerate(pose)]
    points = spark.createDataFrame(data, "frame long, bone long, x double, y double, z double")
    reference = spark.createDataFrame([(b, *map(float, p)) for b, p in enumerate(ref)], "bone long, x double, y double, z double")
    first, second = cal.fit_frames(points, reference, ["frame"]).orderBy("frame").collect()
    np.testing.assert_allclose(np.array(first.rotation).reshape(3, 3), r, atol=1e-9)
    np.testing.assert_allclose(first.translation, t, atol=1e-9)
    assert first.rms < 1e-6 < second.rms
    assert np.linalg.det(np.array(second.rotation).reshape(3, 3)) == pytest.approx(1.0)
    assert [r.frame for r in cal.best_frames(points, reference, "frame", top_k=1).collect()] == [0]
    with pytest.raises(ValueError, match="anchor"):
        cal.fit_frames(points, reference.where("bone < 2"), ["frame"])


def terrain_inputs(spark, normals):
    vertices = [[0.0, 0.0, 0.0], [100.0, 0.0, 0.0], [100.0, 100.0, 0.0], [0.0, 100.0, 0.0]]
    meshes = spark.createDataFrame(
        [("T", 0, "/Game/x", vertices, normals, [0, 1, 2, 0, 2, 3]), ("T", 1, "/Engine/y", vertices, normals, [0, 1, 2])],
        "terrain_hash string, mesh_idx int, asset_path string, vertices array<array<double>>, "
        "normals array<array<double>>, indices array<long>",
    )
    turn = [0.0, 0.0, math.sin(0.2), math.cos(0.2)]
    instances = spark.createDataFrame(
        [("T", i, mesh, [10.0 * i, 5.0, 2.0], turn, [1.0, 2.0, 1.0]) for i, mesh in enumerate((0, 1, 0, 7))],
        "terrain_hash string, instance_idx int, mesh_idx int, location array<double>, "
        "rotation_quat_xyzw array<double>, scale array<double>",
    )
    return te.placed_meshes(instances, meshes)


@pytest.mark.parametrize("normals", [None, [[0.0, 0.0, 1.0]] * 4])
def test_terrain_faces_point_up(spark, normals):
    placed = terrain_inputs(spark, normals)
    assert sorted(r.instance_idx for r in placed.instances.collect()) == [0, 2]
    align = Rigid.from_wxyz((1.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0))
    geometry = te.world_geometry(placed, align)
    assert {r.instance_idx: r.vertex_offset for r in geometry.instances.collect()} == {0: 0, 2: 4}
    p = [Vec(*[F.col(f"{c}{k}") for c in "xyz"]) for k in range(3)]
    up = rot.cross(rot.subtract(p[1], p[0]), rot.subtract(p[2], p[0])).z
    faces = te.triangle_table(geometry).select("a", "b", "c", up.alias("up")).collect()
    assert len(faces) == 4 and all(f.up > 0 for f in faces)
    assert {v for f in faces for v in (f.a, f.b, f.c)} == set(range(8))


def test_pages_and_copies_of_a_hot_mesh_change_nothing(spark, monkeypatch):
    grid = [[float(i % 5), float(i // 5), float(i * i % 7)] for i in range(25)]
    indices = [v for i in range(20) if i % 5 < 4 for v in (i, i + 1, i + 5)] + [3]
    meshes = spark.createDataFrame(
        [("T", 0, None, grid, None, indices), ("T", 1, None, grid[:4], grid[:4], [0, 1, 2, 1, 2, 3])],
        "terrain_hash string, mesh_idx int, asset_path string, vertices array<array<double>>, "
        "normals array<array<double>>, indices array<long>",
    )
    instances = spark.range(90).selectExpr(
        "'T' AS terrain_hash", "id AS instance_idx", "if(id % 30 = 0, 1, 0) AS mesh_idx",
        "array(id * 1.0D, 0.0D, 2.0D) AS location", "array(0.0D, 0.0D, 0.0D, 1.0D) AS rotation_quat_xyzw",
        "array(1.0D, 1.0D, if(id % 4 = 0, -1.0D, 1.0D)) AS scale",
    )
    found = []
    for page, share in ((1024, 4096), (4, 8)):
        monkeypatch.setattr(te, "PAGE", page)
        monkeypatch.setattr(te, "SHARE", share)
        world = te.world_geometry(te.placed_meshes(instances, meshes), None)
        vertices = sorted(map(tuple, te.vertex_table(world).collect()))
        triangles = sorted(map(tuple, te.triangle_table(world).collect()))
        counts = te.triangle_counts(world).first()
        assert counts.n_triangles == len(triangles) == 87 * 16 + 3 * 2
        assert [v[2] for v in vertices] == list(range(87 * 25 + 3 * 4))
        found.append((vertices, triangles))
    assert found[0] == found[1]
    for hidden, i, vid, x, y, z in found[0][0][:200]:
        local = vid - min(v[2] for v in found[0][0] if v[1] == i)
        flip = -1.0 if i % 4 == 0 else 1.0
        assert (x, y, z) == (grid[local][0] + i, grid[local][1], grid[local][2] * flip + 2.0)


def test_corridor_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    pts = np.vstack([rng.uniform(0, 100, (80, 2)), np.tile([[50.0, 50.0]], (40, 1)) + rng.normal(0, 0.2, (40, 2))])
    low = rng.uniform(0, 100, (200, 2))
    high = low + rng.uniform(0, 30, (200, 2))
    points = spark.createDataFrame([("t", *map(float, p)) for p in pts], "t string, x double, y double")
    boxes = spark.createDataFrame(
        [("t", i, *map(float, (*a, *b))) for i, (a, b) in enumerate(zip(low, high))],
        "t string, i long, min_x double, min_y double, max_x double, max_y double",
    )
    reach = 4.0
    d = np.maximum(np.maximum(low[:, None] - pts[None], pts[None] - high[:, None]), 0.0)
    want = set(np.where(((d**2).sum(2) <= reach * reach).any(1))[0])
    got = te.near_trajectory(boxes, points, ["t"], ["i"], reach=reach)
    assert {r.i for r in got.collect()} == want and 0 < len(want) < 200


def broadcast_parts(df):
    """The plan below each broadcast."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [re.match(r"[ :+\-|]*", line).end() for line in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            stop = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            yield "\n".join(lines[i:stop])


def test_cells_of_boxes_are_never_broadcast(spark):
    sides = ["0D AS min_x", "0D AS min_y", "50D AS max_x", "50D AS max_y"]
    boxes = spark.range(1).selectExpr("'A' AS t", "id + 1 AS i", *sides)
    points = spark.range(20_000).selectExpr("'A' AS t", "id % 7 AS s", "cast(id % 300 AS double) AS x", "cast(id % 11 AS double) AS y")
    got = te.near_trajectory(boxes, points, ["t"], ["i"], reach=0.7)
    assert not [part for part in broadcast_parts(got) if "Generate explode" in part]
    assert [r["i"] for r in got.collect()] == [1]


def test_only_interacted_pairs_are_judged(spark):
    boxes = spark.createDataFrame(
        [("A", 1, 0.0, 0.0, 1.0, 1.0), ("A", 2, 9.0, 9.0, 9.5, 9.5), ("B", 3, 0.0, 0.0, 1.0, 1.0), ("A", 4, 0.0, 0.0, 1.0, 1.0)],
        "terrain_hash string, instance_idx int, min_x double, min_y double, max_x double, max_y double",
    )
    points = spark.createDataFrame(
        [(7, "A", 1.5, 0.5), (7, "A", 1.4, 0.5), (8, "A", 20.0, 0.0), (9, "B", 0.5, 0.5), (9, "A", 9.0, 9.0)],
        "seg_id int, terrain_hash string, x double, y double",
    )
    said = [(7, "A", 1), (7, "A", 1), (7, "A", 2), (7, "A", 99), (8, "A", 1), (9, "B", 3), (9, "A", 3), (9, "A", 2), (None, "A", 1)]
    told = spark.createDataFrame(said, "seg_id int, terrain_hash string, instance_idx int")
    near = te.near_interacted(boxes, points, told, ["seg_id"], reach=0.7)
    assert sorted((r["seg_id"], r["instance_idx"]) for r in near.collect()) == [(7, 1), (9, 2), (9, 3)]
    agreed = te.interaction_agreement(told, near, ["seg_id"])
    assert agreed.where("is_near").count() == 5 and agreed.count() == len(said)


def brute_crop(faces, points, motions, margin):
    out = set()
    for motion, terrain in motions:
        own = [f for f in faces if f[0] == terrain]
        at = [p[1:] for p in points if p[0] == motion]
        near = []
        if at:
            low, high = np.min(at, 0) - margin, np.max(at, 0) + margin
            centre = lambda f: [sum(f[6 + c : 12 : 2]) / 3.0 for c in (0, 1)]
            near = [f for f in own if (low <= centre(f)).all() and (centre(f) <= high).all()]
        kept = near or own
        new = {v: i for i, v in enumerate(sorted({v for f in kept for v in f[3:6]}))}
        out |= {(motion, f[1], f[2], *[new[v] for v in f[3:6]]) for f in kept}
    return out


@pytest.mark.parametrize("page, motions, max_rows", [(1024, 256, 100_000), (8, 2, 100_000), (8, 2, 10)])
def test_crop_with_shared_vertices_equals_brute_force(spark, monkeypatch, page, motions, max_rows):
    """Vertices are shared between faces, also far apart, and pages are cut through them."""
    monkeypatch.setattr(te, "PAGE", page)
    monkeypatch.setattr(te, "MOTIONS", motions)
    rng = np.random.default_rng(4)
    faces = []
    for terrain in "AB":
        spots = rng.uniform(0, 40, (60, 2))
        for f in range(90):
            ids = [f % 58, f % 58 + 1, f % 58 + 2] if f % 9 else rng.choice(60, 3, replace=False).tolist()
            faces.append((terrain, f // 10, f % 10, *[7 * i + 3 for i in ids], *map(float, spots[ids].ravel())))
    points = [(m, float(x), float(y)) for m in range(7) for x, y in rng.uniform(0, 40, 2) + rng.normal(0, 2, (5, 2))]
    points.append((7, 900.0, 900.0))
    walks = [(m, "AB"[m % 2]) for m in range(9)] + [(9, "C")]
    rows = spark.createDataFrame(faces, "terrain_hash string, instance_idx int, face_idx int, a long, b long, c long, x0 double, y0 double, x1 double, y1 double, x2 double, y2 double")
    got = te.crop_faces(
        rows,
        spark.createDataFrame(points, "seg_id int, x double, y double"),
        spark.createDataFrame(walks, "seg_id int, terrain_hash string"),
        max_rows=max_rows,
    )
    got = list(map(tuple, got.collect()))
    assert len(got) == len(set(got)) and set(got) == brute_crop(faces, points, walks, te.CROP_MARGIN)


def test_crop_never_moves_its_result(spark):
    """What is written on the way grows with motions and pages, not with their product of faces."""
    faces = spark.range(600).selectExpr(
        "'A' AS terrain_hash", "id AS instance_idx", "0 AS face_idx", "3 * id AS a", "3 * id + 1 AS b", "3 * id + 2 AS c",
        *[f"cast(id % 9 AS double) AS {n}{k}" for n in "xyz" for k in range(3)],
    )
    points = spark.range(400).selectExpr("id AS seg_id", "4D AS x", "4D AS y", "'A' AS terrain_hash")
    folder = Path(shared.shared_folder(spark).removeprefix("file:"))
    old = set(folder.glob("settled-*"))
    got = te.crop_faces(faces, points, points.select("seg_id", "terrain_hash"), margin=9.0)
    new = set(folder.glob("settled-*")) - old
    assert got.count() == 400 * 600
    assert sum(spark.read.parquet(str(p)).count() for p in new) < 20_000


def test_crop_broadcasts_neither_motions_nor_faces(spark, monkeypatch):
    """Files of settled tables say little about their rows; only terrains and pages are small."""
    planned = []
    monkeypatch.setattr(te, "settle", lambda df: planned.append(df) or shared.settle(df))
    faces = spark.range(600).selectExpr(
        "'A' AS terrain_hash", "id AS instance_idx", "0 AS face_idx", "3 * id AS a", "3 * id + 1 AS b", "3 * id + 2 AS c",
        *[f"cast(id % 9 AS double) AS {n}{k}" for n in "xyz" for k in range(3)],
    )
    points = spark.range(40).selectExpr("id AS seg_id", "4D AS x", "0D AS y", "'A' AS terrain_hash")
    motions = spark.range(42).selectExpr("id AS seg_id", "'A' AS terrain_hash")
    got = te.crop_faces(faces, points, motions)
    sent = [part for df in [*planned, got] for part in broadcast_parts(df)]
    assert planned and not [part for part in sent if re.search(r"\b(_key|seg_id|_vertex|_place|instance_idx)\b", part)]
    near = sum(1 <= i % 9 <= 3 for i in range(600))
    assert got.count() == 40 * near + 2 * 600
