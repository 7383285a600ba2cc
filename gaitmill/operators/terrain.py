"""Terrain: placed meshes, height fields, crops and trajectory joins."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaitmill.functions import rotation as rot
from gaitmill.functions.rotation import Rigid, Vec
from gaitmill.functions.text import present
from gaitmill.operators.shared import must_be_empty, same_key_join, settle
from gaitmill.operators.track import MAX_ROWS, Track

# Asset names with a meaning, sizes in metres (corridor in cm).
ENGINE_PREFIX = "/Engine/"
GROUND_ASSET = "Synthetic/GroundPlane"
GROUND_MARGIN = 5.0
CELL_SIZE = 0.02
CROP_MARGIN = 3.0
CORRIDOR_CM = 150.0
INSIDE_EPS = 1e-6
FLAT_EPS = 1e-12
SCALE_EPS = 1e-6


#: Vertices or faces of a mesh that meet its instances under one key, and instances that
#: share one copy of them.
PAGE = 1024
SHARE = 4096
#: Motions that meet a page of faces in one task when trajectories crop them.
MOTIONS = 256
MESH = ["terrain_hash", "mesh_idx"]


class World(NamedTuple):
    """Narrow rows of placed instances, and the meshes they use, one row each."""

    instances: DataFrame
    meshes: DataFrame


def placed_meshes(instances: DataFrame, meshes: DataFrame, *, skip_engine: bool = True) -> World:
    """Instances with the sizes of their mesh; wrong indices, engine assets and empty
    geometry drop out of the inner join. Arrays stay with the meshes."""
    usable = meshes.where((F.size("vertices") > 0) & (F.size("indices") >= 3))
    if skip_engine:
        asset = F.coalesce("asset_path", F.lit(""))
        usable = usable.where(~asset.startswith(ENGINE_PREFIX))
    uses = instances.groupBy(*MESH).agg(F.ceil(F.count(F.lit(1)) / SHARE).alias("_copies"))
    used = usable.join(uses, MESH)
    sizes = used.select(
        *MESH,
        "_copies",
        F.size("vertices").cast("long").alias("n_vertices"),
        F.floor(F.size("indices") / 3).alias("n_faces"),
    )
    return World(instances.join(sizes, MESH), used)


def _with_rows(instances: DataFrame, rows: DataFrame, count: str, index: str) -> DataFrame:
    """Every instance with the ``rows`` of its mesh, numbered by ``index``.

    A large mesh is many pages and a mesh with many instances is copied for every
    ``SHARE`` of them, so no key has more than ``PAGE`` rows and about ``SHARE`` instances.
    """
    pages = F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / PAGE))
    copies = F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)
    left = instances.withColumns(
        {"_page": F.explode(pages), "_copy": F.pmod(F.xxhash64("instance_idx"), F.col("_copies"))}
    ).drop("_copies")
    right = rows.withColumns(
        {"_page": F.floor(F.col(index) / PAGE), "_copy": F.explode(copies)}
    ).drop("_copies")
    return left.join(right, [*MESH, "_page", "_copy"])


MAP = [f"map_{i}{n}" for i in range(3) for n in "xyzt"]


def world_geometry(
    world: World,
    align: Rigid | None,
    *,
    ground_cm: float = 0.0,
    data_scale: float = 1.0,
    max_rows: int = MAX_ROWS,
) -> World:
    """Add to each placed instance its affine map and its ``vertex_offset``.

    The map stretches, turns and moves, lowers to the ground, scales, changes
    axes and aligns: twelve numbers per instance (rows ``map_0 .. map_2``), so
    that the many vertices and faces only multiply and add. ``outward`` is false
    where the map mirrors a mesh. Vertices are numbered through per terrain.
    """
    placed = world.instances
    q = rot.unit(rot.quat_xyzw(F.col("rotation_quat_xyzw")))
    stretch, loc = rot.vec(F.col("scale")), rot.vec(F.col("location"))
    turned = placed.withColumns({f"_q{n}": c for n, c in zip("wxyz", q)})
    rows = rot.matrix(rot.Quat(*rot.named("_q", "wxyz")))
    rows = [rot.times(rot.scaled(row, stretch), data_scale) for row in rows]
    shift = rot.times(Vec(loc.x, loc.y, loc.z - ground_cm), data_scale)
    if align:
        rows = [rot.times(rows[i], rot.CM_TO_M) for i in (1, 0, 2)]
        shift = rot.to_robot_axes(shift)
    flat = [c for row, t in zip(rows, shift) for c in (*row, t)]
    mapped = turned.withColumns(dict(zip(MAP, flat)))
    if align:
        columns = {n: Vec(*[F.col(f"map_{i}{n}") for i in range(3)]) for n in "xyzt"}
        done = {n: align.turn(c) for n, c in columns.items()}
        done["t"] = rot.add(done["t"], rot.constant(align.translation))
        mapped = mapped.withColumns({f"map_{i}{n}": done[n][i] for i in range(3) for n in "xyzt"})
    volume = stretch.x * stretch.y * stretch.z
    outward = ~(volume > 0) if align else volume >= 0
    mapped = mapped.withColumn("outward", outward).drop(*[f"_q{n}" for n in "wxyz"])
    sizes = placed.select("terrain_hash", "instance_idx", "n_vertices")
    numbered = (
        Track.of(sizes, ["terrain_hash"], ["instance_idx"], max_rows=max_rows)
        .running(sums={"_upto": F.col("n_vertices")})
        .result()
    )
    offset = (F.col("_upto") - F.col("n_vertices")).alias("vertex_offset")
    offsets = numbered.select("terrain_hash", "instance_idx", offset)
    return World(mapped.join(offsets, ["terrain_hash", "instance_idx"]), world.meshes)


def _mapped(v: Vec, *, direction: bool = False) -> Vec:
    rows = [Vec(*[F.col(f"map_{i}{n}") for n in "xyz"]) for i in range(3)]
    out = rot.transform(rows, v)
    return out if direction else rot.add(out, Vec(*[F.col(f"map_{i}t") for i in range(3)]))


def vertex_table(world: World) -> DataFrame:
    """One row per vertex in the target frame."""
    exploded = world.meshes.select(*MESH, "_copies", F.posexplode("vertices").alias("_i", "_v"))
    rows = exploded.select(
        *MESH, "_copies", "_i", *[c.alias(f"_v{n}") for n, c in zip("xyz", rot.vec(F.col("_v")))]
    )
    placed = _with_rows(world.instances, rows, "n_vertices", "_i")
    return placed.select(
        "terrain_hash",
        "instance_idx",
        (F.col("vertex_offset") + F.col("_i")).alias("vertex_id"),
        *[c.alias(n) for n, c in zip("xyz", _mapped(Vec(*rot.named("_v"))))],
    )


def mesh_faces(meshes: DataFrame) -> DataFrame:
    """One row per face of a mesh: its vertices ``_i0 .. _i2``, their places ``_v0x ..``
    and, where every vertex has a normal, the sum of the three, ``_ux .. _uz``."""
    same = F.coalesce(F.size("normals") == F.size("vertices"), F.lit(False))

    def face(f: Column) -> Column:
        ids = [F.get("indices", 3 * f + k).cast("int") for k in range(3)]
        places = [rot.vec(F.get("vertices", i)) for i in ids]
        ups = [rot.vec(F.get("normals", i)) for i in ids]
        up = rot.add(rot.add(ups[0], ups[1]), ups[2])
        return F.struct(
            f.alias("face_idx"),
            *[i.alias(f"_i{k}") for k, i in enumerate(ids)],
            *[c.alias(f"_v{k}{n}") for k, v in enumerate(places) for n, c in zip("xyz", v)],
            *[F.when(same, c).alias(f"_u{n}") for n, c in zip("xyz", up)],
        )

    numbers = F.sequence(F.lit(0), F.floor(F.size("indices") / 3).cast("int") - 1)
    faces = F.explode(F.transform(numbers, face)).alias("_f")
    return meshes.select(*MESH, "_copies", faces).select(*MESH, "_copies", "_f.*")


def triangle_counts(world: World, by: Sequence[str] = ("terrain_hash",)) -> DataFrame:
    return world.instances.groupBy(*by).agg(F.sum("n_faces").alias("n_triangles"))


def triangle_table(world: World) -> DataFrame:
    """One row per face: global vertex ids ``a, b, c`` and the corner positions.

    A face is turned around when its geometric normal opposes the summed vertex
    normals; without normals, when the map of the instance mirrors.
    """
    faces = _with_rows(world.instances, mesh_faces(world.meshes), "n_faces", "face_idx")
    corners = {
        f"_p{k}{n}": c
        for k in range(3)
        for n, c in zip("xyz", _mapped(Vec(*rot.named(f"_v{k}"))))
    }
    upward = _mapped(Vec(*rot.named("_u")), direction=True)
    faces = faces.withColumns(corners | {f"_n{n}": c for n, c in zip("xyz", upward)})
    p = [Vec(*rot.named(f"_p{k}")) for k in range(3)]
    normal = rot.cross(rot.subtract(p[1], p[0]), rot.subtract(p[2], p[0]))
    against = rot.dot(normal, Vec(*rot.named("_n"))) < 0
    faces = faces.withColumn("_flip", F.coalesce(against, ~F.col("outward")))

    def ordered(first: str, second: str, last: str, names: Sequence[str]) -> list[Column]:
        flip = F.col("_flip")
        return [
            F.when(flip, F.col(last)).otherwise(F.col(first)).alias(names[0]),
            F.col(second).alias(names[1]),
            F.when(flip, F.col(first)).otherwise(F.col(last)).alias(names[2]),
        ]

    numbered = faces.withColumns({f"_g{k}": F.col("vertex_offset") + F.col(f"_i{k}") for k in range(3)})
    return numbered.select(
        "terrain_hash",
        "instance_idx",
        "face_idx",
        *ordered("_g0", "_g1", "_g2", "abc"),
        *[c for n in "xyz" for c in ordered(f"_p0{n}", f"_p1{n}", f"_p2{n}", [f"{n}{k}" for k in range(3)])],
    )


def bounds(
    vertices: DataFrame, by: Sequence[str] = ("terrain_hash",), counts: DataFrame | None = None
) -> DataFrame:
    """Extent and number of vertices; the ``counts`` of triangles too where given."""
    if counts is not None:
        return same_key_join(bounds(vertices, by), counts, list(by))
    return vertices.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_vertices"),
        *[f(c).alias(f"{n}_{c}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max))],
    )


def has_source_ground(meshes: DataFrame) -> DataFrame:
    found = F.coalesce(F.col("asset_path"), F.lit("")).contains(GROUND_ASSET)
    return meshes.groupBy("terrain_hash").agg(F.bool_or(found).alias("has_ground"))


def ground_quads(
    extent: DataFrame, grounded: DataFrame | None = None, *, margin: float = GROUND_MARGIN, z: float = 0.0
) -> DataFrame:
    """Two triangles at height ``z`` around every terrain that has no ground yet.
    Vertex ids continue after the terrain's own."""
    if grounded is not None:
        extent = extent.join(grounded.where("has_ground"), "terrain_hash", "left_anti")
    lo, hi = F.lit(-margin), F.lit(margin)
    x0, x1 = F.col("min_x") + lo, F.col("max_x") + hi
    y0, y1 = F.col("min_y") + lo, F.col("max_y") + hi
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    faces = F.array(
        *[
            F.struct(
                *[(F.col("n_vertices") + i).alias(n) for n, i in zip("abc", ids)],
                *[corners[i][0].alias(f"x{k}") for k, i in enumerate(ids)],
                *[corners[i][1].alias(f"y{k}") for k, i in enumerate(ids)],
                *[F.lit(float(z)).alias(f"z{k}") for k in range(3)],
            )
            for ids in ((0, 1, 2), (0, 2, 3))
        ]
    )
    quads = extent.select("terrain_hash", F.posexplode(faces).alias("face_idx", "_t"))
    return quads.select("terrain_hash", "face_idx", "_t.*")


# -- height field ------------------------------------------------------------------


def _grid(extent: DataFrame, size: float) -> DataFrame:
    """Origin and shape of the grid: the bounding box and one cell around it."""
    return extent.select(
        "terrain_hash",
        (F.col("min_x") - size).alias("gx"),
        (F.col("min_y") - size).alias("gy"),
        F.ceil((F.col("max_x") - F.col("min_x") + 2 * size) / size).cast("long").alias("cols"),
        F.ceil((F.col("max_y") - F.col("min_y") + 2 * size) / size).cast("long").alias("rows"),
    )


def height_field(
    triangles: DataFrame,
    extent: DataFrame,
    *,
    size: float = CELL_SIZE,
    fill: float = 0.0,
) -> DataFrame:
    """Highest covering triangle per cell; ``fill`` where there is none.

    Triangles become scan lines, the scan lines are spread over the cluster, and
    only then become cells, so a triangle that covers the whole terrain is many
    tasks' work. Covered cells and the empty grid meet in one grouped maximum.
    """
    grid = _grid(extent, size)
    xs, ys = [F.col(f"x{k}") for k in range(3)], [F.col(f"y{k}") for k in range(3)]

    def first(values, origin, _):
        return F.greatest(((F.least(*values) - origin) / size).cast("long"), F.lit(0))

    def last(values, origin, n):
        return F.least(((F.greatest(*values) - origin) / size).cast("long"), n - 1)

    det = (xs[1] - xs[0]) * (ys[2] - ys[0]) - (xs[2] - xs[0]) * (ys[1] - ys[0])
    spans = triangles.join(grid, "terrain_hash").where(F.abs(det) >= FLAT_EPS)
    spans = spans.select(
        "terrain_hash", "gx", "gy", *[f"{c}{k}" for c in "xyz" for k in range(3)],
        det.alias("_det"),
        first(xs, F.col("gx"), None).alias("_c0"), last(xs, F.col("gx"), F.col("cols")).alias("_c1"),
        first(ys, F.col("gy"), None).alias("_r0"), last(ys, F.col("gy"), F.col("rows")).alias("_r1"),
    )
    spans = spans.where("_c0 <= _c1 AND _r0 <= _r1")
    lines = spans.withColumn("row", F.explode(F.sequence("_r0", "_r1"))).repartition(
        "terrain_hash", "row", "x0", "x1"
    )
    cells = lines.withColumn("col", F.explode(F.sequence("_c0", "_c1")))
    dx = F.col("gx") + (F.col("col") + 0.5) * size - F.col("x0")
    dy = F.col("gy") + (F.col("row") + 0.5) * size - F.col("y0")
    u = F.try_divide(dx * (ys[2] - ys[0]) - (xs[2] - xs[0]) * dy, F.col("_det"))
    v = F.try_divide((xs[1] - xs[0]) * dy - dx * (ys[1] - ys[0]), F.col("_det"))
    z = F.col("z0") + F.col("_u") * (F.col("z1") - F.col("z0"))
    z = z + F.col("_v") * (F.col("z2") - F.col("z0"))
    inside = (F.col("_u") >= -INSIDE_EPS) & (F.col("_v") >= -INSIDE_EPS)
    inside = inside & (F.col("_u") + F.col("_v") <= 1.0 + INSIDE_EPS)
    covered = (
        cells.withColumns({"_u": u, "_v": v})
        .where(inside)
        .select("terrain_hash", "row", "col", z.alias("z"))
    )
    empty = (
        grid.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
        .repartition("terrain_hash", "row")
        .withColumn("col", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cols") - 1)))
        .select("terrain_hash", "row", "col", F.lit(None).cast("double").alias("z"))
    )
    return (
        covered.unionByName(empty)
        .groupBy("terrain_hash", "row", "col")
        .agg(F.coalesce(F.max("z"), F.lit(float(fill))).alias("z"))
    )


# -- trajectories ------------------------------------------------------------------


def crop_faces(
    triangles: DataFrame,
    points: DataFrame,
    motion_terrain: DataFrame,
    *,
    key: str = "seg_id",
    margin: float = CROP_MARGIN,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Faces whose centre lies in the box of the trajectory plus a margin, per
    motion, with the used vertices numbered anew. Where none does, and where a
    motion has no points, all stay.

    ``motion_terrain`` maps motions to their terrain. The result can be as large as
    motions times faces, so its rows are made last and never move: vertices are numbered
    densely per terrain and cut into pages, motions meet the pages that their box
    touches, and what a motion uses of a page is only counted first. The sums of those
    counts are where a motion's numbers start in each page. Faces across pages are put
    together from their pages. Settled tables of repeated values are far smaller as files
    than as rows, so what grows with motions, vertices or faces is sorted and merged where
    it is joined: a broadcast would hold all of it.
    """
    box = points.groupBy(key).agg(
        *[f(c).alias(f"_{n}_{c}") for c in "xy" for n, f in (("min", F.min), ("max", F.max))]
    )
    boxes = motion_terrain.select(F.col(key).alias("_key"), "terrain_hash").join(
        box.withColumnRenamed(key, "_key").hint("merge"), "_key", "left"
    )
    # As in comparisons of columns, NaN lies above all numbers.
    limits = {f"_low_{c}": F.col(f"_min_{c}") - margin for c in "xy"}
    limits |= {f"_high_{c}": F.nanvl(F.col(f"_max_{c}") + margin, F.lit(float("inf"))) for c in "xy"}
    boxes = settle(boxes.select("_key", "terrain_hash", *[c.cast("double").alias(n) for n, c in limits.items()]))
    faces = _dense_faces(triangles, max_rows)
    pages = _face_pages(faces)
    # Under a name of its own: motions and faces of a page are grouped side by side.
    extent = pages.groupBy("terrain_hash", F.col("_page").alias("_page")).agg(
        *[f(f"_centre_{c}").alias(f"_{n}_{c}") for c in "xy" for n, f in (("min", F.min), ("max", F.max))]
    )
    touched = F.lit(True)
    for c in "xy":
        touched = touched & (F.col(f"_min_{c}") <= F.col(f"_high_{c}")) & (F.col(f"_max_{c}") >= F.col(f"_low_{c}"))
    blocks = settle(
        boxes.groupBy("terrain_hash").agg(F.ceil(F.count(F.lit(1)) / MOTIONS).cast("long").alias("_blocks"))
    )
    visits = settle(
        boxes.join(blocks, "terrain_hash")
        .withColumn("_block", F.pmod(F.xxhash64("_key"), F.col("_blocks")))
        .join(extent.hint("merge"), "terrain_hash")
        .where(touched)
        .select("_key", "terrain_hash", "_page", "_block", *limits)
    )
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    copied = settle(pages.join(blocks, "terrain_hash").withColumn("_block", copies).drop("_blocks"))
    kind = boxes.schema["_key"].dataType.simpleString()
    by = ["terrain_hash", "_page", "_block"]

    def met(faces: DataFrame, motions: DataFrame, task, schema: str) -> DataFrame:
        return faces.groupBy(*by).cogroup(motions.groupBy(*by)).applyInArrow(task, schema)

    visit = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in visits.schema)
    counts = settle(met(copied, visits, functools.partial(_count_used, PAGE), f"{visit}, _used long"))
    placed = settle(
        Track.of(counts, ["_key", "terrain_hash"], ["_page"], max_rows=max_rows)
        .running(sums={"_upto": F.col("_used")})
        .result()
        .withColumn("_start", F.col("_upto") - F.col("_used"))
        .drop("_upto", "_used")
    )
    columns = [f"new_{n}" for n in "abc"]
    types = {t.name: t.dataType.simpleString() for t in faces.schema}
    made = ", ".join(
        [f"{key} {kind}", *[f"{n} {types[n]}" for n in ("instance_idx", "face_idx")], *[f"{c} long" for c in columns]]
    )
    out = met(copied, placed, functools.partial(_number_used, PAGE, False, key), made)
    across = pages.where("_wide").select("terrain_hash", "_page").distinct()
    if across.limit(1).count():
        # A face across pages has each number from one of them.
        parts = met(
            copied.join(across, ["terrain_hash", "_page"], "left_semi"),
            placed.join(across, ["terrain_hash", "_page"], "left_semi"),
            functools.partial(_number_used, PAGE, True, key),
            made,
        )
        whole = parts.groupBy(key, "instance_idx", "face_idx").agg(*[F.max(c).alias(c) for c in columns])
        out = out.unionByName(whole)
    used = counts.select("_key", "terrain_hash").distinct().hint("merge")
    empty = boxes.join(used, ["_key", "terrain_hash"], "left_anti").select(F.col("_key").alias(key), "terrain_hash")
    empty = settle(empty)
    if empty.limit(1).count():
        # Such motions have all faces: each in the page of its first vertex.
        every = faces.select(
            "terrain_hash", F.floor(F.col("_a") / PAGE).alias("_page"), "instance_idx", "face_idx",
            *[F.col(f"_{n}").alias(f"new_{n}") for n in "abc"],
        )
        paged = empty.join(extent.select("terrain_hash", "_page").hint("merge"), "terrain_hash")
        whole = paged.join(every.hint("merge"), ["terrain_hash", "_page"])
        out = out.unionByName(whole.drop("terrain_hash", "_page"))
    return out


def _dense_faces(triangles: DataFrame, max_rows: int) -> DataFrame:
    """Faces with their centre and, as ``_a, _b, _c``, the places of their vertices among
    those that the faces of the terrain use."""
    faces = settle(
        triangles.select(
            "terrain_hash", "instance_idx", "face_idx", "a", "b", "c",
            *[((F.col(f"{c}0") + F.col(f"{c}1") + F.col(f"{c}2")) / 3.0).alias(f"_centre_{c}") for c in "xy"],
        )
    )
    used = faces.select("terrain_hash", F.explode(F.array("a", "b", "c")).alias("_vertex")).distinct()
    places = settle(
        Track.of(used, ["terrain_hash"], ["_vertex"], max_rows=max_rows)
        .numbered("_place")
        .result()
        .select("terrain_hash", "_vertex", F.col("_place").cast("long").alias("_place"))
    )
    for n in "abc":
        renamed = places.withColumnsRenamed({"_vertex": n, "_place": f"_{n}"})
        faces = faces.join(renamed.hint("merge"), ["terrain_hash", n])
    return settle(faces.drop("a", "b", "c"))


def _face_pages(faces: DataFrame) -> DataFrame:
    """Each face in every page that one of its vertices is in, ``_wide`` if in several."""
    pages = F.array_distinct(F.array(*[F.floor(F.col(f"_{n}") / PAGE) for n in "abc"]))
    return faces.withColumn("_pages", pages).select(
        "*", (F.size("_pages") > 1).alias("_wide"), F.explode("_pages").alias("_page")
    ).drop("_pages")


def _inside(size: int, faces: pa.Table, motions: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which motions (rows) have which faces of a page; the places of the corners in the
    page, ``size`` where they are in another one; which motions use which vertices."""
    near = np.ones((motions.num_rows, faces.num_rows), bool)
    for c in "xy":
        at = faces[f"_centre_{c}"].to_numpy()
        near &= at >= motions[f"_low_{c}"].to_numpy()[:, None]
        near &= at <= motions[f"_high_{c}"].to_numpy()[:, None]
    first = faces["_page"][0].as_py() * size
    corners = np.stack([faces[f"_{n}"].to_numpy() - first for n in "abc"])
    corners = np.where((corners < 0) | (corners >= size), size, corners)
    order = np.argsort(corners.ravel(), kind="stable")
    vertices, starts = np.unique(corners.ravel()[order], return_index=True)
    used = np.zeros((motions.num_rows, size + 1), bool)
    used[:, vertices] = np.logical_or.reduceat(near[:, order % faces.num_rows], starts, axis=1)
    return near, corners, used[:, :size]


def _count_used(size: int, faces: pa.Table, motions: pa.Table) -> pa.Table:
    """The motions that use vertices of a page, and how many of them."""
    counts = np.empty(0, np.int64)
    if faces.num_rows and motions.num_rows:
        counts = _inside(size, faces, motions)[2].sum(axis=1, dtype=np.int64)
    some = np.flatnonzero(counts)
    return motions.take(pa.array(some)).append_column("_used", pa.array(counts[some]))


def _number_used(
    size: int, wide: bool, key: str, faces: pa.Table, motions: pa.Table
) -> pa.Table:
    """The faces of a page that each motion has, those across pages or the others, with
    the numbers of their corners; null for corners in another page."""
    row = face = np.empty(0, np.int64)
    numbers = [pa.array([], pa.int64())] * 3
    if faces.num_rows and motions.num_rows:
        near, corners, used = _inside(size, faces, motions)
        row, face = np.nonzero(near & (faces["_wide"].to_numpy() == wide))
        number = np.cumsum(used, axis=1, dtype=np.int64) - 1 + motions["_start"].to_numpy()[:, None]
        number = np.append(number, np.zeros((len(number), 1), np.int64), axis=1)
        numbers = [pa.array(number[row, c[face]], mask=c[face] == size) for c in corners]
    columns = [motions["_key"].take(pa.array(row)), *[faces[n].take(pa.array(face)) for n in ("instance_idx", "face_idx")]]
    return pa.Table.from_arrays([*columns, *numbers], [key, "instance_idx", "face_idx", "new_a", "new_b", "new_c"])


def near_trajectory(
    boxes: DataFrame,
    points: DataFrame,
    by: Sequence[str],
    box_id: Sequence[str],
    *,
    reach: float = CORRIDOR_CM,
    each: Sequence[str] = (),
) -> DataFrame:
    """Semi-join: boxes (``min_x, min_y, max_x, max_y``) that have a point of the
    same ``by`` within ``reach``. With ``each``, columns of the points, the result is
    (``by``, ``each``, ``box_id``) instead: which of them come near which box.

    Both sides are cut into square cells of ``reach``. Points collapse to one row
    per cell with the rectangle they span, however many share a cell. Against that
    rectangle a box is surely near, surely not, or open; only the open pairs look
    at the distinct points of their cell, and only one side of that join has more
    than one row per cell and box. Spark's estimate of the boxes' size does not know
    their cells, so they are sorted and merged: a broadcast would hold all of them.
    """
    def cell_of(value: Column) -> Column:
        return F.floor(value / reach).cast("long")

    at = points.select(*by, *each, "x", "y", cell_of(F.col("x")).alias("_cx"), cell_of(F.col("y")).alias("_cy"))
    cells = at.groupBy(*by, *each, "_cx", "_cy").agg(
        *[f(c).alias(f"_{n}_{c}") for c in "xy" for n, f in (("low", F.min), ("high", F.max))]
    )
    covers = boxes.withColumn(
        "_cx", F.explode(F.sequence(cell_of(F.col("min_x") - reach), cell_of(F.col("max_x") + reach)))
    ).withColumn(
        "_cy", F.explode(F.sequence(cell_of(F.col("min_y") - reach), cell_of(F.col("max_y") + reach)))
    )
    pairs = covers.hint("merge").join(cells, [*by, "_cx", "_cy"])

    def outside(value: Column, axis: str) -> Column:
        return F.greatest(F.col(f"min_{axis}") - value, value - F.col(f"max_{axis}"), F.lit(0.0))

    def nearest(axis: str) -> Column:
        return F.greatest(
            F.col(f"min_{axis}") - F.col(f"_high_{axis}"),
            F.col(f"_low_{axis}") - F.col(f"max_{axis}"),
            F.lit(0.0),
        )

    def farthest(axis: str) -> Column:
        return F.greatest(outside(F.col(f"_low_{axis}"), axis), outside(F.col(f"_high_{axis}"), axis))

    limit = reach * reach
    least = nearest("x") * nearest("x") + nearest("y") * nearest("y")
    most = farthest("x") * farthest("x") + farthest("y") * farthest("y")
    judged = pairs.withColumns({"_least": least, "_most": most}).where(F.col("_least") <= limit)
    sure = judged.where(F.col("_most") <= limit).select(*by, *each, *box_id)
    open_ = judged.where(F.col("_most") > limit)
    exact = at.select(*by, *each, "_cx", "_cy", "x", "y").distinct()
    d2 = outside(F.col("x"), "x") * outside(F.col("x"), "x")
    d2 = d2 + outside(F.col("y"), "y") * outside(F.col("y"), "y")
    met = open_.join(exact, [*by, *each, "_cx", "_cy"]).where(d2 <= limit)
    near = sure.unionByName(met.select(*by, *each, *box_id)).distinct()
    if each:
        return near
    return boxes.join(near, [*by, *box_id], "left_semi")


def interacted_instances(recordings: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per instance a recording says it touched, by position."""
    return recordings.select(
        *key, "terrain_hash", F.explode("interacted_terrain_instance_ids").alias("instance_idx")
    )


def near_interacted(
    boxes: DataFrame,
    points: DataFrame,
    interacted: DataFrame,
    key: Sequence[str],
    *,
    reach: float = CORRIDOR_CM,
) -> DataFrame:
    """The ``interacted`` rows (``key``, ``terrain_hash``, ``instance_idx``) whose instance
    has its box near the points of the same ``key`` and terrain, with that box. Only these
    pairs are looked at, not every box that comes near a trajectory."""
    at = ["terrain_hash", "instance_idx"]
    named = boxes.join(interacted.select(*at).distinct(), at, "left_semi")
    pairs = settle(interacted.select(*key, *at).distinct().join(named.hint("merge"), at))
    return near_trajectory(pairs, points, [*key, "terrain_hash"], ["instance_idx"], reach=reach)


def interaction_agreement(
    interacted: DataFrame, near: DataFrame, key: Sequence[str]
) -> DataFrame:
    """Recorded interactions with ``is_near``: whether the instance also lies near
    the trajectory of its recording."""
    found = near.select(*key, "instance_idx").distinct().withColumn("_near", F.lit(True))
    joined = interacted.join(found, [*key, "instance_idx"], "left")
    return joined.withColumn("is_near", F.coalesce("_near", F.lit(False))).drop("_near")


def terrain_usage(motions: DataFrame) -> DataFrame:
    """Motions, frames and the common data scale per terrain."""
    used = motions.withColumn("terrain_ref", present(F.col("terrain_ref")))
    usage = used.where(F.col("terrain_ref").isNotNull()).groupBy("terrain_ref").agg(
        F.count(F.lit(1)).alias("motions"),
        F.sum("n_frames").alias("frames"),
        F.min("data_scale").alias("data_scale"),
        (F.max("data_scale") - F.min("data_scale")).alias("scale_range"),
    )
    return usage.withColumn("consistent", F.col("scale_range") <= SCALE_EPS)


def validate_usage(usage: DataFrame) -> None:
    must_be_empty(usage.where(~F.col("consistent")), "data scales differ", ["terrain_ref", "scale_range"])
