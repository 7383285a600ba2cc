"""Queries over terrain: placed meshes, height fields, trajectory joins.

Parts are meshes (a pyramid of the part's size, the brand is the terrain), orders
place them; parts are also flat triangles and boxes in metres.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gaitmill.operators import terrain as te
from gaitmill.operators.shared import settle
from gaitmill.plans.posing import ALIGN, rounded
from gaitmill.plans.registry import REGISTRY
from gaitmill.plans.sqltext import linear, lit, rotated
from gaitmill.plans.tables import events, load

GROUND_CM, SCALE = 12.0, 0.77

# -- meshes and instances ---------------------------------------------------------------


def meshes(spark, sf_dir):
    s = F.col("p_size").cast("double")
    zero = F.lit(0.0)
    corners = [(zero, zero, zero), (s, zero, zero), (zero, s, zero), (zero, zero, s)]
    asset = (
        F.when(F.col("p_size") % 10 == 0, "/Engine/BasicShapes/Cube")
        .when(F.col("p_size") % 9 == 0, "/MotionCapture/Synthetic/GroundPlane")
        .otherwise(F.concat(F.lit("/Game/"), F.col("p_type")))
    )
    ups = F.array(*[F.array(*[F.lit(float(c)) for c in v]) for v in ((0.3, -0.2, -1), (1, 0.1, 0.2), (0.15, 1, -0.1), (0.2, 0.25, 1))])
    return load(spark, sf_dir, "part").select(
        F.col("p_brand").alias("terrain_hash"),
        F.col("p_partkey").alias("mesh_idx"),
        asset.alias("asset_path"),
        F.array(*[F.array(*c) for c in corners]).alias("vertices"),
        F.when(F.col("p_partkey") % 2 == 0, ups).alias("normals"),
        F.array(*[F.lit(i).cast("long") for i in (0, 1, 2, 0, 1, 3, 0, 2, 3, 1, 2, 3)]).alias("indices"),
    )


def instances(spark, sf_dir):
    brands = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("mesh_idx"), F.col("p_brand").alias("terrain_hash")
    )
    key = F.col("o_orderkey")
    placed = load(spark, sf_dir, "orders").select(
        key.alias("instance_idx"),
        F.col("o_custkey").alias("mesh_idx"),
        F.array(F.col("o_totalprice") / 100.0, (key % 1000).cast("double"),
                (F.col("o_custkey") % 50).cast("double")).alias("location"),
        F.array(F.lit(0.0), F.lit(0.0), (key % 7 - 3).cast("double"), F.lit(2.0)).alias("rotation_quat_xyzw"),
        F.array((1 + key % 3).cast("double"), (1 + F.col("o_custkey") % 2).cast("double"),
                F.when(key % 5 == 0, -1.0).otherwise(1.0)).alias("scale"),
    )
    return placed.join(brands, "mesh_idx")


def geometry(spark, sf_dir):
    placed = te.placed_meshes(instances(spark, sf_dir), meshes(spark, sf_dir))
    return te.world_geometry(placed, ALIGN, ground_cm=GROUND_CM, data_scale=SCALE)


_q = ("qw", "0", "0", "qz")
_w = rotated(_q, ("vx * sx", "vy * sy", "vz * sz"))
_cm = [f"(({_w[0]} + lx) * {lit(SCALE)})", f"(({_w[1]} + ly) * {lit(SCALE)})",
       f"(({_w[2]} + lz - {lit(GROUND_CM)}) * {lit(SCALE)})"]
_robot = [f"({_cm[1]} * 0.01)", f"({_cm[0]} * 0.01)", f"({_cm[2]} * 0.01)"]
_world = [f"{e} + {lit(t)}" for e, t in zip(linear(ALIGN.rotation, _robot), ALIGN.translation)]
_n = rotated(_q, ("nx * sx", "ny * sy", "nz * sz"))
_up = linear(ALIGN.rotation, [f"({_n[1]} * 0.01)", f"({_n[0]} * 0.01)", f"({_n[2]} * 0.01)"])

GEOMETRY_SQL = f"""WITH inst AS (
  SELECT p_brand AS terrain_hash, o_orderkey AS instance_idx, p_size AS s, p_partkey % 2 = 0 AS has_n,
         o_totalprice / 100.0 AS lx, CAST(o_orderkey % 1000 AS DOUBLE) AS ly, CAST(o_custkey % 50 AS DOUBLE) AS lz,
         (o_orderkey % 7 - 3) / sqrt((o_orderkey % 7 - 3) * (o_orderkey % 7 - 3) + 4.0) AS qz,
         2.0 / sqrt((o_orderkey % 7 - 3) * (o_orderkey % 7 - 3) + 4.0) AS qw,
         CAST(1 + o_orderkey % 3 AS DOUBLE) AS sx, CAST(1 + o_custkey % 2 AS DOUBLE) AS sy,
         CASE WHEN o_orderkey % 5 = 0 THEN -1.0 ELSE 1.0 END AS sz
  FROM orders JOIN part ON p_partkey = o_custkey WHERE p_size % 10 <> 0),
offs AS (SELECT *, CAST(4 * (row_number() OVER (PARTITION BY terrain_hash ORDER BY instance_idx) - 1) AS BIGINT)
         AS off FROM inst),
corner(k, cx, cy, cz, nx, ny, nz) AS (VALUES (0,0,0,0,0.3,-0.2,-1), (1,1,0,0,1,0.1,0.2), (2,0,1,0,0.15,1,-0.1), (3,0,0,1,0.2,0.25,1)),
v AS (SELECT *, CAST(cx * s AS DOUBLE) AS vx, CAST(cy * s AS DOUBLE) AS vy, CAST(cz * s AS DOUBLE) AS vz
      FROM offs, corner),
vert AS (
  SELECT terrain_hash, instance_idx, k, off, off + k AS vertex_id, has_n, sx * sy * sz > 0 AS mirrored,
         {", ".join(f"{e} AS {c}" for c, e in zip("xyz", _world))},
         {", ".join(f"{e} AS u{c}" for c, e in zip("xyz", _up))} FROM v),
face(f, i0, i1, i2) AS (VALUES (0,0,1,2), (1,0,1,3), (2,0,2,3), (3,1,2,3)),
mesh AS (SELECT terrain_hash, instance_idx, off, has_n, mirrored,
  list(struct_pack(x := x, y := y, z := z, ux := ux, uy := uy, uz := uz) ORDER BY k) AS p FROM vert GROUP BY ALL),
corners AS (SELECT *, p[i0 + 1] AS a, p[i1 + 1] AS b, p[i2 + 1] AS c FROM mesh, face),
tri AS (
  SELECT terrain_hash, instance_idx, f AS face_idx, off + i0 AS va, off + i1 AS vb, off + i2 AS vc, has_n, mirrored,
    ((b.y-a.y)*(c.z-a.z) - (b.z-a.z)*(c.y-a.y)) * (a.ux+b.ux+c.ux)
    + ((b.z-a.z)*(c.x-a.x) - (b.x-a.x)*(c.z-a.z)) * (a.uy+b.uy+c.uy)
    + ((b.x-a.x)*(c.y-a.y) - (b.y-a.y)*(c.x-a.x)) * (a.uz+b.uz+c.uz) AS facing
  FROM corners),
turned AS (SELECT *, CASE WHEN has_n THEN facing < 0 ELSE mirrored END AS flip FROM tri)"""


@REGISTRY.add(
    GEOMETRY_SQL
    + """ SELECT terrain_hash, instance_idx, vertex_id, round(x, 6) AS x, round(y, 6) AS y,
  round(z, 6) AS z FROM vert"""
)
def terrain_vertices(spark, sf_dir):
    return rounded(te.vertex_table(geometry(spark, sf_dir)), "x", "y", "z")


@REGISTRY.add(
    GEOMETRY_SQL
    + """ SELECT terrain_hash, instance_idx, face_idx, CASE WHEN flip THEN vc ELSE va END AS a, vb AS b,
  CASE WHEN flip THEN va ELSE vc END AS c FROM turned"""
)
def terrain_faces(spark, sf_dir):
    triangles = te.triangle_table(geometry(spark, sf_dir))
    return triangles.select("terrain_hash", "instance_idx", "face_idx", "a", "b", "c")


@REGISTRY.add(
    GEOMETRY_SQL
    + """ SELECT terrain_hash, COUNT(*) AS n_vertices, round(MIN(x), 6) AS min_x, round(MAX(x), 6) AS max_x,
  round(MIN(y), 6) AS min_y, round(MAX(y), 6) AS max_y, round(MIN(z), 6) AS min_z, round(MAX(z), 6) AS max_z,
  (SELECT COUNT(*) FROM tri WHERE tri.terrain_hash = vert.terrain_hash) AS n_triangles
  FROM vert GROUP BY terrain_hash"""
)
def mesh_bounds(spark, sf_dir):
    placed = geometry(spark, sf_dir)
    found = te.bounds(te.vertex_table(placed), counts=te.triangle_counts(placed))
    return rounded(found, *[f"{n}_{c}" for n in ("min", "max") for c in "xyz"])


# -- flat triangles in metres ---------------------------------------------------------------


def triangles(spark, sf_dir):
    key, s = F.col("p_partkey"), F.col("p_size")
    x, y = (key % 40).cast("double"), s.cast("double")
    z = F.col("p_retailprice") / 1000.0
    values = {
        "x0": x, "y0": y, "z0": z,
        "x1": x + 1.0 + s % 3, "y1": y + 0.5, "z1": z + 0.25,
        "x2": x + 0.5, "y2": y + 2.0, "z2": z - 0.125 * (key % 5),
    }
    return load(spark, sf_dir, "part").select(
        F.col("p_brand").alias("terrain_hash"),
        key.alias("instance_idx"),
        F.lit(0).alias("face_idx"),
        *[(key * 3 + k).alias(n) for k, n in enumerate("abc")],
        *[c.alias(n) for n, c in values.items()],
    )


def extent(rows):
    corners = F.array(*[F.struct(*[F.col(f"{c}{k}").alias(c) for c in "xyz"]) for k in range(3)])
    points = rows.select("terrain_hash", F.explode(corners).alias("_v")).select("terrain_hash", "_v.*")
    return te.bounds(points)


FLAT_SQL = """WITH tri AS (
  SELECT p_brand AS terrain_hash, p_partkey AS instance_idx, 3 * p_partkey AS a, 3 * p_partkey + 1 AS b,
         3 * p_partkey + 2 AS c,
         CAST(p_partkey % 40 AS DOUBLE) AS x0, CAST(p_size AS DOUBLE) AS y0, p_retailprice / 1000.0 AS z0,
         CAST(p_partkey % 40 + 1 + p_size % 3 AS DOUBLE) AS x1, CAST(p_size + 0.5 AS DOUBLE) AS y1,
         p_retailprice / 1000.0 + 0.25 AS z1, CAST(p_partkey % 40 + 0.5 AS DOUBLE) AS x2,
         CAST(p_size + 2.0 AS DOUBLE) AS y2, p_retailprice / 1000.0 - 0.125 * (p_partkey % 5) AS z2 FROM part),
ext AS (SELECT terrain_hash, 3 * COUNT(*) AS n_vertices, MIN(least(x0, x1, x2)) AS min_x, MAX(greatest(x0, x1, x2)) AS max_x,
          MIN(least(y0, y1, y2)) AS min_y, MAX(greatest(y0, y1, y2)) AS max_y FROM tri GROUP BY ALL)"""


@REGISTRY.add(
    FLAT_SQL
    + """, g AS (SELECT p_brand AS terrain_hash FROM part GROUP BY ALL
  HAVING AVG(CASE WHEN p_size % 9 = 0 AND p_size % 10 <> 0 THEN 1.0 ELSE 0.0 END) > 0.1),
q AS (SELECT terrain_hash, n_vertices AS n, min_x - 5.0 AS l, max_x + 5.0 AS r, min_y - 5.0 AS d, max_y + 5.0 AS u
  FROM ext WHERE terrain_hash NOT IN (SELECT terrain_hash FROM g))
SELECT terrain_hash, 0 AS face_idx, n AS a, n + 1 AS b, n + 2 AS c, l AS x0, r AS x1, r AS x2, d AS y0, d AS y1, u AS y2,
  CAST(0.0 AS DOUBLE) AS z0, CAST(0.0 AS DOUBLE) AS z1, CAST(0.0 AS DOUBLE) AS z2 FROM q
UNION ALL SELECT terrain_hash, 1, n, n + 2, n + 3, l, r, l, d, u, u, 0.0, 0.0, 0.0 FROM q"""
)
def ground_quads(spark, sf_dir):
    """Ground for the terrains where at most a tenth of the parts counts as ground."""
    parts = meshes(spark, sf_dir)
    flag = F.col("asset_path").contains(te.GROUND_ASSET).cast("double")
    often = parts.groupBy("terrain_hash").agg(F.avg(flag).alias("share")).where("share > 0.1")
    grounded = te.has_source_ground(parts.join(often, "terrain_hash", "left_semi"))
    return te.ground_quads(extent(triangles(spark, sf_dir)), grounded)


@REGISTRY.add(
    """SELECT p_brand AS terrain_hash, bool_or(p_size % 9 = 0 AND p_size % 10 <> 0) AS has_ground
FROM part GROUP BY ALL"""
)
def source_ground(spark, sf_dir):
    return te.has_source_ground(meshes(spark, sf_dir))


@REGISTRY.add(
    FLAT_SQL
    + """, grid AS (
  SELECT terrain_hash, min_x - 0.5 AS gx, min_y - 0.5 AS gy, CAST(ceil((max_x - min_x + 1.0) / 0.5) AS BIGINT) AS nc,
         CAST(ceil((max_y - min_y + 1.0) / 0.5) AS BIGINT) AS nr FROM ext),
span AS (
  SELECT tri.*, gx, gy, (x1-x0)*(y2-y0) - (x2-x0)*(y1-y0) AS det,
    greatest(CAST(trunc((least(x0,x1,x2) - gx) / 0.5) AS BIGINT), 0) AS c0,
    least(CAST(trunc((greatest(x0,x1,x2) - gx) / 0.5) AS BIGINT), nc - 1) AS c1,
    greatest(CAST(trunc((least(y0,y1,y2) - gy) / 0.5) AS BIGINT), 0) AS r0,
    least(CAST(trunc((greatest(y0,y1,y2) - gy) / 0.5) AS BIGINT), nr - 1) AS r1
  FROM tri JOIN grid USING (terrain_hash)),
cell AS (
  SELECT terrain_hash, ri AS row, ci AS col, z0, z1, z2, det, x0, x1, x2, y0, y1, y2,
    gx + (ci + 0.5) * 0.5 - x0 AS dx, gy + (ri + 0.5) * 0.5 - y0 AS dy
  FROM span, UNNEST(generate_series(r0, r1)) ra(ri), UNNEST(generate_series(c0, c1)) ca(ci) WHERE abs(det) >= 1e-12),
bary AS (SELECT *, (dx*(y2-y0) - (x2-x0)*dy) / det AS u, ((x1-x0)*dy - dx*(y1-y0)) / det AS v FROM cell),
hit AS (SELECT terrain_hash, row, col, MAX(z0 + u*(z1-z0) + v*(z2-z0)) AS z FROM bary
  WHERE u >= -1e-6 AND v >= -1e-6 AND u + v <= 1 + 1e-6 GROUP BY ALL),
every AS (SELECT terrain_hash, r AS row, c AS col FROM grid, UNNEST(generate_series(0, nr - 1)) a(r),
  UNNEST(generate_series(0, nc - 1)) b(c))
SELECT e.terrain_hash, e.row, e.col, round(COALESCE(z, -0.75), 6) AS z FROM every e LEFT JOIN hit
  ON hit.terrain_hash = e.terrain_hash AND hit.row = e.row AND hit.col = e.col"""
)
def height_field(spark, sf_dir):
    rows = triangles(spark, sf_dir)
    return rounded(te.height_field(rows, extent(rows), size=0.5, fill=-0.75), "z")


# -- trajectories ------------------------------------------------------------------------------


def _brand(n):
    return F.concat(F.lit("Brand#"), n.cast("string"))


def tracks(spark, sf_dir):
    """Events as trajectory points; users walk on one of 25 terrains."""
    return events(spark, sf_dir).select(
        F.col("recording_id").alias("seg_id"),
        _brand(F.col("recording_id") % 25 + 1).alias("terrain_hash"),
        (F.col("value") / 10.0).alias("x"),
        (F.col("props.k") / 2.0).alias("y"),
    )


TRACK_SQL = """pts AS (
  SELECT user_id AS seg_id, 'Brand#' || (user_id % 25 + 1) AS terrain_hash, value / 10.0 AS x,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) / 2.0 AS y FROM events)"""


@REGISTRY.add(
    FLAT_SQL
    + ", "
    + TRACK_SQL
    + """, box AS (SELECT seg_id, terrain_hash, MIN(x) - 3 AS l, MAX(x) + 3 AS r, MIN(y) - 3 AS d, MAX(y) + 3 AS u
  FROM pts GROUP BY ALL),
j AS (SELECT seg_id, instance_idx, a, b, c, (x0+x1+x2)/3 BETWEEN l AND r AND (y0+y1+y2)/3 BETWEEN d AND u AS near
  FROM box JOIN tri USING (terrain_hash)),
k AS (SELECT * FROM j WHERE near OR seg_id NOT IN (SELECT seg_id FROM j WHERE near)),
used AS (SELECT DISTINCT seg_id, UNNEST([a, b, c]) AS v FROM k),
num AS (SELECT seg_id, v, row_number() OVER (PARTITION BY seg_id ORDER BY v) - 1 AS i FROM used)
SELECT k.seg_id, k.instance_idx, 0 AS face_idx, na.i AS new_a, nb.i AS new_b, nc.i AS new_c FROM k
JOIN num na ON na.seg_id = k.seg_id AND na.v = a JOIN num nb ON nb.seg_id = k.seg_id AND nb.v = b
JOIN num nc ON nc.seg_id = k.seg_id AND nc.v = c"""
)
def bbox_crop(spark, sf_dir):
    points = tracks(spark, sf_dir)
    motions = points.select("seg_id", "terrain_hash").distinct()
    return te.crop_faces(triangles(spark, sf_dir), points, motions)


def boxes(spark, sf_dir):
    key = F.col("p_partkey")
    x = (F.col("p_retailprice") - 900.0) / 4.0
    y = F.col("p_size").cast("double")
    return load(spark, sf_dir, "part").select(
        F.col("p_brand").alias("terrain_hash"),
        key.alias("instance_idx"),
        x.alias("min_x"),
        y.alias("min_y"),
        (x + (key % 5) * 0.4).alias("max_x"),
        (y + (key % 3) * 0.5).alias("max_y"),
    )


BOX_SQL = (
    "WITH "
    + TRACK_SQL
    + """, box AS (
  SELECT p_brand AS terrain_hash, p_partkey AS instance_idx, (p_retailprice - 900.0) / 4.0 AS min_x,
         CAST(p_size AS DOUBLE) AS min_y, (p_retailprice - 900.0) / 4.0 + (p_partkey % 5) * CAST(0.4 AS DOUBLE) AS max_x,
         p_size + (p_partkey % 3) * CAST(0.5 AS DOUBLE) AS max_y FROM part),
d AS (SELECT box.terrain_hash, instance_idx, seg_id,
        greatest(min_x - x, x - max_x, 0.0) AS dx, greatest(min_y - y, y - max_y, 0.0) AS dy
      FROM box JOIN pts USING (terrain_hash)),
near AS (SELECT DISTINCT terrain_hash, instance_idx, seg_id FROM d WHERE dx * dx + dy * dy <= 0.7 * 0.7)"""
)
REACH = 0.7


@REGISTRY.add(
    BOX_SQL
    + """ SELECT DISTINCT terrain_hash, instance_idx, min_x, min_y, max_x, max_y
  FROM box JOIN near USING (terrain_hash, instance_idx)"""
)
def corridor_join(spark, sf_dir):
    return te.near_trajectory(
        boxes(spark, sf_dir), tracks(spark, sf_dir), ["terrain_hash"], ["instance_idx"], reach=REACH
    )


@REGISTRY.add(
    BOX_SQL
    + """, said AS (SELECT DISTINCT user_id AS seg_id, 'Brand#' || (user_id % 25 + 1) AS terrain_hash,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS instance_idx FROM events)
SELECT s.seg_id, s.terrain_hash, s.instance_idx, n.seg_id IS NOT NULL AS is_near
FROM said s LEFT JOIN near n ON n.seg_id = s.seg_id AND n.instance_idx = s.instance_idx"""
)
def interacted_instances(spark, sf_dir):
    """Recorded ids are the distinct k of a user; near is judged per user."""
    points = tracks(spark, sf_dir)
    walks = points.select("seg_id", "terrain_hash").distinct()
    said = events(spark, sf_dir).select(
        F.col("recording_id").alias("seg_id"),
        F.array(F.col("props.k").cast("long")).alias("interacted_terrain_instance_ids"),
    ).distinct()
    listed = settle(te.interacted_instances(said.join(walks, "seg_id"), ["seg_id"]))
    near = te.near_interacted(boxes(spark, sf_dir), points, listed, ["seg_id"], reach=REACH)
    return te.interaction_agreement(listed, near, ["seg_id"])


@REGISTRY.add(
    """WITH m AS (
  SELECT CASE WHEN o_orderpriority LIKE '4%' THEN '' ELSE o_orderpriority END AS terrain_ref,
         o_custkey % 50 AS n_frames,
         CAST(CASE WHEN o_orderpriority LIKE '1%' AND o_orderkey % 9 = 0 THEN 1.0 ELSE 0.77 END AS DOUBLE) AS s
  FROM orders)
SELECT terrain_ref, COUNT(*) AS motions, CAST(SUM(n_frames) AS BIGINT) AS frames, MIN(s) AS data_scale,
  MAX(s) - MIN(s) AS scale_range, MAX(s) - MIN(s) <= 1e-6 AS consistent
FROM m WHERE terrain_ref <> '' GROUP BY ALL"""
)
def terrain_usage(spark, sf_dir):
    priority = F.col("o_orderpriority")
    odd = priority.startswith("1") & (F.col("o_orderkey") % 9 == 0)
    rows = load(spark, sf_dir, "orders").select(
        F.when(priority.startswith("4"), "").otherwise(priority).alias("terrain_ref"),
        (F.col("o_custkey") % 50).alias("n_frames"),
        F.when(odd, 1.0).otherwise(0.77).alias("data_scale"),
    )
    return te.terrain_usage(rows)
