"""Queries over poses: frames of reference, scaling, grounding, commands.

An embedding holds nine joints of seven numbers (position, rotation as wxyz).
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaitmill.functions import rotation as rot
from gaitmill.functions.blend import NEARLY_PARALLEL, blend
from gaitmill.functions.rotation import Rigid, Vec
from gaitmill.operators import commands as cmd
from gaitmill.operators import geometry as geo
from gaitmill.operators import smoothing as sm
from gaitmill.operators.track import Track
from gaitmill.plans.registry import REGISTRY
from gaitmill.plans.sqltext import linear, lit, product, rotated
from gaitmill.plans.tables import COMMANDS_SQL, load, numbered_events

JOINTS = ("pelvis", "head", "foot_l", "foot_r", "ball_l", "ball_r", "thigh_l", "hand_r", "spine_05")
ALIGN = Rigid.from_wxyz((0.96, -0.12, 0.2, 0.05), (0.5, -1.25, 0.03))
DELTA = {"pelvis": (0.5, 0.5, -0.5, 0.5), "head": (0.8, 0.0, 0.6, 0.0)}
FACTORS = {"pelvis": 1.25, "thigh_l": 1.25, "hand_r": 1.125, "foot_l": 1.0625}
OFFSETS = {
    "pelvis": ((0.0, 0.0, 0.0), (0.6, 0.0, 0.0, -0.8)),
    "hand_r": ((0.1, -0.2, 0.3), (0.8, 0.6, 0.0, 0.0)),
}
SCALE = 0.77
QW = ("qw", "qx", "qy", "qz")


def number(i: int):
    return F.get("embedding", F.lit(i)).cast("double")


def _joint(o: int, name: str):
    x, y, z, w, a, b, c = [number(7 * o + k) for k in range(7)]
    return geo.joint(F.lit(name), Vec(x, y, z), rot.Quat(w, a, b, c))


def poses(spark, sf_dir):
    pose = F.array(*[_joint(o, n) for o, n in enumerate(JOINTS)])
    return load(spark, sf_dir, "embeddings").select("vec_id", "label", pose.alias("pose"))


_NAMES = ", ".join(f"({o}, '{n}')" for o, n in enumerate(JOINTS))
_PARTS = ", ".join(
    f"CAST(embedding[7 * o + {k + 1}] AS DOUBLE) AS {c}"
    for k, c in enumerate(("x", "y", "z", "qw", "qx", "qy", "qz"))
)
JOINTS_SQL = f"""WITH jt AS (
  SELECT vec_id, label, o, n AS joint, {_PARTS}
  FROM embeddings, (VALUES {_NAMES}) v(o, n))"""


def rounded(df, *columns: str, places: int = 6):
    return df.withColumns({c: F.round(c, places) for c in columns})


def rounds(exprs: dict[str, str], places: int = 6) -> str:
    return ", ".join(f"round({e}, {places}) AS {n}" for n, e in exprs.items())


XYZ = ("x", "y", "z")

# -- alignment: scale, axis swap, rigid transform, per-bone rotation -------------------

_swapped = [f"(y * {lit(SCALE)} * 0.01)", f"(x * {lit(SCALE)} * 0.01)", f"(z * {lit(SCALE)} * 0.01)"]
_aligned = [
    f"{e} + {lit(t)}" for e, t in zip(linear(ALIGN.rotation, _swapped), ALIGN.translation)
]
_turned = product([lit(c) for c in ALIGN.quaternion], ("qw", "(-qy)", "(-qx)", "(-qz)"))


def _delta(i: int) -> str:
    cases = " ".join(f"WHEN '{n}' THEN {lit(q[i])}" for n, q in DELTA.items())
    return f"(CASE joint {cases} ELSE {lit(1.0 if i == 0 else 0.0)} END)"


_equal = product(("tw", "tx", "ty", "tz"), [_delta(i) for i in range(4)])


@REGISTRY.add(
    JOINTS_SQL
    + f""", al AS (SELECT *, {", ".join(f"{e} AS t{n}" for n, e in zip("wxyz", _turned))} FROM jt)
SELECT vec_id, joint, {rounds(dict(zip(XYZ, _aligned)))}, {rounds(dict(zip(QW, _equal)))} FROM al"""
)
def rigid_transform(spark, sf_dir):
    rows = poses(spark, sf_dir)
    robot = geo.robot_pose(geo.scaled_pose(F.col("pose"), SCALE))
    rows = rows.withColumn("pose", robot)
    rows = rows.withColumn("pose", geo.aligned_pose(F.col("pose"), ALIGN, DELTA))
    joints = geo.joint_table(rows, ["vec_id"]).drop("joint_idx")
    return rounded(joints, *XYZ, *QW)


_half = math.sqrt(0.5)
_unit = [f"(u{c} / un)" for c in "wxyz"]
_mesh = product(("mw", "mx", "my", "mz"), (lit(_half), "0", "0", lit(-_half)))
_cp = rotated(("ww", "wx", "wy", "wz"), ("x", "y", "z"))
_cq = product(("ww", "wx", "wy", "wz"), [f"({c} / n)" for c in QW])


@REGISTRY.add(
    JOINTS_SQL
    + f""", root AS (SELECT vec_id, x AS rx, y AS ry, z AS rz, qw AS uw, qx AS ux, qy AS uy, qz AS uz,
  sqrt(qw*qw + qx*qx + qy*qy + qz*qz) AS un FROM jt WHERE joint = 'pelvis'),
unit AS (SELECT *, {", ".join(f"{e} AS m{c}" for c, e in zip("wxyz", _unit))} FROM root),
mesh AS (SELECT *, {", ".join(f"{e} AS w{c}" for c, e in zip("wxyz", _mesh))} FROM unit),
b AS (SELECT jt.*, sqrt(qw*qw + qx*qx + qy*qy + qz*qz) AS n, mesh.* EXCLUDE (vec_id)
  FROM jt JOIN mesh USING (vec_id))
SELECT vec_id, joint, {rounds({"x": _cp[0] + " + rx", "y": _cp[1] + " + ry", "z": _cp[2] + " + rz - 0.5"})},
  {rounds(dict(zip(QW, _cq)))} FROM b"""
)
def component_to_world(spark, sf_dir):
    def values(o):
        return [number(7 * o + k) for k in range(7)]

    def joint(o, name):
        x, y, z, w, a, b, c = values(o)
        return F.struct(
            F.lit(name).alias("n"), F.array(x, y, z).alias("cp"), F.array(a, b, c, w).alias("cq")
        )

    x, y, z, w, a, b, c = values(0)
    root = F.struct(F.array(x, y, z).alias("p"), F.array(a, b, c, w).alias("q"))
    rows = load(spark, sf_dir, "embeddings").select(
        "vec_id", F.array(*[joint(o, n) for o, n in enumerate(JOINTS)]).alias("joints"), root.alias("root")
    )
    placed = geo.component_poses(rows, keep_height=True, ground_cm=0.5)
    joints = geo.joint_table(placed, ["vec_id"]).drop("joint_idx")
    return rounded(joints, *XYZ, *QW)


# -- targets ---------------------------------------------------------------------------


@REGISTRY.add(
    JOINTS_SQL
    + """ SELECT f.vec_id, CASE f.joint WHEN 'foot_l' THEN 'LeftFootMod' ELSE 'RightFootMod' END AS joint,
  f.x, f.y, f.z, b.qw, b.qx, b.qy, b.qz FROM jt f
  JOIN jt b ON b.vec_id = f.vec_id AND b.joint = replace(f.joint, 'foot', 'ball')
  WHERE f.joint IN ('foot_l', 'foot_r')"""
)
def foot_targets(spark, sf_dir):
    rows = poses(spark, sf_dir)
    rows = rows.withColumn("pose", geo.with_foot_targets(F.col("pose")))
    added = geo.joint_table(rows, ["vec_id"]).drop("joint_idx")
    return added.where(F.col("joint").isin(*geo.FOOT_TARGETS))


_factor = "(CASE j.joint " + " ".join(f"WHEN '{n}' THEN {lit(s)}" for n, s in FACTORS.items()) + " END)"
_root_factor = lit(FACTORS["pelvis"])


@REGISTRY.add(
    JOINTS_SQL
    + f""" SELECT j.vec_id, j.joint,
  round((j.x - r.x - (r.x - r.x)) * {_factor} + r.x, 6) AS x,
  round((j.y - r.y) * {_factor} + r.y, 6) AS y,
  round((j.z - r.z) * {_factor} + {_root_factor} * r.z, 6) AS z
  FROM jt j JOIN jt r ON r.vec_id = j.vec_id AND r.joint = 'pelvis'
  WHERE {_factor} IS NOT NULL"""
)
def scale_about_root(spark, sf_dir):
    """Recentre on the root, scale about it, and put the offset back."""
    rows = geo.with_root(poses(spark, sf_dir))
    x, y, z = rot.named("root_")
    rows = rows.withColumn("pose", geo.recentred(F.col("pose"), x, y))
    centre = Vec(F.lit(0.0), F.lit(0.0), z)
    rows = rows.withColumn("pose", geo.scaled_about_root(F.col("pose"), FACTORS, centre))
    rows = rows.withColumn("pose", geo.recentred(F.col("pose"), -x, -y))
    joints = geo.joint_table(rows, ["vec_id"]).select("vec_id", "joint", *XYZ)
    return rounded(joints, *XYZ)


def _offset(values) -> str:
    return "(CASE joint " + " ".join(f"WHEN '{n}' THEN {lit(v)}" for n, v in values.items()) + " END)"


_turn = product(QW, [_offset({n: q[i] for n, (_, q) in OFFSETS.items()}) for i in range(4)])
_shift = [_offset({n: p[i] for n, (p, _) in OFFSETS.items()}) for i in range(3)]
_moved = rotated(("tw", "tx", "ty", "tz"), _shift)


@REGISTRY.add(
    JOINTS_SQL
    + f""", t AS (SELECT *, {", ".join(f"{e} AS t{n}" for n, e in zip("wxyz", _turn))}
  FROM (SELECT vec_id, joint, x, y, z, qw / n AS qw, qx / n AS qx, qy / n AS qy, qz / n AS qz FROM
        (SELECT *, sqrt(qw*qw + qx*qx + qy*qy + qz*qz) AS n FROM jt)))
SELECT vec_id, joint, {rounds({c: f"{c} + {m}" for c, m in zip(XYZ, _moved)})},
  {rounds({f"q{n}": f"t{n}" for n in "wxyz"})}
FROM t WHERE joint IN ('pelvis', 'hand_r')"""
)
def local_offset(spark, sf_dir):
    unit = F.transform(
        "pose", lambda j: geo.joint(j["joint"], geo.position(j), rot.unit(geo.orientation(j)))
    )
    rows = poses(spark, sf_dir).withColumn("pose", unit)
    rows = rows.withColumn("pose", geo.offset_locally(F.col("pose"), OFFSETS))
    return rounded(geo.joint_table(rows, ["vec_id"]).drop("joint_idx"), *XYZ, *QW)


@REGISTRY.add(
    JOINTS_SQL
    + """, z AS (SELECT vec_id, MAX(z) FILTER (WHERE joint = 'head') AS head,
  MIN(z) FILTER (WHERE joint IN ('foot_l', 'foot_r')) AS foot FROM jt GROUP BY ALL)
SELECT vec_id, round(head - foot + 0.09, 9) AS height, foot AS lowest FROM z"""
)
def standing_height(spark, sf_dir):
    pose = F.col("pose")
    return poses(spark, sf_dir).select(
        "vec_id",
        F.round(geo.standing_height(pose), 9).alias("height"),
        geo.lowest_foot(pose).alias("lowest"),
    )


@REGISTRY.add(
    JOINTS_SQL
    + """ SELECT vec_id, joint, x, y, round(z - MIN(z) FILTER (WHERE joint LIKE 'foot%') OVER (PARTITION BY vec_id)
  + 0.1 - 0.25, 9) AS z FROM jt"""
)
def drop_to_ground(spark, sf_dir):
    """Lowest foot to the clearance, then a constant ground offset."""
    rows = poses(spark, sf_dir)
    rows = rows.withColumn("pose", geo.dropped_to_ground(F.col("pose")))
    rows = rows.withColumn("pose", geo.raised(F.col("pose"), F.lit(-0.25)))
    joints = geo.joint_table(rows, ["vec_id"]).select("vec_id", "joint", *XYZ)
    return rounded(joints, "z", places=9)


_post = linear(ALIGN.rotation, ("x", "y", "z"))[2] + f" + {lit(ALIGN.translation[2])}"


@REGISTRY.add(
    JOINTS_SQL
    + f""" SELECT vec_id, round(MIN(z) - 0.031 - MIN({_post}), 6) AS dz
  FROM jt WHERE joint IN ('ball_l', 'ball_r') GROUP BY ALL"""
)
def ball_align(spark, sf_dir):
    pose = F.col("pose")
    shift = geo.ball_shift(pose, geo.aligned_pose(pose, ALIGN))
    return rounded(poses(spark, sf_dir).select("vec_id", shift.alias("dz")), "dz")


# -- commands and orientation ------------------------------------------------------------

_look = linear(ALIGN.rotation, ("sin(radians(look))", "cos(radians(look))", "0"))


def _single(e: str) -> str:
    return f"round(CAST(CAST({e} AS FLOAT) AS DOUBLE), 5)"


_inverse = rotated(("w", "(-x)", "(-y)", "(-z)"), ("v0", "v1", "v2"))


@REGISTRY.add(
    f"""WITH e AS (
  SELECT vec_id, {", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(16))} FROM embeddings),
u AS (SELECT *, sqrt(e0*e0 + e1*e1 + e2*e2 + e3*e3) AS n, e10 * 180 AS look FROM e),
c AS (SELECT *, e3 / n AS w, e0 / n AS x, e1 / n AS y, e2 / n AS z, e4 * 100 AS v0, e5 * 100 AS v1,
        e6 * 100 AS v2 FROM u)
SELECT vec_id, {_single(_look[0])} AS look_x, {_single(_look[1])} AS look_y,
  {_single("e8")} AS move_forward, {_single("e7")} AS move_right,
  {_single(_inverse[0] + " * 0.01")} AS vel_forward, {_single("-" + _inverse[1] + " * 0.01")} AS vel_left,
  {_single("-e11")} AS yaw_rate, e12 > 0 AS jump, FALSE AS crouch, e13 > 0 AS sprint, e14 > 0 AS walk
FROM c"""
)
def command_table(spark, sf_dir):
    e = [number(i) for i in range(16)]
    command = F.struct(
        F.array(e[7], e[8]).alias("move"),
        (e[10] * 180).alias("lookY"),
        e[11].alias("desYR"),
        (e[12] > 0).alias("jump"),
        F.lit(None).cast("boolean").alias("crouch"),
        (e[13] > 0).alias("sprint"),
        (e[14] > 0).alias("walk"),
    )
    root = F.struct(
        F.array(*e[0:4]).alias("q"), F.array(*[v * 100 for v in e[4:7]]).alias("lv")
    )
    rows = load(spark, sf_dir, "embeddings").select("vec_id", command.alias("cmd"), root.alias("root"))
    table = cmd.command_table(rows, ["vec_id"], ALIGN)
    floats = [f.name for f in table.schema.fields if f.dataType.typeName() == "float"]
    return table.withColumns({c: F.round(F.col(c).cast("double"), 5) for c in floats})


@REGISTRY.add(
    COMMANDS_SQL
    + """, motion AS (SELECT CASE WHEN event_type = 'view' THEN -1 - recording_id ELSE recording_id END AS recording_id,
  COUNT(*) AS n FROM cmd GROUP BY ALL)
SELECT recording_id, COUNT(*) AS frames, MAX(i) AS last FROM cmd JOIN motion USING (recording_id)
WHERE i < n GROUP BY ALL"""
)
def align_lengths(spark, sf_dir):
    """Commands of all events against motions of the same events, where views belong to
    a motion of their own."""
    frames = numbered_events(spark, sf_dir)
    recording = F.col("recording_id")
    apart = F.when(F.col("event_type") == "view", -1 - recording).otherwise(recording)
    others = frames.withColumn("recording_id", apart).drop("frame_idx", "n_frames")
    motion = Track.of(others, ["recording_id"], ["ts_us", "event_id"]).numbered("frame_idx").result()
    cut = cmd.align_lengths(frames, motion, ["recording_id", "frame_idx"])
    return cut.groupBy("recording_id").agg(
        F.count(F.lit(1)).alias("frames"), F.max("frame_idx").alias("last")
    )


_rel = product(("sw", "(-sx)", "(-sy)", "(-sz)"), ("hw", "hx", "hy", "hz"))


@REGISTRY.add(
    JOINTS_SQL
    + f""", p AS (
  SELECT vec_id, {", ".join(f"MAX(q{c}/n) FILTER (WHERE joint = 'spine_05') AS s{c}" for c in "wxyz")},
    {", ".join(f"MAX(q{c}/n) FILTER (WHERE joint = 'head') AS h{c}" for c in "wxyz")}
  FROM (SELECT *, sqrt(qw*qw + qx*qx + qy*qy + qz*qz) AS n FROM jt) GROUP BY ALL),
r AS (SELECT vec_id, {", ".join(f"{e} AS {c}" for c, e in zip("wxyz", _rel))} FROM p),
a AS (SELECT vec_id, degrees(atan2(2*(w*x + y*z), 1 - 2*(x*x + y*y))) AS roll,
        degrees(asin(greatest(least(2*(w*y - z*x), 1.0), -1.0))) AS pitch,
        degrees(atan2(2*(w*z + x*y), 1 - 2*(y*y + z*z))) AS yaw FROM r)
SELECT vec_id, round(roll, 5) AS roll, round(pitch, 5) AS pitch, round(yaw, 5) AS yaw,
  round(radians(-pitch), 6) AS neck_yaw, round(radians(roll), 6) AS neck_pitch FROM a"""
)
def relative_euler(spark, sf_dir):
    rows = poses(spark, sf_dir)
    spine = geo.orientation(geo.find(F.col("pose"), "spine_05"))
    head = geo.orientation(geo.find(F.col("pose"), "head"))
    angles = geo.relative_euler(spine, head)
    neck = geo.neck_angles(spine, head)
    names = ("roll", "pitch", "yaw")
    return rows.select(
        "vec_id",
        *[F.round(a, 5).alias(n) for n, a in zip(names, angles)],
        F.round(neck[0], 6).alias("neck_yaw"),
        F.round(neck[1], 6).alias("neck_pitch"),
    )


def clips(spark, sf_dir):
    """Embeddings of a label as one motion, densely numbered."""
    rows = load(spark, sf_dir, "embeddings").select(F.col("label").alias("seg_id"), "vec_id", "embedding")
    track = Track.of(rows, ["seg_id"], ["vec_id"]).numbered("frame_idx")
    return track.running(totals={"n_frames": F.lit(1).cast("long")}).result()


def clip_lengths(rows):
    return rows.where("frame_idx = 0").select("seg_id", "n_frames")


CLIPS_SQL = """WITH c AS (
  SELECT label AS seg_id, vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS e,
         row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_idx,
         COUNT(*) OVER (PARTITION BY label) AS n FROM embeddings)"""


@REGISTRY.add(
    CLIPS_SQL
    + """, u AS (SELECT *, sqrt(e[4]*e[4] + e[5]*e[5] + e[6]*e[6] + e[7]*e[7]) AS m,
  first_value(e) OVER (PARTITION BY seg_id ORDER BY frame_idx) AS e0 FROM c)
SELECT seg_id, frame_idx, e[1] - e0[1] AS x, e[2] - e0[2] AS y, e[3] AS z,
  e[5] AS qx, e[6] AS qy, e[7] AS qz, e[4] AS qw,
  round(1 - 2 * (e[6]*e[6] + e[7]*e[7]) / (m*m), 6) AS forward_x,
  round(2 * (e[5]*e[6] + e[4]*e[7]) / (m*m), 6) AS forward_y FROM u"""
)
def clip_recentre(spark, sf_dir):
    rows = clips(spark, sf_dir)
    q = F.transform("embedding", lambda v: v.cast("double"))
    view = geo.clip_view(rows.withColumn("q", q), clip_lengths(rows))
    return rounded(view, "forward_x", "forward_y")


# -- smoothing and grounding ---------------------------------------------------------------

WINDOW = 9


def hann_sql(source: str, key: str, value: str, window: int = WINDOW) -> str:
    """Smoothing as an equi-join with kernel rows: source has key, i, n and value."""
    half = window // 2
    return f"""ker AS (SELECT UNNEST(generate_series(-{half}, {half})) AS o),
wide AS (SELECT *, CASE WHEN n < 3 THEN 1 WHEN n >= {window} THEN {window} WHEN n % 2 = 1 THEN n ELSE n - 1 END AS w
  FROM {source}),
tap AS (SELECT wide.*, o, (1 + cos(2 * pi() * o / (w + 1))) / (w + 1) AS weight,
  CASE WHEN abs(i + o) > n - 1 THEN 2 * (n - 1) - abs(i + o) ELSE abs(i + o) END AS other
  FROM wide, ker WHERE abs(o) <= (w - 1) / 2),
smooth AS (SELECT t.{key}, t.i, CASE WHEN MIN(t.w) < 3 THEN MIN(t.{value}) ELSE SUM(t.weight * s.{value}) END AS sm
  FROM tap t JOIN {source} s ON s.{key} = t.{key} AND s.i = t.other GROUP BY t.{key}, t.i)"""


_NUMBERED = COMMANDS_SQL + """,
num AS (SELECT recording_id, i, value, COUNT(*) OVER (PARTITION BY recording_id) AS n FROM cmd),
"""


def _numbered(spark, sf_dir):
    rows = numbered_events(spark, sf_dir).select("recording_id", "frame_idx", "n_frames", "value")
    lengths = rows.where("frame_idx = 0").select("recording_id", "n_frames")
    return rows.drop("n_frames"), lengths


@REGISTRY.add(
    _NUMBERED
    + hann_sql("num", "recording_id", "value")
    + " SELECT recording_id, i AS frame_idx, round(sm, 6) AS value_smooth FROM smooth"
)
def hann_smooth(spark, sf_dir):
    rows, lengths = _numbered(spark, sf_dir)
    done = sm.smoothed(rows, lengths, ["recording_id"], "frame_idx", ["value"], WINDOW)
    return rounded(done.drop("value"), "value_smooth")


@REGISTRY.add(
    _NUMBERED
    + hann_sql("num", "recording_id", "value")
    + """, d AS (SELECT num.recording_id, value - lag(value) OVER w AS d0, sm - lag(sm) OVER w AS d1
  FROM num JOIN smooth USING (recording_id, i) WINDOW w AS (PARTITION BY num.recording_id ORDER BY i))
SELECT recording_id, round(COALESCE(stddev_pop(d0), 0), 5) AS value_step_std,
  round(COALESCE(stddev_pop(d1), 0), 5) AS value_smooth_step_std FROM d GROUP BY ALL"""
)
def diff_std(spark, sf_dir):
    rows, lengths = _numbered(spark, sf_dir)
    done = sm.smoothed(rows, lengths, ["recording_id"], "frame_idx", ["value"], WINDOW)
    found = sm.step_deviation(done, ["recording_id"], "frame_idx", ["value", "value_smooth"])
    return rounded(found, "value_step_std", "value_smooth_step_std", places=5)


def _shift_sql(want_l, want_r, have_l, have_r, k=50.0) -> str:
    low = f"least({have_l}, {have_r})"
    a, b = f"exp(-{k} * ({have_l} - {low}))", f"exp(-{k} * ({have_r} - {low}))"
    return f"({a} / ({a} + {b}) * ({want_l} - {have_l}) + {b} / ({a} + {b}) * ({want_r} - {have_r}))"


def feet(rows, **columns: int):
    return rows.select(
        "seg_id", "frame_idx", *[number(i).alias(n) for n, i in columns.items()]
    )


@REGISTRY.add(
    CLIPS_SQL
    + f""" SELECT seg_id, frame_idx, round({_shift_sql("e[1]", "e[2]", "e[3]", "e[4]")}, 6) AS dz FROM c"""
)
def softmin_blend(spark, sf_dir):
    rows = feet(clips(spark, sf_dir), want_l=0, want_r=1, have_l=2, have_r=3)
    shift = sm.support_shift(*[F.col(c) for c in ("want_l", "want_r", "have_l", "have_r")])
    return rows.select("seg_id", "frame_idx", F.round(shift, 6).alias("dz"))


@REGISTRY.add(
    CLIPS_SQL
    + f""", f AS (SELECT seg_id, frame_idx AS i, n, {_shift_sql("e[1]", "e[2]", "e[3]", "e[4]")} AS dz FROM c),
"""
    + hann_sql("f", "seg_id", "dz")
    + """ SELECT f.seg_id, f.i AS frame_idx, round(dz, 6) AS dz_raw, round(sm, 6) AS dz,
  round(sm / 1.1932, 6) AS dz_input FROM f JOIN smooth USING (seg_id, i)"""
)
def ground_targets(spark, sf_dir):
    rows = clips(spark, sf_dir)
    points = feet(rows, want_l=0, want_r=1, have_l=2, have_r=3)
    done = sm.ground_targets(
        points, clip_lengths(rows), ["seg_id"], "frame_idx", root_factor=1.1932
    )
    return rounded(
        done.select("seg_id", "frame_idx", "dz_raw", "dz", "dz_input"), "dz_raw", "dz", "dz_input"
    )


_root_shift = _shift_sql("(e[1] - 0.031)", "(e[2] - 0.031)", "(e[3] - 0.02)", "(e[4] - 0.02)")


@REGISTRY.add(
    CLIPS_SQL
    + f""", f AS (SELECT seg_id, frame_idx AS i, n, e[5] AS root_z, {_root_shift} AS dz FROM c),
"""
    + hann_sql("f", "seg_id", "dz")
    + """ SELECT f.seg_id, f.i AS frame_idx, round(sm, 6) AS dz, round(root_z + sm, 6) AS root_z_grounded
  FROM f JOIN smooth USING (seg_id, i)"""
)
def ground_root(spark, sf_dir):
    rows = clips(spark, sf_dir)
    points = feet(rows, ball_l=0, ball_r=1, toe_l=2, toe_r=3, root_z=4)
    done = sm.ground_root(
        points, clip_lengths(rows), ["seg_id"], "frame_idx", human_offset=0.031, robot_offset=0.02
    )
    return rounded(
        done.select("seg_id", "frame_idx", "dz", "root_z_grounded"), "dz", "root_z_grounded"
    )


# -- values between two frames ---------------------------------------------------------------

_UNIT = ", ".join(
    f"e[{o + k}] / sqrt(e[{o}]*e[{o}] + e[{o + 1}]*e[{o + 1}] + e[{o + 2}]*e[{o + 2}] + e[{o + 3}]*e[{o + 3}]) AS {n}{k}"
    for n, o in (("a", 1), ("c", 5))
    for k in range(4)
)
_flat = [f"(a{k} + u * (s * b{k} - a{k}))" for k in range(4)]
_length = "sqrt(" + " + ".join(f"{f} * {f}" for f in _flat) + ")"
_turned = ", ".join(
    f"round(CASE WHEN abs(d) > {NEARLY_PARALLEL} THEN {f} / {_length}"
    f" ELSE sin((1 - u) * g) / sin(g) * a{k} + s * sin(u * g) / sin(g) * b{k} END, 6)"
    for k, f in enumerate(_flat)
)
BETWEEN_SQL = f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT vec_id, e, CAST(vec_id % 11 AS DOUBLE) / 10.0 AS u, {_UNIT} FROM e),
q AS (SELECT *, {", ".join(f"CASE WHEN vec_id % 7 = 0 THEN -a{k} ELSE c{k} END AS b{k}" for k in range(4))} FROM n),
m AS (SELECT *, a0*b0 + a1*b1 + a2*b2 + a3*b3 AS d FROM q),
g AS (SELECT *, CASE WHEN d < 0 THEN -1.0 ELSE 1.0 END AS s, acos(least(abs(d), 1.0)) AS g FROM m)"""


def _between(spark, sf_dir):
    """Two unit quaternions of each vector and a fraction; some are the same turn."""
    first, second = [number(k) for k in range(4)], [number(4 + k) for k in range(4)]

    def unit(parts):
        length = F.sqrt(sum((p * p for p in parts[1:]), parts[0] * parts[0]))
        return F.array(*[p / length for p in parts])

    a = unit(first)
    same = F.transform(a, lambda v: -v)
    return load(spark, sf_dir, "embeddings").select(
        "vec_id",
        "embedding",
        a.alias("a"),
        F.when(F.col("vec_id") % 7 == 0, same).otherwise(unit(second)).alias("b"),
        (F.col("vec_id") % 11 / 10.0).cast("double").alias("u"),
    )


@REGISTRY.add(BETWEEN_SQL + f" SELECT vec_id, UNNEST(range(4)) AS part, UNNEST([{_turned}]) AS value FROM g")
def slerp_between(spark, sf_dir):
    rows = _between(spark, sf_dir)
    turned = blend(F.col("a"), F.col("b"), T.ArrayType(T.DoubleType()), F.col("u"), name="q")
    parts = rows.select("vec_id", F.posexplode(turned).alias("part", "value"))
    return rounded(parts.select("vec_id", F.col("part").cast("long").alias("part"), "value"), "value")


@REGISTRY.add(
    BETWEEN_SQL
    + """ SELECT vec_id, round(e[9], 6) AS held, round(e[9] + u * (e[10] - e[9]), 6) AS blended,
  CASE WHEN u < 0.5 THEN vec_id % 5 ELSE vec_id % 3 END AS snapped FROM g"""
)
def joints_between(spark, sf_dir):
    """Joints stay as they are unless records are blended too; integers snap."""
    kind = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("n", T.LongType())]))
    side = [
        F.array(F.struct(number(8 + i).alias("x"), (F.col("vec_id") % n).alias("n")))
        for i, n in enumerate((5, 3))
    ]
    rows = _between(spark, sf_dir)
    held, mixed = (blend(*side, kind, F.col("u"), records=r)[0] for r in ("hold", "blend"))
    return rounded(
        rows.select("vec_id", held["x"].alias("held"), mixed["x"].alias("blended"), mixed["n"].alias("snapped")),
        "held", "blended",
    )
