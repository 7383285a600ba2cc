"""Queries over metrics, calibration, ordering and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaitmill.operators import calibrate as cal
from gaitmill.operators import metrics as m
from gaitmill.operators import smoothing as sm
from gaitmill.operators.geometry import joint_table
from gaitmill.operators.stats import duration_summary
from gaitmill.plans.posing import CLIPS_SQL, JOINTS_SQL, clips, feet, number, poses, rounded
from gaitmill.plans.registry import REGISTRY
from gaitmill.plans.sqltext import product
from gaitmill.plans.tables import COMMANDS_SQL, load, numbered_events

# -- human against robot: a pose against the same pose read backwards ---------------------

PAIRS = {"pelvis": "spine_05", "head": "hand_r", "foot_l": "foot_r", "ball_l": "ball_l"}
_PAIR_ROWS = ", ".join(f"('{h}', '{r}')" for h, r in PAIRS.items())
_DIST = "sqrt((h.x - r.x) * (h.x - r.x) + (h.y - r.y) * (h.y - r.y) + (h.z - r.z) * (h.z - r.z))"


def _skeletons(spark, sf_dir):
    rows = poses(spark, sf_dir)
    human = joint_table(rows, ["vec_id", "label"])
    shifted = F.transform(
        "pose",
        lambda j: j.withField("x", j["z"]).withField("y", j["x"]).withField("z", j["y"]),
    )
    return human, joint_table(rows.withColumn("pose", shifted), ["vec_id", "label"])


ROBOT_SQL = JOINTS_SQL + """,
rb AS (SELECT vec_id, label, joint, z AS x, x AS y, y AS z FROM jt)"""


@REGISTRY.add(
    ROBOT_SQL
    + f""", pr(hn, rn) AS (VALUES {_PAIR_ROWS})
SELECT h.vec_id, COUNT(*) AS pairs, round(AVG({_DIST}) * 1000, 5) AS error_mm
FROM jt h JOIN pr ON pr.hn = h.joint JOIN rb r ON r.vec_id = h.vec_id AND r.joint = pr.rn GROUP BY ALL"""
)
def pair_error(spark, sf_dir):
    human, robot = _skeletons(spark, sf_dir)
    return rounded(m.pair_error(human, robot, PAIRS, ["vec_id"]), "error_mm", places=5)


@REGISTRY.add(
    ROBOT_SQL
    + f""", d AS (SELECT h.label, {_DIST} AS d FROM jt h JOIN rb r ON r.vec_id = h.vec_id
  AND r.joint = 'pelvis' AND h.joint = 'pelvis')
SELECT label, round(median(d), 7) AS median, round(quantile_cont(d, 0.95), 7) AS p95, round(MAX(d), 7) AS max
FROM d GROUP BY ALL"""
)
def pelvis_offset(spark, sf_dir):
    human, robot = _skeletons(spark, sf_dir)
    found = m.offset_summary(human, robot, "pelvis", ["vec_id", "label"], ["label"])
    return rounded(found, "median", "p95", "max", places=7)


@REGISTRY.add(
    JOINTS_SQL
    + """, f AS (SELECT vec_id, label, MIN(z) AS z FROM jt WHERE joint IN ('foot_l', 'foot_r') GROUP BY ALL)
SELECT label, MIN(z) AS min, round(median(z), 7) AS median, MAX(z) AS max FROM f GROUP BY ALL"""
)
def foot_heights(spark, sf_dir):
    human, _ = _skeletons(spark, sf_dir)
    found = m.foot_height_summary(human, ["foot_l", "foot_r"], ["vec_id", "label"], ["label"])
    return rounded(found, "median", places=7)


@REGISTRY.add(
    CLIPS_SQL
    + """ SELECT seg_id, round(AVG(abs((e[3] - 0.02) - (e[1] - 0.031))), 7) AS mean_l,
  round(MAX(abs((e[3] - 0.02) - (e[1] - 0.031))), 7) AS max_l,
  round(AVG(abs((e[4] - 0.02) - (e[2] - 0.031))), 7) AS mean_r,
  round(MAX(abs((e[4] - 0.02) - (e[2] - 0.031))), 7) AS max_r FROM c GROUP BY ALL"""
)
def grounding_residual(spark, sf_dir):
    points = feet(clips(spark, sf_dir), ball_l=0, ball_r=1, toe_l=2, toe_r=3)
    found = m.grounding_residual(points, human_offset=0.031, robot_offset=0.02, by=["seg_id"])
    return rounded(found, "mean_l", "max_l", "mean_r", "max_r", places=7)


_STEPS = CLIPS_SQL + """,
d AS (SELECT seg_id, frame_idx, abs(e[1] - lag(e[1]) OVER (PARTITION BY seg_id ORDER BY frame_idx)) AS s FROM c)"""


@REGISTRY.add(
    _STEPS
    + """ SELECT seg_id, round(MAX(s), 7) AS max_step, COUNT(*) FILTER (WHERE s > 0.1) AS jumps,
  round(median(s), 7) AS median_step FROM d WHERE s IS NOT NULL GROUP BY ALL"""
)
def smoothness(spark, sf_dir):
    points = feet(clips(spark, sf_dir), z=0)
    summary, _ = m.smoothness(points, ["seg_id"], "frame_idx", "z", limit=0.1)
    return rounded(summary, "max_step", "median_step", places=7)


@REGISTRY.add(
    _STEPS
    + """, r AS (SELECT seg_id, frame_idx - 1 AS frame, round(s, 7) AS size,
  row_number() OVER (PARTITION BY seg_id ORDER BY frame_idx) AS rank FROM d WHERE s > 0.1)
SELECT * FROM r WHERE rank <= 12"""
)
def first_jumps(spark, sf_dir):
    points = feet(clips(spark, sf_dir), z=0)
    _, jumps = m.smoothness(points, ["seg_id"], "frame_idx", "z", limit=0.1)
    return rounded(jumps.withColumn("rank", F.col("rank").cast("long")), "size", places=7)


@REGISTRY.add(
    CLIPS_SQL
    + """ SELECT seg_id, MIN(e[1]) AS min, MAX(e[1]) AS max, round(stddev_pop(e[1]), 7) AS std,
  round(median(e[1]), 7) AS median FROM c GROUP BY ALL"""
)
def shift_summary(spark, sf_dir):
    points = feet(clips(spark, sf_dir), z=0)
    middles = duration_summary(points, "z", ["seg_id"]).select("seg_id", "median")
    found = sm.shift_summary(points, "z", ["seg_id"]).join(middles, "seg_id")
    return rounded(found, "std", "median", places=7)


# -- order and sampling ---------------------------------------------------------------------


@REGISTRY.add(
    """WITH m AS (SELECT o_orderstatus AS category, o_orderkey AS seg_id, o_custkey % 50 AS n_frames FROM orders)
SELECT category, seg_id, n_frames, CAST(SUM(n_frames) OVER (ORDER BY category, seg_id) AS BIGINT) - n_frames
  AS frame_offset FROM m"""
)
def frame_offsets(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("category"),
        F.col("o_orderkey").alias("seg_id"),
        (F.col("o_custkey") % 50).alias("n_frames"),
    )
    return m.frame_offsets(rows, ["category", "seg_id"])


@REGISTRY.add(
    COMMANDS_SQL
    + """, n AS (SELECT recording_id, COUNT(*) AS n FROM cmd GROUP BY ALL)
SELECT cmd.recording_id, i AS frame_idx, event_id, value FROM cmd JOIN n USING (recording_id)
WHERE i = CAST(floor(CAST(37.3 AS DOUBLE) * (30 + recording_id % 4 * 10)) AS BIGINT) % n"""
)
def clock_lookup(spark, sf_dir):
    frames = numbered_events(spark, sf_dir)
    fps = (30 + F.col("recording_id") % 4 * 10).cast("double")
    motions = frames.where("frame_idx = 0").select("recording_id", "n_frames", fps.alias("fps"))
    found = m.frames_at(frames, motions, 37.3, ["recording_id"])
    return found.select("recording_id", "frame_idx", "event_id", "value")


@REGISTRY.add(
    """SELECT o_orderkey, o_custkey FROM orders
ORDER BY sha256(concat_ws(chr(31), '11', o_orderkey)), o_orderkey LIMIT 25"""
)
def seeded_sample(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return m.seeded_sample(rows, "o_orderkey", 25, 11)


@REGISTRY.add(
    """WITH s AS (
  SELECT o_orderstatus AS category, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS i,
         concat_ws('|', o_orderkey, o_custkey, o_orderpriority) AS sig FROM orders),
p AS (SELECT category, i // 1024 AS i, sha256(string_agg(sig, chr(10) ORDER BY i)) AS sig FROM s GROUP BY category, i // 1024),
b AS (SELECT category, i // 1024 AS i, sha256(string_agg(sig, chr(10) ORDER BY i)) AS sig FROM p GROUP BY category, i // 1024)
SELECT category, sha256(string_agg(sig, chr(10) ORDER BY i)) AS fingerprint FROM b GROUP BY category"""
)
def fingerprint(spark, sf_dir):
    parts = [F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_orderpriority")]
    rows = load(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "category")
    return m.fingerprint(rows, ["category"], ["o_orderkey"], F.concat_ws("|", *parts))


# -- calibration: an embedding is 21 points, the reference is the mean pose -------------------

BONES = 21


def _points(spark, sf_dir):
    triples = F.array(
        *[F.struct(number(3 * b).alias("x"), number(3 * b + 1).alias("y"), number(3 * b + 2).alias("z"))
          for b in range(BONES)]
    )
    rows = load(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(triples).alias("bone", "_p"))
    points = rows.select("vec_id", "bone", "_p.*")
    reference = points.groupBy("bone").agg(
        (F.avg("x") + F.col("bone") * 0.01).alias("x"),
        (F.avg("y") - (F.col("bone") % 4) * 0.02).alias("y"),
        F.avg("z").alias("z"),
    )
    return points, reference


FIT_SQL = f"""WITH pt AS (
  SELECT vec_id, b AS bone, CAST(embedding[3 * b + 1] AS DOUBLE) AS x, CAST(embedding[3 * b + 2] AS DOUBLE) AS y,
         CAST(embedding[3 * b + 3] AS DOUBLE) AS z
  FROM embeddings, (SELECT UNNEST(generate_series(0, {BONES - 1})) AS b)),
rf AS (SELECT bone, AVG(x) + bone * 0.01 AS x, AVG(y) - (bone % 4) * 0.02 AS y, AVG(z) AS z FROM pt GROUP BY bone),
c AS (
  SELECT vec_id, pt.x - AVG(pt.x) OVER w AS x, pt.y - AVG(pt.y) OVER w AS y, pt.z - AVG(pt.z) OVER w AS z,
         rf.x - AVG(rf.x) OVER w AS dx, rf.y - AVG(rf.y) OVER w AS dy, rf.z - AVG(rf.z) OVER w AS dz
  FROM pt JOIN rf USING (bone) WINDOW w AS (PARTITION BY vec_id)),
h AS (
  SELECT vec_id, COUNT(*) AS n, SUM(x*dx) a, SUM(x*dy) b, SUM(x*dz) c, SUM(y*dx) d, SUM(y*dy) e, SUM(y*dz) f,
         SUM(z*dx) g, SUM(z*dy) i, SUM(z*dz) j, SUM(x*x + y*y + z*z) AS ss, SUM(dx*dx + dy*dy + dz*dz) AS dd
  FROM c GROUP BY vec_id),
s AS (
  SELECT *, a*a + d*d + g*g AS p, b*b + e*e + i*i AS q, c*c + f*f + j*j AS r, a*b + d*e + g*i AS u,
         a*c + d*f + g*j AS v, b*c + e*f + i*j AS w, a*(e*j - f*i) - b*(d*j - f*g) + c*(d*i - e*g) AS det FROM h),
t AS (SELECT *, (p + q + r) / 3 AS m FROM s),
k AS (SELECT *, sqrt(((p-m)*(p-m) + (q-m)*(q-m) + (r-m)*(r-m) + 2*(u*u + v*v + w*w)) / 6) AS sc FROM t),
ang AS (
  SELECT *, acos(greatest(least((((p-m)*((q-m)*(r-m) - w*w) - u*(u*(r-m) - w*v) + v*(u*w - (q-m)*v))
           / (sc*sc*sc)) / 2, 1.0), -1.0)) / 3 AS phi FROM k),
ev AS (
  SELECT *, m + 2*sc*cos(phi) AS l1, m + 2*sc*cos(phi + 2*pi()/3) AS l3 FROM ang),
fit AS (
  SELECT vec_id, n, sqrt(greatest(ss + dd - 2 * (sqrt(greatest(l1, 0)) + sqrt(greatest(3*m - l1 - l3, 0))
           + sign(det) * sqrt(greatest(l3, 0))), 0) / n) AS rms FROM ev)"""


@REGISTRY.add(FIT_SQL + " SELECT vec_id, n, round(rms, 5) AS rms FROM fit")
def kabsch_fit(spark, sf_dir):
    points, reference = _points(spark, sf_dir)
    fits = cal.fit_frames(points, reference, ["vec_id"])
    return rounded(fits.select("vec_id", "n", "rms"), "rms", places=5)


@REGISTRY.add(
    FIT_SQL
    + """ SELECT vec_id, round(rms, 5) AS rms FROM fit WHERE vec_id % 3 = 0
  ORDER BY fit.rms, vec_id LIMIT 5"""
)
def kabsch_topk(spark, sf_dir):
    points, reference = _points(spark, sf_dir)
    best = cal.best_frames(points, reference, "vec_id", stride=3, top_k=5)
    return rounded(best.select("vec_id", "rms"), "rms", places=5)


def _deltas(spark, sf_dir):
    """Joint rotations of every frame against those of the mean pose."""
    joints = joint_table(poses(spark, sf_dir), ["vec_id"]).withColumnRenamed("joint", "bone")
    parts = ("qw", "qx", "qy", "qz")
    captured = joints.select("vec_id", "bone", *parts)
    shift = F.when(F.col("bone") == "pelvis", 1.0).otherwise(0.25)
    captured = captured.withColumn("qw", F.col("qw") * 0.05 + shift)
    reference = captured.groupBy("bone").agg(*[F.avg(p).alias(p) for p in parts])
    return cal.bone_deltas(captured, reference, ["vec_id"])


_D = product(("w", "(-x)", "(-y)", "(-z)"), ("rw", "rx", "ry", "rz"))
DELTA_SQL = JOINTS_SQL + f""",
cp AS (SELECT vec_id, joint AS bone, qw * 0.05 + CASE WHEN joint = 'pelvis' THEN 1.0 ELSE 0.25 END AS qw,
         qx, qy, qz FROM jt),
rf AS (SELECT bone, AVG(qw) AS a, AVG(qx) AS b, AVG(qy) AS c, AVG(qz) AS d FROM cp GROUP BY bone),
un AS (
  SELECT vec_id, bone, qw/n AS w, qx/n AS x, qy/n AS y, qz/n AS z, a/m AS rw, b/m AS rx, c/m AS ry, d/m AS rz
  FROM (SELECT cp.*, rf.* EXCLUDE (bone), sqrt(qw*qw + qx*qx + qy*qy + qz*qz) AS n,
               sqrt(a*a + b*b + c*c + d*d) AS m FROM cp JOIN rf USING (bone))),
dl AS (SELECT vec_id, bone, {", ".join(f"{e} AS d{c}" for c, e in zip("wxyz", _D))} FROM un)"""


@REGISTRY.add(
    DELTA_SQL
    + """ SELECT vec_id, bone, round(dw, 6) AS dw, round(dx, 6) AS dx, round(dy, 6) AS dy, round(dz, 6) AS dz,
  round(degrees(2 * acos(least(abs(dw), 1.0))), 4) AS angle_deg FROM dl"""
)
def bone_deltas(spark, sf_dir):
    found = rounded(_deltas(spark, sf_dir), "dw", "dx", "dy", "dz")
    return rounded(found, "angle_deg", places=4)


@REGISTRY.add(
    DELTA_SQL
    + """, f AS (SELECT bone, arg_min(struct_pack(w := dw, x := dx, y := dy, z := dz), vec_id) AS q,
  COUNT(*) AS frames FROM dl GROUP BY bone),
a AS (SELECT bone, frames, degrees(2 * acos(least(abs(dw*q.w + dx*q.x + dy*q.y + dz*q.z), 1.0))) AS deg
  FROM dl JOIN f USING (bone)),
s AS (SELECT bone, MAX(frames) AS frames, MAX(deg) AS deg FROM a GROUP BY bone)
SELECT bone, frames, round(deg, 4) AS spread_deg,
  CASE WHEN deg < 2 THEN 'OK' WHEN deg < 10 THEN 'WARN' ELSE 'BAD' END AS verdict FROM s"""
)
def delta_spread(spark, sf_dir):
    return rounded(cal.delta_spread(_deltas(spark, sf_dir), "vec_id"), "spread_deg", places=4)


