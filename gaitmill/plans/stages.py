"""The stages of a dataset, from folders to tables.

Every stage reads tables, writes tables, and never changes its input, so a stage
that was interrupted is simply run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaitmill.functions.rotation import Rigid
from gaitmill.operators import balance, clean, commands, forward, geometry, stage3, stats, terrain, versions, wash
from gaitmill.operators.shared import must_be_empty, settle, tidy
from gaitmill.sinks import reports, tables
from gaitmill.sources import captures

KEYS = captures.KEYS


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


@tidy
def ingest(
    spark: SparkSession, raw_root: str, out: str, categories: Sequence[str] | None = None
) -> None:
    """JSON recordings to ``frames``, ``meta`` and ``rejects`` tables."""
    raw = settle(captures.read_frames(spark, raw_root, categories))
    broken = wash.parse_rejects(raw, captures.CORRUPT, KEYS)
    good = wash.readable(raw, broken, KEYS).drop(captures.CORRUPT)
    captures.land(captures.with_frame_index(good), f"{out}/frames")
    tables.write_table(captures.read_meta(spark, raw_root, categories), f"{out}/meta")
    tables.write_table(broken, f"{out}/rejects")


@tidy
def clean_stage(
    spark: SparkSession,
    raw: str,
    out: str,
    rule: clean.CleanRule = clean.CleanRule(),
    *,
    records: str = "hold",
) -> None:
    """Stage 1: ``frames``, ``meta``, ``manifest``, ``swaps`` and ``stats``."""
    frames = _read(spark, raw, "frames")
    at = clean.FrameColumns()
    cleaned = clean.clean(captures.frame_header(frames), at, rule, settled=True)
    segments = settle(clean.output_segments(cleaned, at))
    full = clean.cleaned_frames(frames, cleaned, at, records=records)
    tables.write_frames(full, f"{out}/frames", mode="overwrite")
    meta = clean.segment_meta(_read(spark, raw, "meta"), segments, KEYS)
    tables.write_table(meta, f"{out}/meta")
    tables.write_table(cleaned.manifest, f"{out}/manifest")
    swaps = versions.swap_manifest(cleaned.manifest, segments, KEYS)
    tables.write_table(swaps, f"{out}/swaps")
    tables.write_stats(cleaned.stats, f"{out}/stats")


@tidy
def wash_stage(
    spark: SparkSession,
    stage1: str,
    out: str,
    rule: wash.WashRule = wash.WashRule(),
    *,
    broken: DataFrame | None = None,
) -> str:
    """Stage 2 from the segments of stage 1: ``frames``, ``meta`` with the record of
    the wash, manifests, ``stats``, and the report as text. ``broken`` are the rejects
    of ingest: they count as parse failures and stay in the reject manifest."""
    at = wash.CommandColumns()
    frames = _read(spark, stage1, "frames").drop("recording_id", "filled")
    frames = frames.withColumnRenamed("seg_id", "recording_id")
    meta = _read(spark, stage1, "meta").drop("recording_id")
    meta = meta.withColumnRenamed("seg_id", "recording_id")
    header = captures.frame_header(frames)
    per = settle(wash.composition(header, at, rule))
    runs = settle(wash.good_runs(header, at, rule))
    accepted = wash.accepted_manifest(runs, per, meta, at, rule)
    rejected = wash.reject_manifest(runs, rule)
    if broken is not None:
        rejected = rejected.unionByName(broken, allowMissingColumns=True)
    counters = wash.wash_counters(per, runs, broken, at)
    tables.write_frames(
        wash.washed_frames(frames, accepted, KEYS), f"{out}/frames", mode="overwrite"
    )
    order = ("category", "recording_id", "i0")
    tables.write_json_rows(accepted, f"{out}/segments_manifest", order)
    tables.write_json_rows(rejected, f"{out}/reject_manifest", order)
    tables.write_table(accepted, f"{out}/manifest")
    tables.write_table(rejected, f"{out}/rejects")
    washed = meta.join(accepted.select(*KEYS, "seg_id", "i0", "i1", "wash"), list(KEYS))
    tables.write_table(washed, f"{out}/meta")
    tables.write_stats(counters, f"{out}/stats")
    sections = []
    kept = accepted.select("duration_s")
    whole = per.select(F.col("input_duration_s").alias("duration_s"))
    for title, rows in (("Input durations", whole), ("Output durations", kept)):
        sections.append(
            reports.duration_section(
                title,
                reports.collected(stats.histogram(rows, "duration_s")),
                reports.collected(stats.duration_percentiles(rows, "duration_s")),
                stats.duration_summary(rows, "duration_s").first().asDict(),
            )
        )
    text = reports.wash_report(reports.collected(counters), asdict(rule), sections)
    reports.write_text(spark, f"{out}/report", text)
    return text


@tidy
def qa_stage(
    spark: SparkSession, stage2: str, poses: DataFrame, out: str, rule: wash.WashRule = wash.WashRule()
) -> DataFrame:
    """Scale inference and QA of solved poses: ``manifest`` of the segments that
    pass, ``rejects``, ``failures``; returns the summary row."""
    scaled = stage3.infer_manifest_scale(_read(spark, stage2, "manifest"))
    ready, unscaled = stage3.split_work(scaled)
    order = ["category", "recording_id", "i0"]
    numbered = ready.withColumn("row_no", F.struct(*order, "seg_id"))
    header = captures.frame_header(_read(spark, stage2, "frames"), ["category", "seg_id"])
    sources = stage3.source_check(header, "seg_id", wash.CommandColumns(), rule)
    checks = settle(stage3.pose_check(poses.where(F.col("frame_idx").isNotNull())))
    judged = settle(stage3.qa_reasons(numbered, checks, None, sources))
    if "problem" in poses.columns:  # files that could not be read say why
        unread = poses.where(F.col("frame_idx").isNull()).groupBy("seg_id")
        judged = judged.join(unread.agg(F.first("problem").alias("problem")), "seg_id", "left")
    else:
        judged = judged.withColumn("problem", F.lit(None).cast("string"))
    passed = judged.where(F.size("reasons") == 0)
    tables.write_table(passed.select(*ready.columns), f"{out}/manifest")
    failed = judged.where(F.size("reasons") > 0).select("seg_id", "category", "reasons", "problem")
    tables.write_table(failed, f"{out}/failures")
    before = _read(spark, stage2, "rejects")
    tables.write_table(stage3.final_rejects(before, unscaled), f"{out}/rejects")
    summary = stage3.qa_summary(judged)
    tables.write_table(summary, f"{out}/stats")
    return _read(spark, out, "stats")


@tidy
def forward_stage(
    spark: SparkSession, stage2: str, solved: str, out: str, eps_back: float = forward.EPS_BACK
) -> str:
    """Forward-only subset of stages 2 and 3: ``manifest``, ``rejects``, report."""
    header = captures.frame_header(_read(spark, stage2, "frames"), ["category", "seg_id"])
    scan = forward.scan_motion(header, ["seg_id"], "frame_idx", "move_forward", eps_back)
    judged = settle(forward.judge(_read(spark, stage2, "manifest"), scan))
    forward.validate(judged)
    accepted, rejected = judged.where("keep"), judged.where("NOT keep")
    solved_rows = _read(spark, solved, "manifest")
    apart = forward.set_differences(accepted, rejected, solved_rows)
    must_be_empty(apart.where("problem = 'not_decided'"), "solved motions without a decision", ["seg_id"])
    tables.write_table(apart, f"{out}/set_differences")
    subset = forward.subset_solved(solved_rows, accepted)
    tables.write_table(subset, f"{out}/manifest")
    tables.write_table(rejected, f"{out}/rejects")
    tables.write_table(forward.solved_rejects(solved_rows, rejected), f"{out}/solved_rejects")
    stamped = forward.stamp_meta(_read(spark, stage2, "meta"), accepted, eps_back)
    tables.write_table(stamped, f"{out}/meta")
    counters = forward.counters(judged)
    tables.write_stats(counters, f"{out}/stats")
    text = reports.forward_report(reports.collected(counters), eps_back)
    reports.write_text(spark, f"{out}/report", text)
    return text


@tidy
def balance_stage(
    spark: SparkSession,
    manifest: DataFrame,
    meta: DataFrame,
    poses: DataFrame,
    out: str,
    rule: balance.BalanceRule = balance.BalanceRule(),
    *,
    stage2: DataFrame | None = None,
) -> str:
    """Training set: decisions, kept rows, rejects and report.

    ``meta`` gives ``terrain_ref`` per segment; ``poses`` the root pose in ``q``.
    Refuses motions that it cannot judge, and with ``stage2`` a manifest that does not
    describe the same motions.
    """
    if stage2 is not None:
        balance.validate_pair(stage2, manifest)
    balance.validate_poses(manifest, poses)
    q = [F.get("q", F.lit(i)) for i in range(7)]
    names = ("x", "y", "z", "qw", "qx", "qy", "qz")
    root = poses.select("seg_id", "frame_idx", *[c.alias(n) for n, c in zip(names, q)])
    motions = manifest.withColumn("fps", F.coalesce("fps_src", F.lit(60.0)))
    described = balance.describe_motions(root, motions, rule)
    group = balance.terrain_group(F.col("category"), F.col("terrain_ref"))
    rows = (
        manifest.join(meta.select("seg_id", "terrain_ref"), "seg_id", "left")
        .join(described.drop("window_frames"), "seg_id", "left")
        .withColumn("terrain_group", group)
        .withColumn("stationary", balance.is_stationary(rule))
        .withColumn("source_recording", F.col("recording_id"))
    )
    decided = settle(balance.decide(settle(rows), rule))
    kept = balance.with_filter_record(decided.where("decision = 'keep'"), rule, "balanced")
    short, excess = balance.audit_tables(decided)
    tables.write_table(kept, f"{out}/manifest")
    tables.write_table(decided, f"{out}/decisions")
    tables.write_table(short, f"{out}/duration_rejects")
    tables.write_table(excess, f"{out}/balance_rejects")
    summary = balance.summaries(decided)
    tables.write_table(summary, f"{out}/stats")
    summary = _read(spark, out, "stats").where("scope <> 'terrain'")
    durations = kept.select("duration_s")
    section = reports.duration_section(
        "Output durations",
        reports.collected(stats.retained_histogram(durations, "duration_s")),
        reports.collected(stats.duration_percentiles(durations, "duration_s")),
        stats.duration_summary(durations, "duration_s").first().asDict(),
    )
    text = reports.balance_report(reports.collected(summary), asdict(rule), section)
    reports.write_text(spark, f"{out}/report", text)
    return text


@tidy
def export_stage(
    spark: SparkSession,
    stage2: str,
    out: str,
    align: Rigid,
    *,
    factor: float = 1.0,
    offset: Sequence[float] = (0.0, 0.0, 0.0),
) -> None:
    """``commands`` in robot axes, ``skeleton`` with the recorded world pose of every
    joint, scaled, in metres and moved by ``offset``; one row per joint."""
    keys = ["category", "seg_id", "frame_idx"]
    frames = _read(spark, stage2, "frames")
    tables.write_frames(commands.command_table(frames, keys, align), f"{out}/commands", mode="overwrite")
    pose = geometry.robot_pose(geometry.scaled_pose(geometry.world_pose(F.col("joints")), factor))
    joints = frames.select(*keys, F.posexplode(pose).alias("joint_idx", "j")).select(*keys, "joint_idx", "j.*")
    moved = joints.withColumns({c: F.col(c) + F.lit(float(o)) for c, o in zip("xyz", offset)})
    tables.write_frames(moved, f"{out}/skeleton", mode="overwrite")


STAGE_METRICS = ("motions", "frames", "seconds")


def pipeline_report(spark: SparkSession, stages: Sequence[tuple[str, str]], out: str) -> str:
    """Report over several stages, from (title, folder) in their order: what each one
    kept, and how that differs from the one before. Reads the manifests."""
    sections: list[list[str]] = []
    before: DataFrame | None = None
    for title, folder in stages:
        totals = _read(spark, folder, "manifest").agg(
            F.count(F.lit(1)).alias("motions"),
            F.coalesce(F.sum("n_frames"), F.lit(0)).alias("frames"),
            F.coalesce(F.sum("duration_s"), F.lit(0.0)).alias("seconds"),
        )
        sections.append(reports.metric_section(title, totals.first().asDict()))
        if before is not None:
            pair = [stats.long_metrics(df, tag, STAGE_METRICS) for df, tag in ((before, "raw"), (totals, "clean"))]
            rows = reports.collected(stats.before_after(*pair))
            sections.append(reports.change_section(f"{title}: change", rows))
        before = totals
    text = reports.stages_report(sections)
    reports.write_text(spark, out, text)
    return text


@tidy
def terrain_stage(
    spark: SparkSession,
    folder: str,
    align: Rigid,
    out: str,
    *,
    ground_cm: float = 0.0,
    ground_z: float = 0.0,
    cell: float = terrain.CELL_SIZE,
) -> None:
    """``vertices``, ``triangles`` (with a ground where the source has none) and
    ``height_field`` per terrain."""
    source = settle(captures.read_terrain(spark, folder))
    meshes = captures.terrain_meshes(source)
    placed = terrain.placed_meshes(captures.terrain_instances(source), meshes)
    world = terrain.world_geometry(placed, align, ground_cm=ground_cm)
    vertices = settle(terrain.vertex_table(world))
    triangles = settle(terrain.triangle_table(world))
    extent = terrain.bounds(vertices)
    ground = terrain.ground_quads(extent, terrain.has_source_ground(meshes), z=ground_z)
    tables.write_table(vertices, f"{out}/vertices")
    both = triangles.unionByName(ground, allowMissingColumns=True)
    tables.write_table(both, f"{out}/triangles")
    field = terrain.height_field(triangles, extent, size=cell, fill=ground_z)
    tables.write_table(field, f"{out}/height_field")
