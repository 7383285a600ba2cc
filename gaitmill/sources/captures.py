"""Recordings, metadata and terrain as DataFrames."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaitmill.functions.rotation import Rigid
from gaitmill.functions.text import present, stable_hash
from gaitmill.operators.shared import must_be_empty, same_key_join
from gaitmill.operators.track import MAX_ROWS, Track
from gaitmill.schemas import FRAME, META, TERRAIN

KEYS = ("category", "recording_id")
CORRUPT = "_corrupt_record"
# Capture categories with the scale that brings them to robot height.
CATEGORY_SCALE = {
    "ground": 1.0,
    "stairs": 1.0,
    "traversal_mantle": 0.77,
    "traversal_mantle_vault": 0.77,
    "traversal_vault": 0.77,
}
CATEGORIES = tuple(CATEGORY_SCALE)


def _named(df: DataFrame, suffix: str, path: str = "_metadata.file_path") -> DataFrame:
    pattern = rf"([^/]+)/([^/]+){suffix}$"
    return df.withColumns(
        {
            "category": F.regexp_extract(F.col(path), pattern, 1),
            "recording_id": F.regexp_extract(F.col(path), pattern, 2),
        }
    )


def _globs(root: str, categories: Sequence[str] | None, suffix: str) -> list[str]:
    return [f"{root}/{c}/*{suffix}" for c in categories or ("*",)]


def read_frames(
    spark: SparkSession, root: str, categories: Sequence[str] | None = None, *, strict: bool = False
) -> DataFrame:
    """Frames of ``<root>/<category>/<recording>_frames.jsonl``.

    Unreadable lines stay as rows with ``_corrupt_record``, or fail the read when
    ``strict``. Blank lines are skipped by the reader. ``line`` orders the lines of a
    file and is different for each.
    """
    schema = FRAME if strict else T.StructType([*FRAME.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    if not strict:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    frames = _named(reader.json(_globs(root, categories, "_frames.jsonl")), "_frames\\.jsonl")
    line = F.struct(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("no")
    )
    return frames.withColumn("line", line)


def with_frame_index(
    frames: DataFrame,
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = ("line",),
    *,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add the dense ``frame_idx`` in the order of the lines. Only keys and order are
    sorted; the wide rows meet the numbers in an equi-join on (keys, order).

    Lines differ, so rows are neither lost nor multiplied, whatever the counter ``f``
    says. Another ``order`` must not repeat within a recording: that is an error.
    """
    if "line" not in order:
        repeated = frames.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("rows"))
        must_be_empty(repeated.where("rows > 1"), "frames of equal order", [*keys, *order, "rows"])
    narrow = frames.select(*keys, *order)
    numbers = Track.of(narrow, keys, order, max_rows=max_rows).numbered("frame_idx").result()
    return same_key_join(frames, numbers, [*keys, *order], "inner").drop("line")


def land(frames: DataFrame, path: str, *, page_rows: int = 100_000) -> None:
    """Write frames once as Parquet: pruned by category, and clustered by
    recording and page so that a long recording becomes several files."""
    page = F.floor(F.col("frame_idx") / page_rows)
    (
        frames.repartition(*KEYS, page)
        .sortWithinPartitions(*KEYS, "frame_idx")
        .write.partitionBy("category")
        .mode("overwrite")
        .parquet(path)
    )


def element(array: Column, i: int) -> Column:
    return F.get(array, F.lit(i))


def frame_header(frames: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The narrow columns that cleaning, washing and filtering read. On Parquet
    the joints are not touched."""
    cmd, root = F.col("cmd"), F.col("root")
    index = [c for c in ("frame_idx",) if c in frames.columns]
    return frames.select(
        *keys,
        *index,
        "t",
        "dt",
        "f",
        *[element(root["p"], i).alias(f"p{n}") for i, n in enumerate("xyz")],
        *[element(root["mesh"]["s"], i).alias(f"scale_{n}") for i, n in enumerate("xyz")],
        element(cmd["move"], 0).alias("move_right"),
        element(cmd["move"], 1).alias("move_forward"),
        cmd["crouch"].alias("crouch"),
        cmd["jump"].alias("jump"),
    )


def read_meta(spark: SparkSession, root: str, categories: Sequence[str] | None = None) -> DataFrame:
    """One row per recording; an empty terrain reference is null."""
    reader = spark.read.schema(META).option("multiLine", True)
    meta = _named(reader.json(_globs(root, categories, "_meta.json")), "_meta\\.json")
    return meta.withColumns(
        {c: present(F.col(c)) for c in ("terrain_ref", "terrain_hash")}
    )


def read_terrain(spark: SparkSession, folder: str) -> DataFrame:
    """One row per terrain file, with its file name as ``terrain_ref``."""
    df = spark.read.schema(TERRAIN).option("multiLine", True).json(f"{folder}/terrain_*.json")
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1)
    return df.withColumn("terrain_ref", name)


def terrain_meshes(terrain: DataFrame) -> DataFrame:
    rows = terrain.select("terrain_hash", F.posexplode("meshes").alias("mesh_idx", "_m"))
    return rows.select("terrain_hash", "mesh_idx", "_m.*")


def terrain_instances(terrain: DataFrame) -> DataFrame:
    rows = terrain.select("terrain_hash", F.posexplode("instances").alias("instance_idx", "_i"))
    fields = [f"_i.{n}" for n in ("name", "location", "rotation_quat_xyzw", "scale")]
    return rows.select("terrain_hash", "instance_idx", F.col("_i.mesh").alias("mesh_idx"), *fields)


# -- discovery -----------------------------------------------------------------


def list_files(spark: SparkSession, root: str, suffix: str, categories: Sequence[str] | None = None) -> DataFrame:
    """File paths and sizes; the contents are pruned from the scan."""
    files = spark.read.format("binaryFile").load(_globs(root, categories, suffix))
    return _named(files.select("path", "length"), suffix.replace(".", "\\."), "path")


def recording_pairs(metas: DataFrame, frame_files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(recordings with frames, metas without frames)."""
    keys = list(KEYS)
    return (
        metas.join(frame_files.select(*keys, F.col("path").alias("frames_path")), keys),
        metas.join(frame_files, keys, "left_anti"),
    )


def playlist(
    pairs: DataFrame,
    scales: Mapping[str, float] = CATEGORY_SCALE,
    *,
    limit: int | None = None,
    seed: int | None = None,
) -> DataFrame:
    """Recordings with their category's scale: by name, or shuffled by seed."""
    table = F.create_map(*[F.lit(x) for kv in scales.items() for x in kv])
    rows = pairs.withColumn("data_scale", F.try_element_at(table, F.col("category")))
    rows = rows.where(F.col("data_scale").isNotNull())
    order = [*KEYS] if seed is None else [stable_hash(seed, *KEYS), *KEYS]
    ordered = rows.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def first_rows(rows: DataFrame, order: Sequence[str], limit: int | None) -> DataFrame:
    """The first rows in sorted order (a top-k, not a full sort)."""
    return rows if limit is None else rows.orderBy(*order).limit(limit)


def resolve_terrain(
    recordings: DataFrame, candidates: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Add ``terrain_path``: the explicit one, else the best candidate.

    ``candidates`` lists (terrain_ref, priority, path); one best row per terrain
    remains before recordings are looked at.
    """
    best = candidates.groupBy("terrain_ref").agg(
        F.min_by("path", F.struct("priority", "path")).alias("_found")
    )
    ref = recordings.withColumn("terrain_ref", present(F.col("terrain_ref")))
    joined = ref.join(best, "terrain_ref", "left")
    explicit = (
        present(F.col("explicit_terrain")) if "explicit_terrain" in recordings.columns else F.lit(None)
    )
    return joined.withColumn("terrain_path", F.coalesce(explicit, F.col("_found"))).drop("_found")


# -- skeletons -----------------------------------------------------------------


def bone_table(meta: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    both = F.arrays_zip(F.col("bone_names").alias("bone"), F.col("parent_indices").alias("parent_idx"))
    rows = meta.select(*keys, F.posexplode(both).alias("bone_idx", "_b"))
    return rows.select(*keys, "bone_idx", "_b.bone", "_b.parent_idx")


def bone_lookup(bones: DataFrame, wanted: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows of the wanted bones; raises when a skeleton lacks one."""
    found = bones.where(F.col("bone").isin(*wanted))
    per = bones.groupBy(*keys).agg(
        F.array_except(
            F.array(*[F.lit(w) for w in wanted]),
            F.collect_set(F.when(F.col("bone").isin(*wanted), F.col("bone"))),
        ).alias("missing")
    )
    must_be_empty(per.where(F.size("missing") > 0), "missing bones", [*keys, "missing"])
    return found


def connections(bones: DataFrame, edges: Sequence[tuple[str, str]], keys: Sequence[str] = KEYS) -> DataFrame:
    """Index pairs of the edges whose two ends a skeleton has, in edge order."""
    listed = F.array(
        *[F.struct(F.lit(i).alias("edge_no"), F.lit(a).alias("a"), F.lit(b).alias("b"))
          for i, (a, b) in enumerate(edges)]
    )
    names = F.map_from_entries(F.collect_list(F.struct("bone", "bone_idx")))
    per = bones.groupBy(*keys).agg(names.alias("_at"))  # one entry per bone of a skeleton
    rows = per.select(*keys, "_at", F.explode(listed).alias("_e"))
    rows = rows.select(
        *keys,
        "_e.edge_no",
        F.try_element_at("_at", F.col("_e.a")).alias("from_idx"),
        F.try_element_at("_at", F.col("_e.b")).alias("to_idx"),
    )
    return rows.where(F.col("from_idx").isNotNull() & F.col("to_idx").isNotNull())


# -- configuration -------------------------------------------------------------


def read_config(spark: SparkSession, path: str) -> dict:
    """A configuration file: one small JSON document, on any file system."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def read_alignment(spark: SparkSession, path: str) -> tuple[Rigid, dict[str, list[float]], dict]:
    """(rigid alignment, per-bone rotations as wxyz, whole document)."""
    cfg = read_config(spark, path)
    g = cfg["global"]
    align = Rigid.from_wxyz(g["rotation_quat_wxyz"], g["translation_xyz"])
    return align, dict(cfg.get("per_bone_delta_quat_wxyz", {})), cfg

