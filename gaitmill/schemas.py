"""Fixed schemas of the captured data and of the manifests."""

from __future__ import annotations

from pyspark.sql import types as T

DOUBLES = T.ArrayType(T.DoubleType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# Array fields with these names hold quaternions (x, y, z, w). Fixed values.
QUATERNION_FIELDS = ("q", "wq", "lq", "cq")

JOINT = _struct(
    n=T.StringType(),
    pi=T.IntegerType(),
    lp=DOUBLES,
    lq=DOUBLES,
    cp=DOUBLES,
    cq=DOUBLES,
    wp=DOUBLES,
    wq=DOUBLES,
)

FRAME = _struct(
    t=T.DoubleType(),
    dt=T.DoubleType(),
    f=T.LongType(),
    cmd=_struct(
        move=DOUBLES,
        dLookY=T.DoubleType(),
        dLookP=T.DoubleType(),
        jump=T.BooleanType(),
        run=T.BooleanType(),
        walk=T.BooleanType(),
        sprint=T.BooleanType(),
        crouch=T.BooleanType(),
        lookY=T.DoubleType(),
        lookP=T.DoubleType(),
        desVB=DOUBLES,
        desYR=T.DoubleType(),
        mouseRaw=DOUBLES,
    ),
    root=_struct(
        p=DOUBLES,
        q=DOUBLES,
        lv=DOUBLES,
        av=DOUBLES,
        mesh=_struct(p=DOUBLES, q=DOUBLES, s=DOUBLES),
    ),
    phy=_struct(
        v=DOUBLES,
        gnd=T.BooleanType(),
        fall=T.BooleanType(),
        crouch=T.BooleanType(),
        mode=T.StringType(),
    ),
    foot=_struct(
        lF=T.BooleanType(),
        rF=T.BooleanType(),
        lP=DOUBLES,
        rP=DOUBLES,
        lD=T.DoubleType(),
        rD=T.DoubleType(),
        n=DOUBLES,
    ),
    joints=T.ArrayType(JOINT),
)

META = _struct(
    schema_version=T.StringType(),
    project_name=T.StringType(),
    task_name=T.StringType(),
    character_name=T.StringType(),
    skeleton_asset_path=T.StringType(),
    sample_rate_hz=T.DoubleType(),
    num_joints=T.IntegerType(),
    num_frames=T.LongType(),
    start_time=T.TimestampType(),
    unit_system=T.StringType(),
    terrain_ref=T.StringType(),
    terrain_hash=T.StringType(),
    interacted_terrain_instance_ids=T.ArrayType(T.IntegerType()),
    bone_names=T.ArrayType(T.StringType()),
    parent_indices=T.ArrayType(T.IntegerType()),
)

TERRAIN = _struct(
    schema_version=T.StringType(),
    unit_system=T.StringType(),
    terrain_hash=T.StringType(),
    level_name=T.StringType(),
    num_meshes=T.IntegerType(),
    num_instances=T.IntegerType(),
    meshes=T.ArrayType(
        _struct(
            asset_path=T.StringType(),
            num_vertices=T.IntegerType(),
            num_triangles=T.IntegerType(),
            vertices=T.ArrayType(DOUBLES),
            normals=T.ArrayType(DOUBLES),
            indices=T.ArrayType(T.LongType()),
        )
    ),
    instances=T.ArrayType(
        _struct(
            mesh=T.IntegerType(),
            name=T.StringType(),
            location=DOUBLES,
            rotation_quat_xyzw=DOUBLES,
            scale=DOUBLES,
        )
    ),
)

SEGMENT = _struct(
    seg_id=T.StringType(),
    category=T.StringType(),
    source_clean_jsonl=T.StringType(),
    source_clean_meta=T.StringType(),
    washed_jsonl=T.StringType(),
    washed_meta=T.StringType(),
    i0=T.LongType(),
    i1=T.LongType(),
    n_frames=T.LongType(),
    duration_s=T.DoubleType(),
    fps_src=T.DoubleType(),
    status=T.StringType(),
    wash=_struct(eps_side=T.DoubleType(), eps_mag=T.DoubleType(), rule=T.StringType()),
    mesh_scale=_struct(min=DOUBLES, max=DOUBLES, missing_frames=T.LongType()),
    qpos_npy=T.StringType(),
    seg_meta=T.StringType(),
    mesh_scale_observed=T.DoubleType(),
    data_scale=T.DoubleType(),
)

REJECT = _struct(
    seg_id=T.StringType(),
    category=T.StringType(),
    source_clean_jsonl=T.StringType(),
    source_clean_meta=T.StringType(),
    i0=T.LongType(),
    i1=T.LongType(),
    n_frames=T.LongType(),
    duration_s=T.DoubleType(),
    reject_stage=T.StringType(),
    reject_reason=T.StringType(),
    detail=T.StringType(),
)

QPOS = _struct(
    seg_id=T.StringType(),
    category=T.StringType(),
    frame_idx=T.LongType(),
    q=DOUBLES,
)
QPOS_WIDTH = 36
